"""Parquet sinks."""
