"""File sources, each with an explicit schema."""
