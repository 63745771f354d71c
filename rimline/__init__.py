"""rimline: Spark jobs that fuse position tracking with play-by-play events."""
