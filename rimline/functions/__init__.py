"""Column expressions: keys, play-by-play fields and court geometry."""
