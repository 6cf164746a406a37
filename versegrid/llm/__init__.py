"""Training-data pipeline operators (self-contained; nothing else in the library imports this)."""
