"""Structured Streaming form of the bulk load: each stored snapshot file is loaded once."""
