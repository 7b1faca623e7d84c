"""Structured Streaming forms of the daily counts, the feeds, the table changes and the change log."""
