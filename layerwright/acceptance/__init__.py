"""Acceptance queries over the given tables, each with its reference SQL where SQL can say it."""
