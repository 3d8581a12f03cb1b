"""Registered queries over the given tables, with their SQL where SQL can say it."""
