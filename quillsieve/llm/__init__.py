"""Corpus operators for large-scale text preparation; nothing outside imports this."""
