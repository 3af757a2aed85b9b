"""Operators for large training corpora, their queries and SQL twins."""
