"""Operators for building training data out of a table of documents."""
