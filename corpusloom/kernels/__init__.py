"""Parsers that no built-in function expresses. Pure functions on one document; Spark calls them in Arrow batches."""
