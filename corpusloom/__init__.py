"""Scholarly-corpus analytics on Spark: DataFrame operators, sources, plans and streaming."""
