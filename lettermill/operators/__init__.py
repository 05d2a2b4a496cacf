"""Relational operators of the ingestion, DataFrame in and DataFrame out."""
