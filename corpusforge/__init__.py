"""Corpus construction and analytics on Spark: text, layout, alignment, scoring, deduplication and reports."""
