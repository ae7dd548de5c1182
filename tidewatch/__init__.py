"""Spark tables-in, tables-out analytics for metric streams, text corpora and account risk."""
