"""Catalogue-analytics operators expressed on Spark's DataFrame, SQL and streaming APIs."""
