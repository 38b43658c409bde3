"""Composed plans (medallion layers, star schema) and the query registry."""
