"""Catalog extracts and the chained close."""
