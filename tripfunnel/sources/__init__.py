"""Readers: raw JSON lines, catalogued tables, reviews, streams."""
