"""Operators of a training-data pipeline: dedup, search, formatting, extraction,
packing, tokenisation, token files and quality selection, as Spark jobs."""
