"""Operators of a training-data pipeline: dedup, packing, quality, search, extraction, mixing, scans."""
