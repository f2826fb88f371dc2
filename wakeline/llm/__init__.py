"""Operators of a training-data pipeline: quality, deduplication, mixing, filters, archives and scans."""
