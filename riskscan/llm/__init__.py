"""Operators for building training data: search, deduplication, filters, formats, packing and mixing."""
