"""Training-data operators: scans, extraction, deduplication, scoring and mixing of text tables."""
