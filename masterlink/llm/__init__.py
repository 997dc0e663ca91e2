"""Operators for large-scale training-data pipelines (extraction, filtering, dedup, mixing)."""
