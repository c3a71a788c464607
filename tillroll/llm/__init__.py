"""Operators for training-data pipelines: filters, near-copies, token files, mixing, search."""
