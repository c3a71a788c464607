"""Readers and writers, the shared workspace, and the views over the given tables."""
