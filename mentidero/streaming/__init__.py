"""Incremental runs of the batch transforms."""
