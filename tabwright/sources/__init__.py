"""Readers and writers: CSV, dataset catalog, result and run tables."""
