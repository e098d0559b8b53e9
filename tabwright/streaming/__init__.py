"""Structured Streaming variants of the registry log and of scoring."""
