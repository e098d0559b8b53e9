"""Automated machine learning on tables, written as Spark DataFrame jobs."""

__version__ = "0.1.0"
