"""Quayside: landing-to-bronze ingestion as plain PySpark DataFrame plans."""

__version__ = "0.1.0"
