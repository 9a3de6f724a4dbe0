"""Arriving files as a stream."""
