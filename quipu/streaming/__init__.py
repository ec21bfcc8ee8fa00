"""Structured Streaming jobs built from the operators."""
