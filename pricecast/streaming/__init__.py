"""Structured Streaming form of the scoring operators."""
