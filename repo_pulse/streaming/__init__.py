"""Structured Streaming versions of the landing -> staging path."""
