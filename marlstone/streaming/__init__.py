"""Structured Streaming around the keyed state."""
