"""Structured Streaming forms of the keyed loads."""
