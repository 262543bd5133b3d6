"""Structured Streaming operators over prediction events."""
