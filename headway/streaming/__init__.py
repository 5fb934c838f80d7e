"""Structured Streaming form of the snapshot feed."""
