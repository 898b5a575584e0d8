"""Streaming forms of the event models."""
