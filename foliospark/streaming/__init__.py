"""Streaming forms of the transforms."""
