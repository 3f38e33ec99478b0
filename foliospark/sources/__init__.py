"""Readers and writers for documents and metadata."""
