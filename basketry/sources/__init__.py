"""Schemas, readers and writers."""
