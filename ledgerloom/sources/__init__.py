"""Readers of landed files, and writers."""
