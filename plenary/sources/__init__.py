"""Readers for landed files and writers for published tables."""
