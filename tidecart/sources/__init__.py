"""Readers for landed files and writers for clean tables."""
