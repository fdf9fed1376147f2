"""Fitted recipes on files as they land."""
