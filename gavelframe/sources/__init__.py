"""Readers, writers and path columns."""
