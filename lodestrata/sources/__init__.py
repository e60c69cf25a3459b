"""Readers, writers and file listings."""
