"""Readers, writers and landing."""
