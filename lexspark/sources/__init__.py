"""Readers, writers and stored-page parsing."""
