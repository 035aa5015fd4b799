"""Readers, writers and the inputs derived from the supplied tables."""
