"""Readers, writers, and the library's inputs derived from other tables."""
