"""Readers and writers of survey tables."""
