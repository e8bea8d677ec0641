"""Readers and writers of raw files and stage tables."""
