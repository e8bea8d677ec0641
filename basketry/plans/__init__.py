"""Operators wired into full weekly runs."""
