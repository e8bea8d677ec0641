"""Operators for large training-text collections: see README, section "Training text"."""
