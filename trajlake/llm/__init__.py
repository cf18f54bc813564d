"""Operators for training data: overlaps, repetition, token budgets, caps, splits, encoding, packing, pieces."""
