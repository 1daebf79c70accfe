"""Operators for training sequences and texts. Nothing outside this package imports it."""
