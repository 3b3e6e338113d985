"""Operators for training data on texts; nothing else in the library imports them."""
