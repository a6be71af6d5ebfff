"""Operators for building training data from web-scale text; nothing else in the library imports them."""
