"""Operators for preparing training corpora; nothing else in the library imports them."""
