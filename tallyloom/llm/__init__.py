"""Operators for training-data pipelines over large tables; nothing else in the library imports them."""
