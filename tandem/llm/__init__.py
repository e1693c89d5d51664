"""Operators of a training-data pipeline: filters, duplicates, tokens, archives. Nothing else in the library imports them."""
