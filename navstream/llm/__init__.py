"""Operators of a training-data pipeline: rules, models, deduplication, tokenisation and mixing.

Nothing else in the library imports this subpackage. Every operator takes a DataFrame and column
names and returns a DataFrame; ``queries`` holds the thin registered forms.
"""
