"""Operators for training-data preparation (deduplication, scoring, packing,
tokenisation).  Nothing else in the library imports this subpackage."""
