"""Operators for large text corpora; of it, the library itself imports storage.py alone."""
