"""Corpus preparation for language-model training. Nothing else in lectern imports this package."""
