"""Operators for preparing training corpora: tokenizing, deduplication,
decontamination, filtering, classification and web archives.

Nothing else in the library imports this package.
"""
