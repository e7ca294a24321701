"""Operators for preparing training data: near-duplicates, extraction, scoring, mixing, formatting.

Nothing else in the library imports this subpackage.
"""
