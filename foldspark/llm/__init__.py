"""Operators for preparing training text: cleaning, deduplication, scoring, tokenising, packing.

Nothing else in the package imports this folder.
"""
