"""Training-data operators: tokenising, dedup, mixing, scoring, scanning, extraction, search.

Nothing else in the library imports this subpackage.
"""
