"""Operators for preparing text corpora: fingerprints, tokens, duplicates, markup, scores, archives."""
