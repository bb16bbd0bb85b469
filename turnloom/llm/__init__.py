"""Operators for large text corpora: dedup, quality, decontamination, extraction, packing,
language ID, URL filtering, near-dedup, license scanning and token files.

Nothing outside this package imports it, so it can be removed as a whole.
"""
