"""Operators for text corpora: cleaning, tokenising, deduplicating, packing, searching and scoring."""
