"""Operators for preparing text corpora: dedup, extraction, language, toxicity, tokens."""
