"""Operators for preparing training data: dedup, tokenising, language, PII, mixing, media, quality, counts, search, toxicity."""
