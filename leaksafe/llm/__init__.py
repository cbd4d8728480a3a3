"""Operators for large text corpora: personal data, secrets, duplicates, language, toxicity, extraction, packing."""
