"""Operators of a training-data pipeline: search, near duplicates, quality,
tokens, personal data, language, mixing, page text, rules and secrets.

Nothing else in the library imports this subpackage."""
