"""Operators of a training-data pipeline: quality, tokens, language, decontamination, dedup, PII, HTML, LM, mixing."""
