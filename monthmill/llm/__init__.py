"""Operators for training-data pipelines: extraction, dedup, decontamination, scoring, search and tokenising."""
