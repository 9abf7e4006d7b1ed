"""Operators for training-data corpora: decontamination, quality, extraction, deduplication, scans and tokenisation."""
