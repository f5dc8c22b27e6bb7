"""Operators for training data: tokenizing, decontamination, deduplication, archives, scans, filters."""
