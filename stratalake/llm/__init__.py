"""Operators for preparing training data: deduplication, packing, filtering, archives, decontamination."""
