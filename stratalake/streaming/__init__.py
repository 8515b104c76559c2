"""Incremental ingestion of landing directories."""
