"""Operators for cleaning, deduplicating, scoring and mixing text for model training."""
