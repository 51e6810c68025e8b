"""Operators for preparing training data: counting, judging, deduplicating, cleaning, mixing and sharding documents."""
