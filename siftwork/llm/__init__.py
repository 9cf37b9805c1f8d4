"""Operators for preparing training text: sharding, cleaning, matching, tokenising and scoring documents."""
