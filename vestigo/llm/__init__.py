"""Operators for preparing training text: counting, deduplication, archives,
decontamination, sharding, quality, tokenising and pseudonyms.

Nothing outside this subpackage imports it.
"""
