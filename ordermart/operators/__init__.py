"""Relational operators: skew-aware windows, month spine, keyed left joins."""
