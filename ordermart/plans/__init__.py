"""Composite plans: user branch, order branch, the mart."""
