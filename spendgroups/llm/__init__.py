"""Operators for preparing training data: text and embedding tables at scale."""
