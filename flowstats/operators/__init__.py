"""Aggregation, top-k and roll-up operators."""
