"""Batch operators: prepare, split, profile, encode, metrics, governance, models."""
