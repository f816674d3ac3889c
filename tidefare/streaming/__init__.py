"""Transformations of ride-request feeds; each works on streams and on tables."""
