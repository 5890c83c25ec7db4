"""Digest, spectrum preparation, scoring and the whole search."""
