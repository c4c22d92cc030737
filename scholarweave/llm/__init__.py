"""Operators for building text corpora at scale, and their queries."""
