"""Readers for tables and landed payloads, and the matching writers."""
