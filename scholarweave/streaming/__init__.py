"""Resumable, incremental processing."""
