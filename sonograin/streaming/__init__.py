"""Streaming variants."""
