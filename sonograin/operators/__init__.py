"""Relational operators over explicit key and order columns."""
