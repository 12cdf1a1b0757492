"""Operators for training-data pipelines over long-form text. Nothing else in the library imports this package."""
