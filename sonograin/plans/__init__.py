"""Registered queries."""

from __future__ import annotations

from types import ModuleType

from sonograin.plans import catalog


def load() -> ModuleType:
    """The catalog with every module of queries imported."""
    from sonograin.plans import records, sequences, streams, texts, timeline  # noqa: F401

    return catalog
