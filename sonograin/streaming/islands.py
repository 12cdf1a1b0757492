"""Streams (an extension: the reference has none). Batch results are the final state of a stream over the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def session_islands(stream: DataFrame, keys: list[str], at: str, gap: str, late: str) -> DataFrame:
    """WN-07 on a stream: islands of events less than `gap` apart: (keys, first_at, last_at, n). Events later than `late` are
    not waited for. `at` must be a TIMESTAMP."""
    g = stream.withWatermark(at, late).groupBy(*keys, F.session_window(at, gap).alias("w"))
    return g.agg(F.count("*").alias("n"), F.min(at).alias("first_at"), F.max(at).alias("last_at")).drop("w")


def tumbling(stream: DataFrame, keys: list[str], at: str, width: str, value: str, late: str) -> DataFrame:
    """Counts and sums per window of `width`."""
    g = stream.withWatermark(at, late).groupBy(*keys, F.window(at, width).alias("w"))
    return g.agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(*keys, F.col("w.start").alias("from_at"), "n", "total")


def once_each(stream: DataFrame, ident: list[str], at: str, late: str) -> DataFrame:
    """Rows of a stream that are delivered again within `late` count once."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(ident)
