"""Percentiles of very large numeric columns by mergeable sketches (problem 6).

KLL: a hierarchy of compactors, each of which sorts its values and keeps every other one, from a random
start, as values of double weight for the level above; sketches merge level by level.  Spark's own
KLL aggregate is used, so everything stays in the JVM with map-side partial sketches: rows of one hot
group shuffle as one sketch per task.  Sketches are plain binary columns that can be stored per delivery
and merged later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size parameter of the sketches.
K = 800
PERCENTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)


def rank_error(k: int = K) -> float:
    """Bound on the normalised rank error of one percentile, kept with 99 % confidence: the published fit
    for this sketch, 2.296 / k ** 0.9021. Merging sketches of the same k keeps it."""
    return 2.296 / k**0.9021


def sketch(df: DataFrame, group: list[str], value: str, k: int = K) -> DataFrame:
    """(group, n BIGINT, lo, hi DOUBLE, sketch BINARY): one sketch per group over the values.

    Null and NaN values do not count; a group without values has no row. Null group keys form a group."""
    v = F.col(value).cast("double")
    vals = df.select(*group, v.alias("__v")).where("__v IS NOT NULL AND NOT isnan(__v)")
    return vals.groupBy(*group).agg(F.count("*").alias("n"), F.min("__v").alias("lo"), F.max("__v").alias("hi"), F.kll_sketch_agg_double("__v", F.lit(k)).alias("sketch"))


def merge_sketches(sketches: DataFrame, group: list[str]) -> DataFrame:
    """Sketches of separate partitions, days or deliveries merged to one per (coarser) group."""
    return sketches.groupBy(*group).agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.kll_merge_agg_double("sketch").alias("sketch"))


def percentiles(sketches: DataFrame, group: list[str], at: tuple[float, ...] = PERCENTILES) -> DataFrame:
    """(group, n, lo, hi, p, value): the percentiles out of each sketch. Sketches of no values give no rows."""
    ranks = F.array(*map(F.lit, at))
    pairs = F.arrays_zip(ranks.alias("p"), F.kll_sketch_get_quantile_double("sketch", ranks).alias("value"))
    return sketches.where("n > 0").select(*group, "n", "lo", "hi", F.explode(pairs).alias("q")).select(*group, "n", "lo", "hi", "q.p", "q.value")
