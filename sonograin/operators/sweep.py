"""Overlapping and gapped intervals: a sweep line per entity (problem 5).

Boundaries become events (+1 at a start, -1 at an end), summed per instant; the prefix sum of the events
is the number of open intervals.  A period runs while it is above zero, a gap while it is zero between
two periods.  One entity may hold a third of all rows, so no window runs over a whole entity: events
are cut into time blocks, each block is summed, only the block sums are scanned per entity, and
every block then sweeps its own events from the count carried into it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Length of a time block, in the unit of the boundaries (milliseconds for p5): at most so many
#: distinct instants meet in one window partition.
BLOCK = 300_000


def sweep(df: DataFrame, keys: list[str], start: Column, end: Column, block: int = BLOCK) -> DataFrame:
    """Covered periods and the gaps between them: (keys, kind 'period' | 'gap', from_at, to_at BIGINT).

    `start`, `end`: integral boundaries; touching intervals belong together.  Rows with a null boundary
    or end <= start do not count.  Null keys form an entity of their own.  Repeated and nested
    intervals change nothing.  No rows in, no rows out; other columns, of any name, are ignored."""
    names = [f"__k{i}" for i in range(len(keys))]
    spans = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], start.cast("bigint").alias("__a"), end.cast("bigint").alias("__b"))
    spans = spans.where("__a IS NOT NULL AND __b IS NOT NULL AND __b > __a")
    both = F.array(F.struct(F.col("__a").alias("at"), F.lit(1).alias("d")), F.struct(F.col("__b").alias("at"), F.lit(-1).alias("d")))
    events = (
        spans.select(*names, F.explode(both).alias("e"))
        .groupBy(*names, F.col("e.at").alias("at"))
        .agg(F.sum("e.d").alias("d"))
        .where("d <> 0")
        .withColumn("blk", F.floor(F.col("at") / block))
    )
    # carry: open intervals before each block, from the block sums alone
    blocks = events.groupBy(*names, "blk").agg(F.sum("d").alias("bd"))
    before = Window.partitionBy(*names).orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = blocks.select(*names, "blk", F.coalesce(F.sum("bd").over(before), F.lit(0)).alias("carry"))
    on = _null_safe(events, carry, [*names, "blk"])
    within = Window.partitionBy(*names, "blk").orderBy("at")
    active = (
        events.join(carry.select(*[F.col(c).alias(f"c_{c}") for c in [*names, "blk"]], "carry"), on)
        .withColumn("open", F.col("carry") + F.sum("d").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .where("open = 0 OR open - d = 0")
        .select(*names, "blk", "at", "open")
    )
    # every transition pairs with the next one: within its block, else the first of the next block that has any
    firsts = active.groupBy(*names, "blk").agg(F.min("at").alias("first_at"))
    order = Window.partitionBy(*names).orderBy("blk")
    following = firsts.select(*names, "blk", F.lead("first_at").over(order).alias("next_first"))
    on = _null_safe(active, following, [*names, "blk"])
    paired = (
        active.withColumn("to_at", F.lead("at").over(within))
        .join(following.select(*[F.col(c).alias(f"c_{c}") for c in [*names, "blk"]], "next_first"), on)
        .withColumn("to_at", F.coalesce("to_at", "next_first"))
        .where("to_at IS NOT NULL")
    )
    return paired.select(
        *[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)],
        F.when(F.col("open") > 0, "period").otherwise("gap").alias("kind"), F.col("at").alias("from_at"), "to_at",
    )


def _null_safe(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(n).eqNullSafe(F.col(f"c_{n}"))
    return cond


def periods_and_gaps(df: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """sweep() over seconds: (keys, kind, from_ms, to_ms) in whole milliseconds."""
    ms = [F.round(F.col(f"`{c}`") * 1000).cast("bigint") for c in (start, end)]
    ok = F.col(f"`{end}`") > F.col(f"`{start}`")
    return sweep(df.where(ok), keys, *ms).withColumnsRenamed({"from_at": "from_ms", "to_at": "to_ms"})
