"""Running values over entities of any size.

One entity (a user, a chapter) may hold a third of all rows, so a window over a whole entity would be one task. Here rows are cut
into blocks along their order; each block is aggregated, only the block rows are scanned per entity, and every block then runs its
own window from what is carried into it.  Works for what merges: sums, maxima, last known values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions (or other units of an integral order) in a block.
POSITIONS = 4096


def before(df: DataFrame, keys: list[str], order: list[str], block: Column, **wanted: tuple[str, Column]) -> DataFrame:
    """df with one column per `wanted` name: ('sum' | 'max' | 'last', value) over all earlier rows of the entity; null if there is
    none. 'last' is the last value that is not null.

    `block` must not fall along `order`. Null keys are an entity; ties in `order` follow each other in any order."""
    names = list(wanted)
    rows = df.withColumn("__b", block).withColumns({f"__v_{n}": v for n, (_, v) in wanted.items()})
    place = F.struct(*[F.col(o) for o in order])
    per = []
    for n, (kind, _) in wanted.items():
        v = F.col(f"__v_{n}")
        per.append({"sum": F.sum(v), "max": F.max(v), "last": F.max_by(v, F.when(v.isNotNull(), place))}[kind].alias(f"__a_{n}"))
    blocks = rows.groupBy(*keys, "__b").agg(*per)
    over = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__b").alias("__cb"), *[_fold(kind, F.col(f"__a_{n}")).over(over).alias(f"__c_{n}") for n, (kind, _) in wanted.items()])
    on = F.col("__b").eqNullSafe(F.col("__cb"))
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    within = Window.partitionBy(*keys, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.join(carried, on)
    for n, (kind, _) in wanted.items():
        own, c = _fold(kind, F.col(f"__v_{n}")).over(within), F.col(f"__c_{n}")
        both = {"sum": F.when(own.isNull() & c.isNull(), None).otherwise(F.coalesce(own, F.lit(0)) + F.coalesce(c, F.lit(0))), "max": F.greatest(own, c), "last": F.coalesce(own, c)}[kind]
        out = out.withColumn(n, both)
    return out.select(*[c for c in df.columns if c not in names], *names)


def _fold(kind: str, v: Column) -> Column:
    return {"sum": F.sum, "max": F.max}[kind](v) if kind != "last" else F.last(v, ignorenulls=True)


def positions(order: str, size: int = POSITIONS) -> Column:
    """Blocks along an integral order column."""
    return F.floor(F.col(order) / size)


def hours(at: str) -> Column:
    """Blocks of an hour along a time column."""
    return F.date_trunc("hour", F.col(at))
