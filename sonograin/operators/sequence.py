"""

Every operator takes the entity's key columns and explicit order columns.  Running values (gaps, faults, sessions, balances,
timelines, merged intervals) are computed in blocks (module blocks), so that no entity is one task; the rest looks at direct
neighbours within a chapter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonograin.operators import blocks


def _w(keys: list[str], order: list[Column | str]):
    return Window.partitionBy(*keys).orderBy(*order)


def before(keys: list[str], order: list[Column | str]):
    """Frame of all earlier rows of the entity."""
    return _w(keys, order).rowsBetween(Window.unboundedPreceding, -1)


def drop_repeats(df: DataFrame, keys: list[str], order: list[str], text: str, under: int = 100) -> DataFrame:
    """WN-01: a row equal to the one before it (blank rows aside) and shorter than `under` is dropped; blank rows too.

    Null text counts as blank. A dropped row equals the row it followed, so comparing with the row before is
    comparing with the last kept one."""
    rows = df.where(F.trim(F.col(text)) != "").withColumn("__t", F.trim(F.col(text)))
    prev = F.lag("__t").over(_w(keys, order))
    return rows.withColumn("__p", prev).where(~F.col("__t").eqNullSafe(F.col("__p")) | (F.length("__t") >= under)).drop("__t", "__p")


def gaps(df: DataFrame, keys: list[str], start: str, end: str, order: list[str]) -> DataFrame:
    """WN-03: `gap` = start - latest end of all earlier rows; null for the first. Rows with a null start or end are left out.
    The first order column is integral."""
    rows = df.where(F.col(start).isNotNull() & F.col(end).isNotNull())
    out = blocks.before(rows, keys, order, blocks.positions(order[0]), __latest=("max", F.col(end)))
    return out.withColumn("gap", F.col(start) - F.col("__latest")).drop("__latest")


def order_faults(df: DataFrame, keys: list[str], start: str, end: str, order: list[str], tolerance: float = 0.05) -> DataFrame:
    """WN-04: `overlaps` (start before the latest earlier end by more than the tolerance), `backwards` (start before the previous
    start). The first order column is integral."""
    rows = df.where(F.col(start).isNotNull())
    out = blocks.before(rows, keys, order, blocks.positions(order[0]), __latest=("max", F.col(end)), __last=("last", F.col(start)))
    out = out.withColumn("overlaps", F.coalesce(F.col(start) < F.col("__latest") - tolerance, F.lit(False)))
    return out.withColumn("backwards", F.coalesce(F.col(start) < F.col("__last"), F.lit(False))).drop("__latest", "__last")


def run_ids(df: DataFrame, keys: list[str], order: list[str], by: Column) -> DataFrame:
    """WN-05: number of the run of equal `by` values a row belongs to; null starts a run of its own, always."""
    w = _w(keys, order)
    changed = by.isNull() | ~by.eqNullSafe(F.lag(by).over(w)) | F.lag(F.lit(1)).over(w).isNull()
    return df.withColumn("__c", changed.cast("int")).withColumn("run", F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__c")


def islands(df: DataFrame, keys: list[str], index: str, keep: Column, least: int) -> DataFrame:
    """WN-07: runs of rows for which `keep` holds, over consecutive values of the whole sequence, of at least `least` rows:
    (keys, first_index, last_index, n). Index values must be unique per entity; gaps in them separate nothing."""
    w = _w(keys, [index])
    numbered = df.withColumn("__n", F.row_number().over(w)).where(keep)
    grouped = numbered.withColumn("__g", F.col("__n") - F.row_number().over(w))
    return grouped.groupBy(*keys, "__g").agg(F.min(index).alias("first_index"), F.max(index).alias("last_index"), F.count("*").alias("n")).where(F.col("n") >= least).drop("__g")


def sessions(df: DataFrame, keys: list[str], at: str, gap_us: int) -> DataFrame:
    """Gap islands of a timed stream: rows whose distance to the row before exceeds `gap_us` microseconds open a new island,
    numbered from 1. Rows of one time are in one island; rows without a time are left out."""
    times = df.select(*keys, at).where(F.col(at).isNotNull()).distinct()
    steps = blocks.before(times, keys, [at], blocks.hours(at), __p=("last", F.col(at)))
    new = F.coalesce(F.timestamp_diff("MICROSECOND", F.col("__p"), F.col(at)) > gap_us, F.lit(True)).cast("int")
    numbered = blocks.before(steps.withColumn("__new", new), keys, [at], blocks.hours(at), __sum=("sum", F.col("__new")))
    numbered = numbered.select(*[F.col(k).alias(f"__s{i}") for i, k in enumerate(keys)], F.col(at).alias("__t"), (F.coalesce("__sum", F.lit(0)) + F.col("__new")).alias("island"))
    on = F.col(at) == F.col("__t")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__s{i}"))
    return df.join(numbered, on).drop("__t", *[f"__s{i}" for i in range(len(keys))])


def merge_intervals(df: DataFrame, keys: list[str], start: str, end: str, within: int = 0, width: int = 300_000) -> DataFrame:
    """WN-09: intervals nearer than `within` to the latest end so far become one: (keys, start, end, n). Boundaries are integral."""
    rows = df.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(end) >= F.col(start))).select(*keys, start, end)
    block = F.floor(F.col(start) / width)
    seen = blocks.before(rows, keys, [start, end], block, __seen=("max", F.col(end)))
    new = F.coalesce(F.col(start) > F.col("__seen") + within, F.lit(True)).cast("int")
    marked = seen.withColumn("__n", new)
    # of equal rows the one that opens comes first
    order = [start, end, F.desc("__n")]
    per = marked.withColumn("__b", block)
    w = Window.partitionBy(*keys, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sums = per.groupBy(*keys, "__b").agg(F.sum("__n").alias("__s"))
    carry = sums.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__b").alias("__cb"), F.coalesce(F.sum("__s").over(before(keys, ["__b"])), F.lit(0)).alias("__c"))
    on = F.col("__b") == F.col("__cb")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    grouped = per.withColumn("__own", F.sum("__n").over(w)).join(carry, on).withColumn("__g", F.col("__own") + F.col("__c"))
    return grouped.groupBy(*keys, "__g").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n")).drop("__g")


def running_balance(df: DataFrame, keys: list[str], order: list[str], opens: Column, closes: Column) -> DataFrame:
    """WN-10: `depth` after each row: openings minus closings so far. The first order column is integral."""
    out = blocks.before(df.withColumn("__d", opens - closes), keys, order, blocks.positions(order[0]), depth=("sum", F.col("__d")))
    return out.withColumn("depth", F.coalesce("depth", F.lit(0)) + F.col("__d")).drop("__d")


def sequence_ids(df: DataFrame, keys: list[str], order: list[str], prefix: str = "s-", first: int = 0) -> DataFrame:
    """WN-11: `seq` and `id` by position."""
    return df.withColumn("seq", F.row_number().over(_w(keys, order)) - 1 + first).withColumn("id", F.concat(F.lit(prefix), F.col("seq").cast("string")))


def batches(df: DataFrame, keys: list[str], order: list[str], size: int) -> DataFrame:
    """WN-12: number of the batch of `size` rows a row falls in, from 0."""
    return df.withColumn("batch", F.floor((F.row_number().over(_w(keys, order)) - 1) / size).cast("bigint"))


def timeline(df: DataFrame, keys: list[str], order: list[str], duration: str, pause: float) -> DataFrame:
    """WN-13: `at`, where each piece starts when pieces follow each other with a pause; null durations last nothing. The first
    order column is integral."""
    step = F.coalesce(F.col(duration), F.lit(0)) + pause
    return blocks.before(df, keys, order, blocks.positions(order[0]), at=("sum", step)).withColumn("at", F.coalesce("at", F.lit(0)))


def repeated_starts(df: DataFrame, keys: list[str], order: list[str], start: str) -> DataFrame:
    """WN-17: rows that start exactly when the row before starts."""
    return df.withColumn("__p", F.lag(start).over(_w(keys, order))).where(F.col("__p") == F.col(start)).drop("__p")


def slices(df: DataFrame, keys: list[str], page: str, title: str, order: list[str], last_page: Column) -> DataFrame:
    """WN-18: bookmarks cut a range of pages: the first bookmark of a page runs to before the next one's page."""
    first = df.withColumn("__r", F.row_number().over(Window.partitionBy(*keys, page).orderBy(*order))).where("__r = 1").drop("__r")
    return first.select(*keys, title, F.col(page).alias("from_page"), F.coalesce(F.lead(page).over(_w(keys, [page])) - 1, last_page).alias("to_page"))


def display_numbers(df: DataFrame, keys: list[str], order: list[str], counts: Column, given: str) -> DataFrame:
    """WN-19: display number: the one given, else the next count of rows that count."""
    w = _w(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("shown", F.when(counts, F.coalesce(F.col(given), F.sum((counts & F.col(given).isNull()).cast("int")).over(w).cast("int"))))


def neighbours(df: DataFrame, keys: list[str], order: list[str], anchored: Column, value: Column) -> DataFrame:
    """JN-13: value of the nearest anchored row before (`previous`) and after (`following`), by position."""
    w = Window.partitionBy(*keys).orderBy(*order)
    v = F.when(anchored, value)
    return df.withColumn("previous", F.last(v, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn("following", F.first(v, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)))


def clamp_to_next(df: DataFrame, keys: list[str], order: list[str], start: str, end: str) -> DataFrame:
    """WN-14 (clamp only): an end behind the next playable start is cut to it, never before its own start."""
    nxt = F.first(F.col(start), ignorenulls=True).over(_w(keys, order).rowsBetween(1, Window.unboundedFollowing))
    cut = F.when((F.col(end) > nxt) & (nxt >= F.col(start)), nxt).otherwise(F.col(end))
    return df.withColumn("clamped_end", cut)


def word_spans(df: DataFrame, keys: list[str], order: str, weight: Column, start: str, end: str) -> DataFrame:
    """SC-12: words of a sentence share its time by weight: span_start, span_end in milliseconds, at least 10 ms each,
    the last pinned to the sentence's end."""
    w = Window.partitionBy(*keys).orderBy(order)
    whole = Window.partitionBy(*keys)
    dur = F.greatest(F.lit(0.01), F.col(end) - F.col(start))
    rows = df.withColumn("__w", weight)
    upto = F.sum("__w").over(w.rowsBetween(Window.unboundedPreceding, 0)) / F.sum("__w").over(whole)
    frm = F.coalesce(F.sum("__w").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)) / F.sum("__w").over(whole)
    last = F.lead(F.lit(1)).over(w).isNull()
    rows = rows.withColumn("span_start", F.round(F.col(start) + frm * dur, 3)).withColumn("span_end", F.when(last, F.round(F.col(end), 3)).otherwise(F.round(F.col(start) + upto * dur, 3)))
    return rows.withColumn("span_end", F.when(F.col("span_end") <= F.col("span_start"), F.round(F.col("span_start") + 0.01, 3)).otherwise(F.col("span_end"))).drop("__w")
