"""

Range joins are never nested loops: points and intervals meet in bins of a fixed width and the exact predicate
follows; as-of joins are one sorted window over the union of both sides."""

from __future__ import annotations

import re
from collections import defaultdict
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sonograin.functions.text import natural_key
from sonograin.operators import blocks


def enrich(left: DataFrame, right: DataFrame, on: list[str], columns: list[str]) -> DataFrame:
    """JN-02: left join whose columns fill what is missing on the left; a value that is there wins."""
    side = right.select(*on, *[F.col(c).alias(f"__{c}") for c in columns])
    out = left.join(side, on, "left")
    for c in columns:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"__{c}")) if c in left.columns else F.col(f"__{c}"))
    return out.drop(*[f"__{c}" for c in columns])


def positional(left: DataFrame, right: DataFrame, keys: list[str], order: str, compare: list[str]) -> DataFrame:
    """JN-04, JN-23: rows paired by position: (keys, order, state) with 'equal', 'differs', 'left_only' or 'right_only'."""
    a = left.select(*keys, order, F.struct(*compare).alias("__a"))
    b = right.select(*keys, order, F.struct(*compare).alias("__b"))
    state = F.when(F.col("__b").isNull(), "left_only").when(F.col("__a").isNull(), "right_only").when(F.col("__a") == F.col("__b"), "equal").otherwise("differs")
    return a.join(b, [*keys, order], "full_outer").select(*keys, order, state.alias("state"))


def missing(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """JN-05: rows of the left that the right does not have (null keys match nothing and stay)."""
    return left.join(right.select(*on), on, "left_anti")


def set_difference(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """JN-06, SE-02: keys found on one side only: (on, side)."""
    a = left.select(*on).distinct().withColumn("__a", F.lit(1))
    b = right.select(*on).distinct().withColumn("__b", F.lit(1))
    both = a.join(b, on, "full_outer").where("__a IS NULL OR __b IS NULL")
    return both.select(*on, F.when(F.col("__b").isNull(), "left_only").otherwise("right_only").alias("side"))


def changed(old: DataFrame, new: DataFrame, on: list[str], compare: list[str]) -> DataFrame:
    """JN-07: rows of `new` that are not in `old` or differ in a compared column, nulls being equal: (on, change)."""
    side = old.select(*on, F.struct(*compare).alias("__o"), F.lit(True).alias("__in"))
    differs = ~F.struct(*[F.col(c) for c in compare]).eqNullSafe(F.col("__o"))
    out = new.join(side, on, "left").withColumn("change", F.when(F.col("__in").isNull(), "added").when(differs, "changed"))
    return out.where("change IS NOT NULL").select(*on, "change")


def upsert(old: DataFrame, new: DataFrame, on: list[str]) -> DataFrame:
    """JN-22: rows of `new` replace those of equal key, others are added. `new` must be unique by key."""
    return old.join(new.select(*on), on, "left_anti").unionByName(new)


def resolve_names(chapters: DataFrame, files: DataFrame, keys: list[str], number: str, name: str) -> DataFrame:
    """JN-08: file of each chapter by a cascade of rules: (keys, number, tier, status, file).

    Tier 1 'chapter/ch n', 2 a leading number, 3 a number set off by a delimiter and not behind book, part, vol, cd
    and the like, 4 the position in natural order of the files, if the name has no other number.  The first tier
    with a hit decides; more than one file in it is 'ambiguous', none at all 'missing'.  The number is read out of
    the name once per file and tier, so chapters and files meet by equality."""
    low = F.lower(F.col(name))
    explicit = F.regexp_extract_all(low, F.lit(r"(?<!\d)(?:chapter|ch)[ _-]*0*(\d+)(?!\d)"), 1)
    leading = F.regexp_extract_all(low, F.lit(r"^0*(\d+)(?:[-_ .]|$)"), 1)
    behind = r"(?:book|part|vol|volume|cd|disc|edition|act|scene|unit)\s*"
    delimited = F.regexp_extract_all(F.regexp_replace(low, behind + r"[-_ ]0*\d+", ""), F.lit(r"(?:[-_ ]|^)0*(\d+)(?!\d)"), 1)
    w = Window.partitionBy(*keys).orderBy(natural_key(F.col(name)), name)
    by_place = F.when(~low.rlike(r"\d"), F.array(F.row_number().over(w).cast("string"))).otherwise(F.array().cast("array<string>"))
    placed = files.withColumn("__place", by_place)
    tiers = placed.select(*keys, name, F.posexplode(F.array(explicit, leading, delimited, F.col("__place"))).alias("tier", "ns"))
    hits = tiers.select(*keys, name, (F.col("tier") + 1).alias("tier"), F.explode("ns").alias("__n")).withColumn("__n", F.expr("try_cast(__n AS bigint)")).distinct()
    best = hits.groupBy(*keys, "__n", "tier").agg(F.count("*").alias("n"), F.min(name).alias("file"))
    best = best.groupBy(*keys, "__n").agg(F.min_by(F.struct("tier", "n", "file"), "tier").alias("b"))
    out = chapters.join(best.withColumnRenamed("__n", number), [*keys, number], "left")
    status = F.when(F.col("b").isNull(), "missing").when(F.col("b.n") > 1, "ambiguous").otherwise("ok")
    return out.select(*keys, number, F.col("b.tier").alias("tier"), status.alias("status"), F.when(status == "ok", F.col("b.file")).alias("file"))


def _binned(df: DataFrame, lo: Column, hi: Column, width: float) -> DataFrame:
    return df.withColumn("__bin", F.explode(F.sequence(F.floor(lo / width), F.floor(hi / width))))


def points_in_intervals(points: DataFrame, intervals: DataFrame, keys: list[str], at: Column, start: str, end: str, tolerance: float = 0.0, width: float = 60.0, how: str = "left_semi") -> DataFrame:
    """JN-09, JN-10, RP-03: points that lie in an interval (`left_semi`), or in none (`left_anti`).

    An interval is put in every bin it touches and met by equality of the bin; null boundaries match nothing."""
    iv = intervals.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(end) >= F.col(start))).select(*[F.col(k).alias(f"__i{n}") for n, k in enumerate(keys)], F.col(start).alias("__s"), F.col(end).alias("__e"))
    iv = _binned(iv, F.col("__s") - tolerance, F.col("__e") + tolerance, width).withColumnRenamed("__bin", "__ibin")
    pts = points.withColumn("__at", at).withColumn("__bin", F.floor(F.col("__at") / width))
    on = (F.col("__bin") == F.col("__ibin")) & (F.col("__at") >= F.col("__s") - tolerance) & (F.col("__at") <= F.col("__e") + tolerance)
    for n, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__i{n}"))
    return pts.join(iv, on, how).drop("__at", "__bin")


def covered(left: DataFrame, right: DataFrame, keys: list[str], start: str, end: str, tolerance: float = 0.0, width: float = 60.0, how: str = "left_semi") -> DataFrame:
    """JN-11, JN-18: intervals of the left that one interval of the right covers (or none: `left_anti`).

    An interval that covers another also holds its start, so the start's bin is enough to meet."""
    iv = right.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(end) >= F.col(start))).select(*[F.col(k).alias(f"__i{n}") for n, k in enumerate(keys)], F.col(start).alias("__s"), F.col(end).alias("__e"))
    iv = _binned(iv, F.col("__s") - tolerance, F.col("__e") + tolerance, width).withColumnRenamed("__bin", "__ibin")
    lft = left.withColumn("__bin", F.floor(F.col(start) / width))
    on = (F.col("__bin") == F.col("__ibin")) & (F.col("__s") <= F.col(start) + tolerance) & (F.col("__e") >= F.col(end) - tolerance)
    for n, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__i{n}"))
    return lft.join(iv, on, how).drop("__bin")


def asof(left: DataFrame, right: DataFrame, keys: list[str], left_at: str, right_at: str, carry: list[str], block: Column | None = None) -> DataFrame:
    """JN-12: each left row with the carried columns of the last right row at or before it, null if there is none.

    Both sides share one order, scanned in blocks, so that no key is one task; of equal times the right row comes first. Of right
    rows at one time the one with the largest carried values counts. Rows of the left with null time get nulls.  `block` is
    computed from the column `__at`; default: 4096 units of a numeric time."""
    r = right.where(F.col(right_at).isNotNull()).groupBy(*keys, F.col(right_at).alias("__at")).agg(F.max(F.struct(*[F.col(c) for c in carry])).alias("__r"))
    lf = left.withColumn("__at", F.col(left_at)).withColumn("__row", F.struct(*left.columns))
    both = r.select(*keys, "__at", "__r", F.lit(None).cast(lf.schema["__row"].dataType).alias("__row"), F.lit(0).alias("__side")).unionByName(
        lf.select(*keys, "__at", F.lit(None).cast(r.schema["__r"].dataType).alias("__r"), "__row", F.lit(1).alias("__side"))
    )
    out = blocks.before(both, keys, ["__at", "__side"], blocks.positions("__at") if block is None else block, __last=("last", F.col("__r"))).where("__side = 1")
    return out.select("__row.*", *[F.when(F.col("__at").isNotNull(), F.col(f"__last.{c}")).alias(f"asof_{c}") for c in carry])


def ngram_starts(seq: DataFrame, keys: list[str], pos: str, token: str, n: int) -> DataFrame:
    """Windows of n consecutive tokens: (keys, start, gram). Sequences shorter than n give none."""
    w = Window.partitionBy(*keys).orderBy(pos).rowsBetween(0, n - 1)
    grams = seq.withColumn("__g", F.collect_list(F.col(token)).over(w)).where(F.size("__g") == n)
    return grams.select(*keys, F.col(pos).alias("start"), F.array_join("__g", " ").alias("gram"))


def _starts(head: int):
    def run(phrases: pd.DataFrame, seq: pd.DataFrame) -> pd.DataFrame:
        seq = seq.sort_values("start", kind="stable")
        words = seq["__t"].tolist()
        heads: dict[tuple, list[int]] = defaultdict(list)
        for i in range(len(words)):
            for k in range(1, min(head, len(words) - i) + 1):
                heads[tuple(words[i : i + k])].append(i)
        rows, places = [], []
        for r, w in enumerate(map(list, phrases["__w"])):
            at = [i for i in heads.get(tuple(w[:head]), ()) if words[i : i + len(w)] == w]
            rows += [r] * len(at)
            places += at
        return phrases.drop(columns="__w").iloc[rows].assign(start=seq["start"].iloc[places].to_numpy())

    return run


def exact_starts(phrases: DataFrame, phrase_key: list[str], tokens: str, seq: DataFrame, keys: list[str], pos: str, token: str) -> DataFrame:
    """JN-14: every position at which a phrase's tokens stand in a sequence of the same keys.

    The first min(3, length) tokens meet by hash, all of them are compared, whatever the length; a phrase of no tokens, or with
    a null one, has none. Null keys meet nothing. A kernel: it holds one sequence and its phrases in memory."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    ph = phrases.where(known & (F.size(tokens) > 0) & ~F.exists(tokens, lambda x: x.isNull()))
    ph = ph.select(*keys, *[c for c in phrase_key if c not in keys], F.col(tokens).alias("__w"))
    s = seq.where(known & F.col(pos).isNotNull()).select(*keys, F.col(pos).alias("start"), F.col(token).alias("__t"))
    schema = StructType([*ph.drop("__w").schema.fields, s.schema["start"]])
    return ph.groupBy(*keys).cogroup(s.groupBy(*keys)).applyInPandas(_starts(3), schema)


def repeats(df: DataFrame, keys: list[str], order: str, tokens: Column, least: int = 4) -> DataFrame:
    """JN-19 exact: rows whose tokens, at least `least`, stood in an earlier row of the entity."""
    w = Window.partitionBy(*keys, "__t").orderBy(order)
    rows = df.withColumn("__t", F.array_join(tokens, " ")).where(F.size(tokens) >= least)
    return rows.withColumn("__r", F.row_number().over(w)).where("__r > 1").drop("__r", "__t")


def marker_pattern(marker: str) -> str:
    """Whole-word pattern of a marker."""
    return rf"(?<![a-z0-9]){re.escape(marker.lower())}(?![a-z0-9])"
