"""Runs of repeated consecutive events collapsed to one event each (problem 2).

Boundary interval lookup: within a chunk of an entity the positions at which runs start are gathered
into a sorted array; every event finds its run by binary search in it; then runs are aggregated.
Chunks keep a hot entity from becoming one task; runs that cross a chunk border are joined through the
summaries of the chunks (one row each), never through the events.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions in a chunk of an entity.
CHUNK = 8192
#: Least length at which two keys one edit apart are alike.
NEAR_LENGTH = 5


def within_one_edit(a: str, b: str) -> bool:
    """Whether a and b differ by at most one character changed, added or missing."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def alike(a: str, b: str, near: int = NEAR_LENGTH) -> bool:
    """Equal keys, or keys of at least `near` characters one edit apart."""
    return a == b or (len(a) >= near and len(b) >= near and within_one_edit(a, b))


def _collapse(n_keys: int, near: int):
    """Arrow function: events sorted by (keys, chunk, pos) to partial runs of each chunk."""

    def close(events: pa.Table):
        ent = events.column("__ent").to_numpy()
        chunk = events.column("__chunk").to_numpy()
        pos = events.column("__pos").to_numpy()
        key = events.column("__key").to_numpy(zero_copy_only=False)
        size = events.column("__len").to_numpy()
        code = events.column("__code").to_numpy()
        n = len(pos)
        head = np.ones(n, bool)  # first event of its chunk
        head[1:] = (ent[1:] != ent[:-1]) | (chunk[1:] != chunk[:-1])
        # one event a position: repeated deliveries follow each other
        keep = head.copy()
        keep[1:] |= pos[1:] != pos[:-1]
        if not keep.all():
            rows = np.flatnonzero(keep)
            events, ent, pos, key, size, code, head = events.take(pa.array(rows)), ent[rows], pos[rows], key[rows], size[rows], code[rows], head[rows]
            n = len(pos)
        same = np.zeros(n, bool)
        same[1:] = ~head[1:] & (code[1:] == code[:-1])
        maybe = np.flatnonzero(~same[1:] & ~head[1:] & (size[1:] >= near) & (size[:-1] >= near) & (np.abs(size[1:] - size[:-1]) <= 1)) + 1
        for i in maybe:
            a, b = key[i - 1], key[i]
            if (a[0] == b[0] or a[-1] == b[-1]) and within_one_edit(a, b):
                same[i] = True
        starts = np.flatnonzero(~same)  # the sorted array of run starts
        run = np.searchsorted(starts, np.arange(n), "right") - 1  # each event's run by binary search
        last = np.append(starts[1:], n) - 1
        begin = events.column("__start").to_numpy()
        end = events.column("__end").to_numpy()
        lo = np.fmin.reduceat(begin, starts) if n else begin
        hi = np.fmax.reduceat(end, starts) if n else end
        out = {f"__k{i}": events.column(f"__k{i}").take(pa.array(starts)) for i in range(n_keys)}
        out |= {"__ent": ent[starts], "__chunk": events.column("__chunk").to_numpy()[starts], "first_pos": pos[starts], "last_pos": pos[last]}
        out |= {"n": np.bincount(run, minlength=len(starts)).astype("int64"), "first_key": events.column("__key").take(pa.array(starts)), "last_key": events.column("__key").take(pa.array(last))}
        out |= {"begin": lo, "finish": hi, "chunk_head": head[starts], "chunk_tail": np.append(head[starts][1:], True)}
        return pa.table({k: v if isinstance(v, (pa.ChunkedArray, pa.Array)) else pa.array(v, from_pandas=k in ("begin", "finish")) for k, v in out.items()})

    def run(batches):
        left: list[pa.RecordBatch] = []
        rows = 0
        for b in batches:
            if not b.num_rows:
                continue
            left.append(b)
            rows += b.num_rows
            if rows < 65536:
                continue
            t = pa.Table.from_batches(left)
            ent, chunk = t.column("__ent").to_numpy(), t.column("__chunk").to_numpy()
            cut = np.flatnonzero((ent[1:] != ent[:-1]) | (chunk[1:] != chunk[:-1]))
            if len(cut):  # the last chunk may go on in the next batch
                yield from close(t.slice(0, int(cut[-1]) + 1)).to_batches()
                t = t.slice(int(cut[-1]) + 1)
            left, rows = t.combine_chunks().to_batches(), t.num_rows
        if left:
            yield from close(pa.Table.from_batches(left)).to_batches()

    return run


def _nullable(c: str) -> Column:
    return F.col(c).cast("double")


def collapse_runs(df: DataFrame, keys: list[str], pos: str, key: Column, start: str, end: str, chunk: int = CHUNK, near: int = NEAR_LENGTH) -> DataFrame:
    """One row per maximal run: (keys, first_index, last_index, count, key, duration).

    Events are alike if their keys are equal, or both have `near` characters and are one edit apart,
    each compared with the one before it in `pos` order; missing positions separate nothing.  Rows whose
    key or position is null are no events.  A position delivered more than once counts once (the
    smallest key, then the earliest start).  Duration is the latest end minus the earliest start; null if
    the run has no start or no end.  Null entity keys form an entity.  Empty in, empty out."""
    names = [f"__k{i}" for i in range(len(keys))]
    kinds = dict(df.dtypes)
    ev = df.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(pos).cast("bigint").alias("__pos"), key.alias("__key"),
        _nullable(f"`{start}`").alias("__start"), _nullable(f"`{end}`").alias("__end"),
    ).where("__key IS NOT NULL AND __pos IS NOT NULL")
    ev = ev.withColumns({"__chunk": F.floor(F.col("__pos") / chunk), "__ent": F.xxhash64(*names), "__len": F.length("__key"), "__code": F.xxhash64("__key")})
    ev = ev.repartition("__ent", "__chunk").sortWithinPartitions("__ent", *names, "__chunk", "__pos", "__key", "__start")
    shape = ", ".join(f"{n} {kinds[k]}" for k, n in zip(keys, names, strict=True))
    shape += ", __ent bigint, __chunk bigint, first_pos bigint, last_pos bigint, n bigint, first_key string, last_key string, begin double, finish double, chunk_head boolean, chunk_tail boolean"
    parts = ev.mapInArrow(_collapse(len(keys), near), shape)
    # Only the first and last run of a chunk can go on over its border, and only into the first run of the next chunk:
    # a run there is new unless it heads its chunk and its first key is alike to the last key before.
    edge = parts.where("chunk_head OR chunk_tail")
    order = Window.partitionBy(*names).orderBy("__chunk", "first_pos")
    a, b = F.lag("last_key").over(order), F.col("first_key")
    goes_on = F.col("chunk_head") & ((a == b) | ((F.length(a) >= near) & (F.length(b) >= near) & (F.levenshtein(a, b) <= 1)))
    edge = edge.withColumn("new", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1))
    edge = edge.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    crossing = edge.groupBy(*names, "run").agg(
        F.min("first_pos").alias("first_pos"), F.max("last_pos").alias("last_pos"), F.sum("n").alias("n"), F.min_by("first_key", "first_pos").alias("first_key"), F.min("begin").alias("begin"), F.max("finish").alias("finish"),
    )
    cols = [*names, "first_pos", "last_pos", "n", "first_key", "begin", "finish"]
    runs = parts.where("NOT chunk_head AND NOT chunk_tail").select(cols).unionByName(crossing.select(cols))
    return runs.select(
        *[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)], F.col("first_pos").alias("first_index"), F.col("last_pos").alias("last_index"),
        F.col("n").alias("count"), F.col("first_key").alias("key"), (F.col("finish") - F.col("begin")).alias("duration"),
    )
