"""Sequence, join and interval operators against brute force on small fixtures."""

import random

import pytest
from pyspark.sql import functions as F

from sonograin.operators import relate, sequence
from sonograin.operators.sweep import periods_and_gaps, sweep


def brute_periods(iv):
    out, cur = [], None
    for a, b in sorted((a, b) for a, b in iv if a is not None and b is not None and b > a):
        if cur and a <= cur[1]:
            cur[1] = max(cur[1], b)
        else:
            cur = [a, b]
            out.append(cur)
    return {("period", a, b) for a, b in out} | {("gap", x[1], y[0]) for x, y in zip(out, out[1:])}


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_sweep(spark, block):
    rng = random.Random(block)
    rows = []
    for k in ("a", "b", None):
        rows += [(k, a, a + rng.choice([-1, 0, 1, 3, 40])) for a in (rng.randrange(300) for _ in range(40))]
    rows += [("a", None, 3), ("a", 3, None), ("c", 5, 5)] + rows[:5]
    df = spark.createDataFrame(rows, "k string, s int, e int").withColumn("at", F.lit("clash")).withColumn("open", F.lit(1))
    got = {}
    for r in sweep(df, ["k"], F.col("s"), F.col("e"), block).collect():
        got.setdefault(r["k"], set()).add((r["kind"], r["from_at"], r["to_at"]))
    want = {k: brute_periods([(a, b) for x, a, b in rows if x == k]) for k in ("a", "b", None)}
    assert got == want


def test_sweep_edges(spark):
    empty = spark.createDataFrame([], "book string, chapter int, start double, end double")
    assert periods_and_gaps(empty, ["book", "chapter"]).count() == 0
    df = spark.createDataFrame([("x", 1, 0.0, 1.0), ("x", 1, 1.0, 2.0), ("x", 1, 2.001, 3.0)], "book string, chapter int, start double, end double")
    rows = sorted((r["kind"], r["from_ms"], r["to_ms"]) for r in periods_and_gaps(df, ["book", "chapter"]).collect())
    assert rows == [("gap", 2000, 2001), ("period", 0, 2000), ("period", 2001, 3000)]


def test_islands_and_runs(spark):
    df = spark.createDataFrame([("a", i, x) for i, x in enumerate("1101110")], "k string, i int, x string")
    assert [(r["first_index"], r["last_index"], r["n"]) for r in sequence.islands(df, ["k"], "i", F.col("x") == "1", 3).collect()] == [(3, 5, 3)]
    df = spark.createDataFrame([("a", 0, 1), ("a", 1, 1), ("a", 2, None), ("a", 3, None), ("a", 4, 1)], "k string, i int, e int")
    assert [r["run"] for r in sequence.run_ids(df, ["k"], ["i"], F.col("e")).orderBy("i").collect()] == [1, 1, 2, 3, 4]


def test_drop_repeats_and_slices(spark):
    df = spark.createDataFrame([(1, 0, "x"), (1, 1, "x"), (1, 2, " "), (1, 3, "x"), (1, 4, "y" * 100), (1, 5, "y" * 100), (1, 6, None)], "d int, i int, t string")
    assert [r["i"] for r in sequence.drop_repeats(df, ["d"], ["i"], "t").orderBy("i").collect()] == [0, 4, 5]
    b = spark.createDataFrame([(1, 3, "a"), (1, 3, "b"), (1, 8, "c")], "d int, p int, t string")
    assert [tuple(r)[1:] for r in sequence.slices(b, ["d"], "p", "t", ["t"], F.lit(10)).orderBy("from_page").collect()] == [("a", 3, 7), ("c", 8, 10)]


def test_gaps_and_clamp(spark):
    df = spark.createDataFrame([("a", 0, 0.0, 5.0), ("a", 1, 2.0, 3.0), ("a", 2, 7.0, 8.0), ("a", 3, None, None)], "k string, i int, s double, e double")
    assert [r["gap"] for r in sequence.gaps(df, ["k"], "s", "e", ["i"]).orderBy("i").collect()] == [None, -3.0, 2.0]
    assert [r["clamped_end"] for r in sequence.clamp_to_next(df, ["k"], ["i"], "s", "e").orderBy("i").collect()] == [2.0, 3.0, 8.0, None]
    assert [(r["overlaps"], r["backwards"]) for r in sequence.order_faults(df, ["k"], "s", "e", ["i"]).orderBy("i").collect()] == [(False, False), (True, False), (False, False)]


def test_points_and_cover(spark):
    rng = random.Random(3)
    iv = [("a", x, x + rng.randrange(200)) for x in (rng.randrange(1000) for _ in range(30))]
    pts = [("a", i, rng.randrange(1300)) for i in range(200)]
    d, p = spark.createDataFrame(iv, "k string, s int, e int"), spark.createDataFrame(pts, "k string, i int, t int")
    inside = {i for _, i, t in pts if any(s - 5 <= t <= e + 5 for _, s, e in iv)}
    for how, want in (("left_semi", inside), ("left_anti", {i for _, i, _ in pts} - inside)):
        assert {r["i"] for r in relate.points_in_intervals(p, d, ["k"], F.col("t"), "s", "e", 5, 60, how).collect()} == want
    small = [("a", i, x, x + 10) for i, x in enumerate(range(0, 1200, 13))]
    want = {i for _, i, a, b in small if any(s <= a + 2 and e >= b - 2 for _, s, e in iv)}
    lf = spark.createDataFrame(small, "k string, i int, s int, e int")
    got = {r["i"] for r in relate.covered(lf, d, ["k"], "s", "e", 2, 60).collect()}
    assert got == want


def test_asof(spark):
    r = spark.createDataFrame([("a", 1, "x"), ("a", 5, "y"), ("a", 5, "z"), ("b", 2, "q")], "k string, t int, v string")
    left = spark.createDataFrame([("a", 0), ("a", 1), ("a", 7), ("b", 1), ("b", 9), ("a", None)], "k string, u int")
    got = {(x["k"], x["u"]): x["asof_v"] for x in relate.asof(left, r, ["k"], "u", "t", ["v"]).collect()}
    assert got == {("a", 0): None, ("a", 1): "x", ("a", 7): "z", ("b", 1): None, ("b", 9): "q", ("a", None): None}


def test_exact_starts(spark):
    toks = "a b c a b d a b c".split()
    seq = spark.createDataFrame([("k", i, t) for i, t in enumerate(toks)], "k string, i int, t string")
    ph = spark.createDataFrame([("k", 1, ["a", "b"]), ("k", 2, ["a", "b", "c"]), ("k", 3, ["d", "a", "b", "c"]), ("k", 4, ["x"]), ("k", 5, [])], "k string, p int, w array<string>")
    got = {(r["p"], r["start"]) for r in relate.exact_starts(ph, ["p"], "w", seq, ["k"], "i", "t").collect()}
    assert got == {(1, 0), (1, 3), (1, 6), (2, 0), (2, 6), (3, 5)}


def test_resolve_names(spark):
    c = spark.createDataFrame([("b", n) for n in (1, 2, 3, 4)], "book string, n bigint")
    f = spark.createDataFrame([("b", x) for x in ("chapter_01.mp3", "02 - Title.mp3", "Book 3 - 04.mp3", "Ch2.mp3", "chapter 1b.mp3")], "book string, name string")
    got = {r["n"]: (r["tier"], r["status"], r["file"]) for r in relate.resolve_names(c, f, ["book"], "n", "name").collect()}
    assert got == {1: (1, "ambiguous", None), 2: (1, "ok", "Ch2.mp3"), 3: (None, "missing", None), 4: (3, "ok", "Book 3 - 04.mp3")}


def test_records(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, None), (3, "d"), (4, "e")], "k int, v string")
    assert {(r["k"], r["change"]) for r in relate.changed(old, new, ["k"], ["v"]).collect()} == {(3, "changed"), (4, "added")}
    assert {tuple(r) for r in relate.upsert(old, new.where("k > 2"), ["k"]).collect()} == {(1, "a"), (2, None), (3, "d"), (4, "e")}
    assert {tuple(r) for r in relate.set_difference(old, new, ["k"]).collect()} == {(4, "right_only")}
    assert [r["v"] for r in relate.enrich(old, new, ["k"], ["v"]).orderBy("k").collect()] == ["a", None, "c"]


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_blocks_before(spark, size):
    from sonograin.operators import blocks

    rng = random.Random(size)
    rows = [(k, i, rng.choice([None, rng.randrange(9)])) for k in ("a", "b", None) for i in rng.sample(range(40), 25)]
    df = spark.createDataFrame(rows, "k string, i int, v int")
    got = blocks.before(df, ["k"], ["i"], blocks.positions("i", size), s=("sum", F.col("v")), m=("max", F.col("v")), last=("last", F.col("v"))).collect()
    assert len(got) == len(rows)
    for r in got:
        earlier = [v for k, i, v in sorted((x for x in rows if x[0] == r["k"]), key=lambda x: x[1]) if i < r["i"] and v is not None]
        assert (r["s"], r["m"], r["last"]) == ((sum(earlier), max(earlier), earlier[-1]) if earlier else (None, None, None))
    assert blocks.before(df.where("1 = 0"), ["k"], ["i"], blocks.positions("i"), s=("sum", F.col("v"))).count() == 0


def test_merge_and_sessions(spark):
    df = spark.createDataFrame([("a", 0, 5), ("a", 0, 5), ("a", 6, 7), ("a", 20, 30), ("a", 22, 23), ("a", 9, 8), ("a", None, 4)], "k string, s int, e int")
    for width in (1, 10, 1000):
        assert sorted((r["s"], r["e"], r["n"]) for r in sequence.merge_intervals(df, ["k"], "s", "e", 1, width).collect()) == [(0, 7, 3), (20, 30, 2)]
    t = spark.createDataFrame([("u", "2030-01-01 00:00:00"), ("u", "2030-01-01 00:00:00"), ("u", "2030-01-01 03:00:00"), ("u", None)], "u string, t string").select("u", F.to_timestamp("t").alias("t"))
    assert sorted(r["island"] for r in sequence.sessions(t, ["u"], "t", 3_600_000_000).collect()) == [1, 1, 2]
    assert [r["at"] for r in sequence.timeline(spark.createDataFrame([("a", i, d) for i, d in enumerate((5, None, 2))], "k string, i int, d int"), ["k"], ["i"], "d", 1).orderBy("i").collect()] == [0, 6, 7]
