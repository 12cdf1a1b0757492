"""Queries over timed intervals and event streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sonograin.operators import blocks, relate, sequence
from sonograin.operators.sweep import periods_and_gaps
from sonograin.plans.catalog import query
from sonograin.tables import once, table


@query("""
WITH iv AS (
  SELECT book, chapter, CAST(round("start" * 1000) AS BIGINT) AS a, CAST(round("end" * 1000) AS BIGINT) AS b
  FROM aligned_sentences WHERE "end" > "start"
), good AS (SELECT * FROM iv WHERE b > a),
marked AS (
  SELECT *, max(b) OVER (PARTITION BY book, chapter ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM good
), numbered AS (
  SELECT *, sum(CASE WHEN seen IS NULL OR a > seen THEN 1 ELSE 0 END) OVER (PARTITION BY book, chapter ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM marked
), periods AS (SELECT book, chapter, min(a) AS from_ms, max(b) AS to_ms FROM numbered GROUP BY book, chapter, g)
SELECT book, chapter, 'period' AS kind, from_ms, to_ms FROM periods
UNION ALL
SELECT book, chapter, 'gap', to_ms, nxt FROM (
  SELECT book, chapter, to_ms, lead(from_ms) OVER (PARTITION BY book, chapter ORDER BY from_ms) AS nxt FROM periods) WHERE nxt IS NOT NULL
""")
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged periods of the aligned sentences of each chapter, and the gaps between them."""
    return periods_and_gaps(table(spark, sf_dir, "aligned_sentences"), ["book", "chapter"])


#: Aligned sentences counted once; the SQL side has the same rows.
ALIGNED_SQL = 'SELECT DISTINCT book, chapter, seq, id, source_text, "start" AS s, "end" AS e, raw_start, raw_end, word_start, word_end, has_audio_match, matched_token_count, source_token_count, match_ratio, alignment_method, fallback_used, alignment_status, alignment_reason, is_heading FROM aligned_sentences'
WORDS_SQL = 'SELECT DISTINCT book, chapter, token_index, word, "start" AS s, "end" AS e, probability FROM acoustic_words'


def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned sentences counted once, times as s and e."""
    return once(table(spark, sf_dir, "aligned_sentences")).withColumnsRenamed({"start": "s", "end": "e"})


def spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acoustic words counted once, times as s and e."""
    return once(table(spark, sf_dir, "acoustic_words")).withColumnsRenamed({"start": "s", "end": "e"})


CH = ["book", "chapter"]
_MS = "CAST(round({} * 1000) AS BIGINT)"


def ms(c: str):
    """Seconds as whole milliseconds."""
    return F.round(F.col(c) * 1000).cast("bigint")


@query(f"""
WITH a AS ({ALIGNED_SQL}), m AS (SELECT book, chapter, seq, {_MS.format('s')} AS a, {_MS.format('e')} AS b FROM a WHERE s IS NOT NULL AND e IS NOT NULL)
SELECT book, chapter, seq, a, b, a - max(b) OVER (PARTITION BY book, chapter ORDER BY seq, a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap FROM m
""")
def timeline_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-03 on the aligned sentences, in milliseconds."""
    df = aligned(spark, sf_dir).select(*CH, "seq", ms("s").alias("a"), ms("e").alias("b"))
    return sequence.gaps(df, CH, "a", "b", ["seq", "a", "b"])


@query(f"""
WITH a AS ({ALIGNED_SQL}), m AS (SELECT book, chapter, seq, {_MS.format('s')} AS a, {_MS.format('e')} AS b FROM a WHERE s IS NOT NULL)
SELECT book, chapter, seq, a,
  coalesce(a < max(b) OVER (PARTITION BY book, chapter ORDER BY seq, a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 50, false) AS overlaps,
  coalesce(a < lag(a) OVER (PARTITION BY book, chapter ORDER BY seq, a, b), false) AS backwards FROM m
""")
def timeline_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-04 on the aligned sentences: overlaps of over 50 ms, starts that run backwards."""
    df = aligned(spark, sf_dir).select(*CH, "seq", ms("s").alias("a"), ms("e").alias("b"))
    return sequence.order_faults(df, CH, "a", "b", ["seq", "a", "b"], 50).select(*CH, "seq", "a", "overlaps", "backwards")


@query(f"""
WITH a AS ({ALIGNED_SQL}), m AS (SELECT book, chapter, {_MS.format('s')} AS a, {_MS.format('e')} AS b FROM a WHERE s IS NOT NULL AND e IS NOT NULL AND e >= s),
k AS (SELECT *, max(b) OVER (PARTITION BY book, chapter ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM m),
g AS (SELECT *, sum(CASE WHEN seen IS NULL OR a > seen + 250 THEN 1 ELSE 0 END) OVER (PARTITION BY book, chapter ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM k)
SELECT book, chapter, min(a) AS a, max(b) AS b, count(*) AS n FROM g GROUP BY book, chapter, g
""")
def interval_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-09: sentence intervals nearer than 250 ms merged."""
    df = aligned(spark, sf_dir).where("e >= s").select(*CH, ms("s").alias("a"), ms("e").alias("b"))
    return sequence.merge_intervals(df, CH, "a", "b", 250)


@query("""
WITH o AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events),
n AS (SELECT *, CASE WHEN p IS NULL OR date_diff('microsecond', p, ts) > 36000000000 THEN 1 ELSE 0 END AS nw FROM o),
i AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS island FROM n)
SELECT user_id, CAST(island AS BIGINT) AS island, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM i GROUP BY user_id, island
""")
def timeline_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap islands of the event stream per user: over ten hours apart opens a new one."""
    df = sequence.sessions(table(spark, sf_dir, "events"), ["user_id"], "ts", 36_000_000_000)
    return df.groupBy("user_id", "island").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query(f"""
WITH w AS (SELECT DISTINCT book, chapter, token_index FROM acoustic_words),
c AS (SELECT DISTINCT book, chapter, word_start, word_end FROM aligned_sentences WHERE has_audio_match AND word_end >= word_start),
f AS (SELECT w.*, NOT EXISTS (SELECT 1 FROM c WHERE c.book = w.book AND c.chapter = w.chapter AND w.token_index BETWEEN c.word_start AND c.word_end) AS free FROM w),
n AS (SELECT *, row_number() OVER (PARTITION BY book, chapter ORDER BY token_index) AS r FROM f),
g AS (SELECT *, r - row_number() OVER (PARTITION BY book, chapter ORDER BY token_index) AS g FROM n WHERE free)
SELECT book, chapter, min(token_index) AS first_index, max(token_index) AS last_index, count(*) AS n FROM g GROUP BY book, chapter, g HAVING count(*) >= 3
""")
def unclaimed_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-07: runs of at least three words that no matched sentence claims."""
    words = table(spark, sf_dir, "acoustic_words").select(*CH, "token_index").distinct()
    claims = table(spark, sf_dir, "aligned_sentences").where("has_audio_match AND word_end >= word_start").select(*CH, "word_start", "word_end").distinct()
    free = relate.points_in_intervals(words, claims, CH, F.col("token_index"), "word_start", "word_end", width=64, how="left_anti").withColumn("free", F.lit(True))
    marked = words.join(free, [*CH, "token_index"], "left")
    return sequence.islands(marked, CH, "token_index", F.col("free"), 3)


@query(f"""
WITH w AS ({WORDS_SQL}), a AS ({ALIGNED_SQL})
SELECT w.book, w.chapter, w.token_index FROM w WHERE s IS NOT NULL AND EXISTS (
  SELECT 1 FROM a WHERE a.book = w.book AND a.chapter = w.chapter AND a.e >= a.s
  AND {_MS.format('(w.s + w.e) / 2')} BETWEEN {_MS.format('a.s')} - 200 AND {_MS.format('a.e')} + 200)
""")
def words_in_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-09: words whose middle lies in a sentence's time, 200 ms of tolerance."""
    w = spoken(spark, sf_dir).select(*CH, "token_index", F.round((F.col("s") + F.col("e")) / 2 * 1000).cast("bigint").alias("m"))
    iv = aligned(spark, sf_dir).where("e >= s").select(*CH, ms("s").alias("a"), ms("e").alias("b")).distinct()
    return relate.points_in_intervals(w, iv, CH, F.col("m"), "a", "b", 200, 20_000).select(*CH, "token_index")


@query(f"""
WITH w AS ({WORDS_SQL}), a AS ({ALIGNED_SQL})
SELECT w.book, w.chapter, w.token_index FROM w WHERE s IS NOT NULL AND e IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM a WHERE a.book = w.book AND a.chapter = w.chapter AND a.e >= a.s
  AND {_MS.format('(w.s + w.e) / 2')} BETWEEN {_MS.format('a.s')} AND {_MS.format('a.e')})
""")
def words_outside_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-10: words whose middle lies in no sentence's time."""
    w = spoken(spark, sf_dir).where("s IS NOT NULL AND e IS NOT NULL").select(*CH, "token_index", F.round((F.col("s") + F.col("e")) / 2 * 1000).cast("bigint").alias("m"))
    iv = aligned(spark, sf_dir).where("e >= s").select(*CH, ms("s").alias("a"), ms("e").alias("b")).distinct()
    return relate.points_in_intervals(w, iv, CH, F.col("m"), "a", "b", 0, 20_000, "left_anti").select(*CH, "token_index")


@query(f"""
WITH a AS ({ALIGNED_SQL}), m AS (SELECT book, chapter, seq, id, {_MS.format('s')} AS a, {_MS.format('e')} AS b FROM a WHERE e > s)
SELECT x.book, x.chapter, x.id, x.a, x.b FROM m x WHERE EXISTS (
  SELECT 1 FROM m y WHERE y.book = x.book AND y.chapter = x.chapter AND y.id <> x.id AND y.a <= x.a AND y.b >= x.b)
""")
def interval_covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-11, JN-18: sentence intervals inside another sentence's interval."""
    m = aligned(spark, sf_dir).where("e > s").select(*CH, "id", ms("s").alias("a"), ms("e").alias("b"))
    # one other interval is wanted, not the own: count the covering ones, the own is one of them
    own = m.groupBy(*CH, "id", "a", "b").count().drop("count")
    other = m.select(*CH, F.col("id").alias("oid"), F.col("a").alias("oa"), F.col("b").alias("ob"))
    bins = other.withColumn("bin", F.explode(F.sequence(F.floor(F.col("oa") / 20_000), F.floor(F.col("ob") / 20_000))))
    hit = own.withColumn("bin", F.floor(F.col("a") / 20_000)).join(bins, [*CH, "bin"]).where("oid <> id AND oa <= a AND ob >= b")
    return hit.select(*CH, "id", "a", "b").distinct()


@query("""
WITH p AS (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'signup' AND ts IS NOT NULL GROUP BY user_id, ts)
SELECT e.event_id, p.value AS asof_value FROM events e ASOF LEFT JOIN p ON e.user_id = p.user_id AND e.ts >= p.ts
""")
def asof_last_signup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-12: each event with the value of the user's last signup at or before it."""
    ev = table(spark, sf_dir, "events")
    return relate.asof(ev.select("event_id", "user_id", "ts"), ev.where("event_type = 'signup'").select("user_id", "ts", "value"), ["user_id"], "ts", "ts", ["value"], blocks.hours("__at")).select("event_id", "asof_value")


@query(f"""
WITH w AS ({WORDS_SQL}), a AS ({ALIGNED_SQL}),
st AS (SELECT book, chapter, {_MS.format('s')} AS a, max(({_MS.format('e')})) AS b FROM a WHERE s IS NOT NULL AND e IS NOT NULL GROUP BY 1, 2, 3),
nx AS (SELECT *, lead(a) OVER (PARTITION BY book, chapter ORDER BY a) AS n FROM st),
t AS (SELECT book, chapter, token_index, {_MS.format('s')} AS t FROM w WHERE s IS NOT NULL)
SELECT t.book, t.chapter, t.token_index, CASE WHEN t.t < nx.b OR (t.t - nx.b <= 1500 AND (nx.n IS NULL OR t.t < nx.n)) THEN nx.a END AS sentence_at
FROM t ASOF LEFT JOIN nx ON t.book = nx.book AND t.chapter = nx.chapter AND t.t >= nx.a
""")
def playback_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-12: the sentence at a word's start: the last that has begun, if it still runs or ended at most 1.5 s ago."""
    st = aligned(spark, sf_dir).where("s IS NOT NULL AND e IS NOT NULL").groupBy(*CH, ms("s").alias("a")).agg(F.max(ms("e")).alias("b"))
    st = st.withColumn("n", F.lead("a").over(Window.partitionBy(*CH).orderBy("a"))).withColumn("k", F.col("a"))
    t = spoken(spark, sf_dir).where("s IS NOT NULL").select(*CH, "token_index", ms("s").alias("t"))
    j = relate.asof(t, st, CH, "t", "a", ["k", "b", "n"], F.floor(F.col("__at") / 300_000))
    runs = (F.col("t") < F.col("asof_b")) | ((F.col("t") - F.col("asof_b") <= 1500) & (F.col("asof_n").isNull() | (F.col("t") < F.col("asof_n"))))
    return j.select(*CH, "token_index", F.when(runs, F.col("asof_k")).alias("sentence_at"))


@query(f"""
WITH a AS ({ALIGNED_SQL})
SELECT book, chapter, seq, id,
  last_value(CASE WHEN has_audio_match THEN word_end END IGNORE NULLS) OVER (PARTITION BY book, chapter ORDER BY seq, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous,
  first_value(CASE WHEN has_audio_match THEN word_start END IGNORE NULLS) OVER (PARTITION BY book, chapter ORDER BY seq, id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS following
FROM a
""")
def matched_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-13: nearest matched sentence before and after, by position."""
    df = aligned(spark, sf_dir)
    left = sequence.neighbours(df, CH, ["seq", "id"], F.col("has_audio_match"), F.col("word_end")).drop("following")
    both = sequence.neighbours(left.withColumnRenamed("previous", "p"), CH, ["seq", "id"], F.col("has_audio_match"), F.col("word_start")).drop("previous")
    return both.select(*CH, "seq", "id", F.col("p").alias("previous"), "following")


@query(f"""
WITH a AS ({ALIGNED_SQL})
SELECT book, chapter, seq, {_MS.format('s')} AS a, {_MS.format('e')} AS b, CASE WHEN {_MS.format('e')} > n AND n >= {_MS.format('s')} THEN n ELSE {_MS.format('e')} END AS clamped_end
FROM (SELECT *, first_value({_MS.format('s')} IGNORE NULLS) OVER (PARTITION BY book, chapter ORDER BY seq, id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS n FROM a)
""")
def overlap_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-14 (clamp): ends cut to the next playable start."""
    df = aligned(spark, sf_dir).select(*CH, "seq", "id", ms("s").alias("a"), ms("e").alias("b"))
    return sequence.clamp_to_next(df, CH, ["seq", "id"], "a", "b").select(*CH, "seq", "a", "b", "clamped_end")


@query(f"""
WITH w AS ({WORDS_SQL})
SELECT book, chapter, token_index, word FROM (SELECT *, lag(s) OVER (PARTITION BY book, chapter ORDER BY token_index) AS p FROM w) WHERE p = s
""")
def repeated_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-17: words that start exactly when the word before starts."""
    return sequence.repeated_starts(spoken(spark, sf_dir), CH, ["token_index"], "s").select(*CH, "token_index", "word")


@query("""
WITH t AS (SELECT *, CAST(round(duration * 1000) AS BIGINT) AS d FROM tracks)
SELECT book, track_index, d, coalesce(sum(coalesce(d, 0) + 450) OVER (PARTITION BY book ORDER BY track_index, path ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS at FROM t
""")
def track_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-13: where each track starts when a book plays through with pauses of 450 ms."""
    df = table(spark, sf_dir, "tracks").withColumn("d", ms("duration"))
    return sequence.timeline(df, ["book"], ["track_index", "path"], "d", 450).select("book", "track_index", "d", F.col("at").cast("bigint").alias("at"))


@query(f"""
WITH a AS ({ALIGNED_SQL})
SELECT book, chapter, seq, id, CAST(floor((row_number() OVER (PARTITION BY book, chapter ORDER BY seq, id) - 1) / 40) AS BIGINT) AS batch FROM a
""")
def sentence_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-12: batches of 40 sentences."""
    return sequence.batches(aligned(spark, sf_dir), CH, ["seq", "id"], 40).select(*CH, "seq", "id", "batch")


@query(f"""
WITH a AS ({ALIGNED_SQL}), r AS (SELECT *, CASE WHEN p IS NULL OR p IS DISTINCT FROM alignment_status THEN 1 ELSE 0 END AS c FROM (
  SELECT *, lag(alignment_status) OVER (PARTITION BY book, chapter ORDER BY seq, id) AS p FROM a)),
g AS (SELECT *, sum(CASE WHEN alignment_status IS NULL THEN 1 ELSE c END) OVER (PARTITION BY book, chapter ORDER BY seq, id ROWS UNBOUNDED PRECEDING) AS run FROM r)
SELECT book, chapter, run::BIGINT AS run, min(alignment_status) AS status, min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS n FROM g GROUP BY book, chapter, run
""")
def status_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-05, WN-08: runs of sentences of one status."""
    runs = sequence.run_ids(aligned(spark, sf_dir), CH, ["seq", "id"], F.col("alignment_status"))
    return runs.groupBy(*CH, "run").agg(F.min("alignment_status").alias("status"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.count("*").alias("n"))


@query(f"""
WITH a AS ({ALIGNED_SQL}), r AS (SELECT *, alignment_status = 'review-required' AS bad FROM a),
n AS (SELECT *, row_number() OVER (PARTITION BY book, chapter ORDER BY seq, id) AS k FROM r),
p AS (SELECT *, last_value(CASE WHEN NOT bad THEN {_MS.format('e')} END IGNORE NULLS) OVER (PARTITION BY book, chapter ORDER BY seq, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe,
  first_value(CASE WHEN NOT bad THEN {_MS.format('s')} END IGNORE NULLS) OVER (PARTITION BY book, chapter ORDER BY seq, id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ns FROM n),
g AS (SELECT *, k - row_number() OVER (PARTITION BY book, chapter ORDER BY seq, id) AS g FROM p WHERE bad)
SELECT book, chapter, min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS n, greatest(0, max(pe) - 1000) AS from_ms, min(ns) + 1000 AS to_ms FROM g GROUP BY book, chapter, g
""")
def review_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-08: runs of sentences under review and the audio between their matched neighbours, one second wider."""
    df = aligned(spark, sf_dir).withColumn("bad", F.col("alignment_status") == "review-required")
    w = Window.partitionBy(*CH).orderBy("seq", "id")
    good_e, good_s = F.when(~F.col("bad"), ms("e")), F.when(~F.col("bad"), ms("s"))
    df = df.withColumns({
        "k": F.row_number().over(w), "pe": F.last(good_e, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        "ns": F.first(good_s, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)),
    }).where("bad")
    g = df.withColumn("g", F.col("k") - F.row_number().over(w)).groupBy(*CH, "g")
    return g.agg(F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.count("*").alias("n"), F.greatest(F.lit(0), F.max("pe") - 1000).alias("from_ms"), (F.min("ns") + 1000).alias("to_ms")).drop("g")


@query("""
SELECT book, chapter, CASE WHEN role = 'chapter' THEN coalesce(display_number, CAST(sum(CASE WHEN role = 'chapter' AND display_number IS NULL THEN 1 ELSE 0 END)
  OVER (PARTITION BY book ORDER BY chapter ROWS UNBOUNDED PRECEDING) AS INTEGER)) END AS shown FROM chapter_metadata
""")
def chapter_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-19: the number a chapter is shown with."""
    return sequence.display_numbers(table(spark, sf_dir, "chapter_metadata"), ["book"], ["chapter"], F.col("role") == "chapter", "display_number").select(*CH, "shown")


@query(f"""
WITH a AS ({ALIGNED_SQL}), m AS (SELECT book, chapter, seq, id, s, e FROM a WHERE has_audio_match AND e > s)
SELECT book, chapter, seq, id, lead(id) OVER (PARTITION BY book, chapter ORDER BY seq, id) AS next_id FROM m
""")
def next_playable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP-02: the next sentence that can be played."""
    m = aligned(spark, sf_dir).where("has_audio_match AND e > s")
    return m.select(*CH, "seq", "id", F.lead("id").over(Window.partitionBy(*CH).orderBy("seq", "id")).alias("next_id"))
