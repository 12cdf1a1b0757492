"""Queries that relate records with records: joins, sets, upserts, rollups, audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sonograin.functions import text as tx
from sonograin.operators import audit, relate
from sonograin.plans.catalog import query
from sonograin.plans.texts import CANON_SQL, CH, FULL_SQL, REC, analysed, canonical
from sonograin.plans.timeline import ALIGNED_SQL, aligned, ms
from sonograin.tables import once, table


@query(f"WITH c AS ({CANON_SQL}), f AS ({FULL_SQL}) SELECT c.book, c.chapter, c.id, c.seq, f.trans, coalesce(len(f.vocab), 0)::BIGINT AS n_vocab FROM c JOIN f ON c.book = f.book AND c.chapter = f.chapter AND c.id = f.id")
def text_only_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-01, PR-03: analysis joined to the canonical records of its id."""
    f = analysed(spark, sf_dir).select(*REC, "trans", F.greatest(F.lit(0), F.coalesce(F.size("vocab"), F.lit(0))).cast("bigint").alias("n_vocab"))
    return canonical(spark, sf_dir).select(*REC, "seq").join(f, REC).select(*REC, "seq", "trans", "n_vocab")


@query(f"WITH c AS (SELECT DISTINCT book, chapter, id, tag, elem_idx, is_heading FROM ({CANON_SQL})), a AS ({ALIGNED_SQL}) SELECT a.book, a.chapter, a.id, c.tag, c.elem_idx, coalesce(a.is_heading, c.is_heading) AS is_heading FROM a LEFT JOIN c ON a.book = c.book AND a.chapter = c.chapter AND a.id = c.id")
def layout_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-02: aligned sentences with the layout of their canonical record; what is there wins."""
    c = canonical(spark, sf_dir).select(*REC, "tag", "elem_idx", "is_heading").distinct()
    return relate.enrich(aligned(spark, sf_dir).select(*REC, "seq", "source_text", "is_heading", "s", "e", "raw_start", "raw_end", "match_ratio"), c, REC, ["tag", "elem_idx", "is_heading"]).select(*REC, "tag", "elem_idx", "is_heading")


@query(f"WITH c AS ({CANON_SQL}), f AS ({FULL_SQL}) SELECT c.book, c.chapter, c.id, coalesce(f.trans, '') AS trans FROM c LEFT JOIN f ON c.book = f.book AND c.chapter = f.chapter AND c.id = f.id")
def with_rendering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-03: every canonical record with its rendering, '' where there is none."""
    return canonical(spark, sf_dir).select(*REC, "seq", "text", "elem_idx", "tag").join(analysed(spark, sf_dir).select(*REC, "trans", "seq", "text", "vocab").drop("seq", "text", "vocab"), REC, "left").select(*REC, F.coalesce("trans", F.lit("")).alias("trans"))


@query(f"""
WITH c AS (SELECT DISTINCT book, chapter, seq, id, text FROM ({CANON_SQL})), f AS (SELECT DISTINCT book, chapter, seq, id, text FROM ({FULL_SQL}))
SELECT coalesce(c.book, f.book) AS book, coalesce(c.chapter, f.chapter) AS chapter, coalesce(c.seq, f.seq) AS seq,
  CASE WHEN f.book IS NULL THEN 'left_only' WHEN c.book IS NULL THEN 'right_only' WHEN c.id IS NOT DISTINCT FROM f.id AND c.text IS NOT DISTINCT FROM f.text THEN 'equal' ELSE 'differs' END AS state
FROM c FULL OUTER JOIN f ON c.book = f.book AND c.chapter = f.chapter AND c.seq = f.seq
""")
def positional_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-04, AU-05: canonical and analysed records paired by position, with equality of id and text."""
    a, b = canonical(spark, sf_dir).select(*REC, "seq", "text").distinct(), analysed(spark, sf_dir).select(*REC, "seq", "text").distinct()
    left = a.withColumn("__l", F.lit(True)).withColumnsRenamed({"id": "ai", "text": "at"})
    right = b.withColumn("__r", F.lit(True)).withColumnsRenamed({"id": "bi", "text": "bt"})
    same = F.col("ai").eqNullSafe(F.col("bi")) & F.col("at").eqNullSafe(F.col("bt"))
    state = F.when(F.col("__r").isNull(), "left_only").when(F.col("__l").isNull(), "right_only").when(same, "equal").otherwise("differs")
    return left.join(right, [*CH, "seq"], "full_outer").select(*CH, "seq", state.alias("state"))


@query(f"SELECT book, chapter, id FROM ({CANON_SQL}) c WHERE NOT EXISTS (SELECT 1 FROM full_analysis f WHERE f.book = c.book AND f.chapter = c.chapter AND f.id = c.id)")
def pending_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-05, FL-06: records without analysis."""
    return relate.missing(canonical(spark, sf_dir), table(spark, sf_dir, "full_analysis"), REC).select(*REC)


@query("""
SELECT coalesce(m.book, t.book) AS book, coalesce(m.chapter, t.track_index) AS chapter, CASE WHEN t.book IS NULL THEN 'left_only' ELSE 'right_only' END AS side
FROM (SELECT DISTINCT book, chapter FROM chapter_metadata) m FULL OUTER JOIN (SELECT DISTINCT book, track_index FROM tracks) t ON m.book = t.book AND m.chapter = t.track_index WHERE m.book IS NULL OR t.book IS NULL
""")
def chapters_without_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-06, SE-03: chapters and tracks that have no counterpart."""
    t = table(spark, sf_dir, "tracks").select("book", F.col("track_index").alias("chapter"))
    return relate.set_difference(table(spark, sf_dir, "chapter_metadata"), t, CH)


@query("""
SELECT r.book, r.chapter, CASE WHEN t.book IS NULL THEN 'added' ELSE 'changed' END AS change FROM acoustic_runs r
LEFT JOIN tracks t ON r.book = t.book AND r.chapter = t.track_index WHERE t.book IS NULL OR r.source_audio_sha256 IS DISTINCT FROM t.sha256
""")
def stale_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-07, JN-21, AU-07: recognitions made from audio other than the track that is there, null being equal to null."""
    t = table(spark, sf_dir, "tracks").select("book", F.col("track_index").alias("chapter"), "sha256")
    r = table(spark, sf_dir, "acoustic_runs").select(*CH, F.col("source_audio_sha256").alias("sha256"))
    return relate.changed(t, r, CH, ["sha256"])


@query(r"""
WITH c AS (SELECT book, chapter AS number FROM chapter_metadata),
f AS (SELECT DISTINCT book, regexp_extract(path, '[^/]+$') AS name FROM tracks),
n AS (SELECT book, name, CAST(nullif(regexp_extract(lower(name), '(?:chapter|ch)[ _-]*0*(\d+)', 1), '') AS BIGINT) AS number FROM f),
g AS (SELECT book, number, count(*) AS n, min(name) AS file FROM n WHERE number IS NOT NULL GROUP BY 1, 2)
SELECT c.book, c.number::BIGINT AS number, CASE WHEN g.n IS NULL THEN NULL ELSE 1 END AS tier, CASE WHEN g.n IS NULL THEN 'missing' WHEN g.n > 1 THEN 'ambiguous' ELSE 'ok' END AS status, CASE WHEN g.n = 1 THEN g.file END AS file
FROM c LEFT JOIN g ON c.book = g.book AND c.number = g.number
""")
def rule_cascade_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-08: audio file of every chapter by the cascade of naming rules."""
    c = table(spark, sf_dir, "chapter_metadata").select("book", F.col("chapter").cast("bigint").alias("number"))
    f = table(spark, sf_dir, "tracks").select("book", F.regexp_extract("path", "[^/]+$", 0).alias("name")).distinct()
    return relate.resolve_names(c, f, ["book"], "number", "name")


@query("""
SELECT * FROM part WHERE p_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 3 = 0)
UNION ALL SELECT * REPLACE (p_name || ' (new)' AS p_name) FROM part WHERE p_partkey % 3 = 0
""")
def upsert_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-22: new versions of a third of the parts replace the old ones."""
    p = table(spark, sf_dir, "part")
    return relate.upsert(p, p.where("p_partkey % 3 = 0").withColumn("p_name", F.concat("p_name", F.lit(" (new)"))), ["p_partkey"])


@query(f"""
WITH c AS ({CANON_SQL}), t AS (SELECT book, chapter, seq, id, regexp_extract_all(lower(text), '[a-z0-9'']+') AS w FROM c WHERE text IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY book, chapter, array_to_string(w, ' ') ORDER BY seq, id) AS r FROM t WHERE len(w) >= 4)
SELECT book, chapter, seq, id FROM r WHERE r > 1
""")
def repeated_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-19: records whose words stood in an earlier record of the chapter."""
    df = canonical(spark, sf_dir).where("text IS NOT NULL").withColumn("o", F.struct("seq", "id"))
    return relate.repeats(df, CH, "o", tx.words(F.col("text"))).select(*CH, "seq", "id")


@query(f"""
WITH w AS (SELECT book, chapter, token_index, regexp_replace(lower(min(word)), '[^a-z0-9]', '', 'g') AS t FROM acoustic_words WHERE word IS NOT NULL GROUP BY 1, 2, 3),
k AS (SELECT book, chapter, token_index, t, row_number() OVER (PARTITION BY book, chapter ORDER BY token_index) AS p FROM w WHERE t <> ''),
l AS (SELECT book, chapter, list(t ORDER BY p) AS ws FROM k GROUP BY 1, 2),
s AS (SELECT DISTINCT book, chapter, id, list_filter(list_transform(string_split_regex(lower(source_text), '[\\t\\n\\x0B\\f\\r ]+'), lambda x: regexp_replace(x, '[^a-z0-9]', '', 'g')), lambda x: x <> '') AS w FROM aligned_sentences WHERE source_text IS NOT NULL)
SELECT s.book, s.chapter, s.id, k.token_index AS start, count(*) OVER (PARTITION BY s.book, s.chapter, s.id) AS places
FROM s JOIN k ON s.book = k.book AND s.chapter = k.chapter AND k.t = s.w[1] JOIN l ON s.book = l.book AND s.chapter = l.chapter WHERE l.ws[k.p : k.p + len(s.w) - 1] = s.w
""")
def passage_locate_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-14, SQ-04: every place in the chapter's audio at which all words of a sentence stand, sentences of any length."""
    w = table(spark, sf_dir, "acoustic_words").where("word IS NOT NULL").groupBy(*CH, "token_index").agg(F.min("word").alias("word"))
    w = w.select(*CH, "token_index", F.regexp_replace(F.lower("word"), "[^a-z0-9]", "").alias("t")).where("t <> ''")
    ws = F.filter(F.transform(F.split(F.lower("source_text"), r"[\t\n\x0B\f\r ]+"), lambda x: F.regexp_replace(x, "[^a-z0-9]", "")), lambda x: x != "")
    s = table(spark, sf_dir, "aligned_sentences").where("source_text IS NOT NULL").select(*REC, ws.alias("w")).distinct()
    found = relate.exact_starts(s, REC, "w", w, CH, "token_index", "t")
    return found.select(*REC, "start", F.count("*").over(Window.partitionBy(*REC)).alias("places"))


@query("SELECT o_orderkey AS k, 'left_only' AS side FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT DISTINCT l_orderkey, 'right_only' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def set_ops_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SE-02: order keys on one side only."""
    a = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    return relate.set_difference(a, table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k")), ["k"])


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_linenumber <= 2 UNION ALL SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_linenumber > 2 AND l_quantity > 30")
def set_ops_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SE-01: union of kept and replacing rows."""
    t = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return t.where("l_linenumber <= 2").unionByName(t.where("l_linenumber > 2 AND l_quantity > 30"))


@query("SELECT DISTINCT l_suppkey, l_partkey FROM lineitem")
def set_ops_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SE-04: different pairs of supplier and part."""
    return table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey").distinct()


@query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45)")
def set_ops_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SE-05: orders that have a line of over 45 pieces."""
    return table(spark, sf_dir, "orders").select("o_orderkey").join(table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")


@query(f"""
WITH a AS ({ALIGNED_SQL}), r AS (SELECT book, chapter, CASE WHEN s IS NOT NULL AND e >= s AND has_audio_match THEN source_token_count ELSE least(matched_token_count, source_token_count) END AS cov, source_token_count AS exp FROM a
  WHERE NOT coalesce(is_heading, false) AND coalesce(alignment_status, '') <> 'not-applicable')
SELECT book, chapter, sum(cov)::BIGINT AS covered, sum(exp)::BIGINT AS expected, coalesce(sum(cov) * 20 >= sum(exp) * 19, true) AS passes FROM r GROUP BY book, chapter
""")
def coverage_by_chapter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-03: acoustic coverage of narrated tokens per chapter; 95 % pass."""
    a = aligned(spark, sf_dir).where("NOT coalesce(is_heading, false) AND coalesce(alignment_status, '') <> 'not-applicable'")
    played = F.col("s").isNotNull() & (F.col("e") >= F.col("s")) & F.col("has_audio_match")
    cov = F.when(F.coalesce(played, F.lit(False)), F.col("source_token_count")).otherwise(F.least("matched_token_count", "source_token_count"))
    g = a.groupBy(*CH).agg(F.sum(cov).alias("covered"), F.sum("source_token_count").alias("expected"))
    return g.withColumn("passes", F.coalesce(F.col("covered") * 20 >= F.col("expected") * 19, F.lit(True)))


@query("""
WITH w AS (SELECT book, chapter, count(DISTINCT token_index) AS words FROM acoustic_words GROUP BY 1, 2),
c AS (SELECT book, chapter, sum(word_end - word_start + 1) AS claimed FROM (SELECT DISTINCT book, chapter, id, word_start, word_end FROM aligned_sentences WHERE has_audio_match AND word_end >= word_start) GROUP BY 1, 2)
SELECT w.book, w.chapter, w.words, coalesce(c.claimed, 0)::BIGINT AS claimed, w.words <= 100 OR coalesce(c.claimed, 0) * 100 >= w.words * 85 AS passes FROM w LEFT JOIN c ON w.book = c.book AND w.chapter = c.chapter
""")
def bilateral_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-04: share of the spoken words that sentences claim; 85 % pass, chapters of up to 100 words always."""
    w = table(spark, sf_dir, "acoustic_words").select(*CH, "token_index").distinct().groupBy(*CH).agg(F.count("token_index").alias("words"))
    c = table(spark, sf_dir, "aligned_sentences").where("has_audio_match AND word_end >= word_start").select(*REC, "word_start", "word_end").distinct()
    c = c.groupBy(*CH).agg(F.sum(F.col("word_end") - F.col("word_start") + 1).alias("claimed"))
    out = w.join(c, CH, "left").withColumn("claimed", F.coalesce("claimed", F.lit(0)).cast("bigint"))
    return out.withColumn("passes", (F.col("words") <= 100) | (F.col("claimed") * 100 >= F.col("words") * 85))


@query(f"""
WITH a AS ({ALIGNED_SQL})
SELECT book, chapter, count(*) AS n, count(*) FILTER (NOT has_audio_match) AS unmatched, min(CASE WHEN has_audio_match THEN CAST(round(s * 1000) AS BIGINT) END) AS lead_ms,
  max(CAST(round(e * 1000) AS BIGINT)) AS last_ms, count(*) FILTER (alignment_status IN ('validated', 'reviewed') AND NOT fallback_used) AS sound,
  count(*) FILTER (NOT has_audio_match) > 60 OR (count(*) >= 15 AND count(*) FILTER (NOT has_audio_match) > 3 AND count(*) FILTER (NOT has_audio_match) * 5 > count(*)) AS too_few
FROM a GROUP BY book, chapter
""")
def chapter_alignment_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-05, AG-06, AG-22: matched and unmatched sentences, lead and end of the speech per chapter, and the gate on unmatched ones."""
    no = ~F.col("has_audio_match")
    g = aligned(spark, sf_dir).groupBy(*CH).agg(
        F.count("*").alias("n"), F.count_if(no).alias("unmatched"), F.min(F.when(F.col("has_audio_match"), ms("s"))).alias("lead_ms"), F.max(ms("e")).alias("last_ms"),
        F.count_if(F.col("alignment_status").isin("validated", "reviewed") & ~F.col("fallback_used")).alias("sound"),
    )
    n, u = F.col("n"), F.col("unmatched")
    return g.withColumn("too_few", (u > 60) | ((n >= 15) & (u > 3) & (u * 5 > n)))


@query(f"""
WITH a AS ({ALIGNED_SQL}) SELECT alignment_method, alignment_status, has_audio_match, count(*) AS n, sum(matched_token_count)::BIGINT AS tokens, min(match_ratio) AS least_ratio FROM a GROUP BY 1, 2, 3
""")
def method_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-12, AG-18: sentences, tokens and least ratio by method and status."""
    return aligned(spark, sf_dir).groupBy("alignment_method", "alignment_status", "has_audio_match").agg(F.count("*").alias("n"), F.sum("matched_token_count").alias("tokens"), F.min("match_ratio").alias("least_ratio"))


@query("SELECT book, count(*) AS tracks, sum(d)::BIGINT AS total_ms, sum(bytes)::BIGINT AS bytes FROM (SELECT DISTINCT book, path, sha256, bytes, CAST(round(duration * 1000) AS BIGINT) AS d FROM tracks) GROUP BY book")
def book_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-13: total time of the different tracks of a book."""
    t = table(spark, sf_dir, "tracks").select("book", "path", "sha256", "bytes", ms("duration").alias("d")).distinct()
    return t.groupBy("book").agg(F.count("*").alias("tracks"), F.sum("d").alias("total_ms"), F.sum("bytes").alias("bytes"))


@query(f"WITH c AS ({CANON_SQL}) SELECT book, chapter, id, count(*) AS n, count(DISTINCT coalesce(text, '')) AS texts FROM c GROUP BY 1, 2, 3 HAVING count(*) > 1")
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-11: ids that occur more than once in a chapter."""
    return canonical(spark, sf_dir).groupBy(*REC).agg(F.count("*").alias("n"), F.count_distinct(F.coalesce("text", F.lit(""))).alias("texts")).where("n > 1")


@query(r"""
WITH d AS (SELECT doc_id, len(regexp_extract_all(text, '[^\t\n\x0B\f\r ]+'))::BIGINT AS words, length(text)::BIGINT AS chars, (length(text) - length(replace(text, chr(10), '')))::BIGINT AS breaks FROM documents WHERE text IS NOT NULL)
SELECT doc_id, words, chars, breaks, words > 150 AS substantive, round(words / 9000.0, 1) AS hours FROM d
""")
def document_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-08, AG-10, SR-09: words, characters, line breaks and reading hours of every document."""
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL").select(
        "doc_id", F.size(F.regexp_extract_all("text", F.lit(r"[^\t\n\x0B\f\r ]+"), 0)).cast("bigint").alias("words"), F.length("text").cast("bigint").alias("chars"),
        (F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))).cast("bigint").alias("breaks"),
    )
    return d.withColumn("substantive", F.col("words") > 150).withColumn("hours", F.round(F.col("words") / 9000.0, 1))


@query(f"""
WITH c AS ({CANON_SQL}), l AS (SELECT book, chapter, lower(trim(text)) AS t, row_number() OVER (PARTITION BY book, chapter ORDER BY seq DESC, id DESC) AS r FROM c WHERE is_heading AND text IS NOT NULL),
v AS (SELECT book, t, count(DISTINCT chapter) AS chapters FROM l WHERE r <= 2 GROUP BY book, t), k AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY chapters DESC, t) AS r FROM v)
SELECT book, t AS marker, chapters FROM k WHERE r = 1 AND chapters >= 2
""")
def stop_marker_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-09, TK-04: the heading that most often closes a book's chapters, if at least two."""
    w = Window.partitionBy(*CH).orderBy(F.desc("seq"), F.desc("id"))
    last = canonical(spark, sf_dir).where("is_heading AND text IS NOT NULL").select(*CH, F.lower(F.trim("text")).alias("t"), F.row_number().over(w).alias("r")).where("r <= 2")
    v = last.select("book", "t", "chapter").distinct().groupBy("book", "t").agg(F.count("*").alias("chapters"))
    best = v.groupBy("book").agg(F.max(F.struct("chapters")).alias("m"))
    top = v.join(best, "book").where("chapters = m.chapters").groupBy("book").agg(F.min("t").alias("marker"), F.max("chapters").alias("chapters"))
    return top.where("chapters >= 2").select("book", "marker", "chapters")


@query(f"""
WITH a AS ({ALIGNED_SQL}), m AS (SELECT book, chapter, seq, CAST(round(s * 1000) AS BIGINT) AS a, CAST(round(e * 1000) AS BIGINT) AS b FROM a WHERE s IS NOT NULL AND e IS NOT NULL AND has_audio_match),
g AS (SELECT *, a - max(b) OVER (PARTITION BY book, chapter ORDER BY seq, a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap, row_number() OVER (PARTITION BY book, chapter ORDER BY seq, a, b) AS r FROM m),
f AS (SELECT book, chapter, CASE WHEN r = 1 AND a > CASE WHEN chapter = 1 THEN 30000 ELSE 4500 END THEN 'LEADING_VOID' WHEN gap > 8000 THEN 'INTER_SENTENCE_VOID' END AS rule,
  CASE WHEN coalesce(gap, a) > CASE WHEN r = 1 THEN 10000 ELSE 15000 END THEN 'critical' ELSE 'warning' END AS severity FROM g)
SELECT book, count(*) FILTER (rule IS NOT NULL AND severity = 'critical') AS critical, count(*) FILTER (rule IS NOT NULL AND severity = 'warning') AS warnings,
  CASE WHEN count(*) FILTER (rule IS NOT NULL AND severity = 'critical') > 0 THEN 'DEFECTIVE' ELSE 'CLEAN' END AS state FROM f GROUP BY book
""")
def library_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-14, AU-14: voids in the narration of every book, and its verdict."""
    f = audit.continuity(aligned(spark, sf_dir).where("has_audio_match AND s IS NOT NULL AND e IS NOT NULL").select(*CH, "seq", ms("s").alias("a"), ms("e").alias("b")))
    return audit.book_verdict(f)


@query()
def audit_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AU-01, AU-02, AU-03, AU-05, AU-09: every finding about the texts and their analysis. Checked against fixtures."""
    c, f = canonical(spark, sf_dir), analysed(spark, sf_dir)
    return audit.union([audit.orthography(c), audit.boundaries(c), audit.typography(c), audit.analysis_contract(c, f), audit.interior_voids(c, aligned(spark, sf_dir))])


@query(f"""
WITH c AS (SELECT *, trim(text) AS t, regexp_replace(trim(text), '([a-zA-Z])[0-9]{{1,3}}$', '\\1') AS w, coalesce(is_heading, false) AS h, regexp_matches(trim(text), '^https?://') AS url FROM ({CANON_SQL}))
SELECT book, chapter, id, 'empty_text' AS rule FROM c WHERE coalesce(t, '') = ''
UNION ALL SELECT book, chapter, id, 'trailing_hyphen' FROM c WHERE regexp_matches(t, '[a-zA-Z]-$') AND NOT url
UNION ALL SELECT book, chapter, id, 'lowercase_start' FROM c WHERE NOT h AND regexp_matches(t, '^["“‘''(\\[]*[a-z]')
  AND NOT regexp_matches(t, '^(\\(([a-zA-Z]{{1,2}}|[0-9]{{1,3}}|[ivxLCDM]+)\\)|[a-zA-Z]{{1,2}}\\.|[0-9]{{1,3}}\\.|[ivxLCDM]+\\.)') AND NOT regexp_matches(t, '^by\\s+[A-Z]') AND NOT regexp_matches(t, '^[a-zA-Z]\\s*=\\s*') AND NOT url
UNION ALL SELECT book, chapter, id, 'orphan_word' FROM c WHERE NOT h AND NOT coalesce(is_tabular, false) AND t <> '' AND NOT url AND NOT regexp_matches(w, '[\\t\\n\\x0B\\f\\r ]')
  AND NOT regexp_matches(w, '^[—–-]') AND NOT regexp_full_match(w, '[*\\s—–•#+-]+') AND NOT regexp_matches(w, '[.!?…”")\\]:,—–。！？-]$')
UNION ALL SELECT book, chapter, id, 'unclosed_quote' FROM c WHERE NOT url AND (length(t) - length(replace(t, '“', '')) > length(t) - length(replace(t, '”', '')) OR (length(t) - length(replace(t, '"', ''))) % 2 = 1)
""")
def orthography_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AU-01: every rule of orthography on every record."""
    return audit.orthography(canonical(spark, sf_dir), quotes=True).select(*REC, "rule")


@query("""
SELECT book, chapter, 'bad_role' AS rule FROM chapter_metadata WHERE role IS NULL OR role = ''
UNION ALL SELECT book, chapter, 'number_of_no_chapter' FROM chapter_metadata WHERE role <> 'chapter' AND display_number IS NOT NULL
UNION ALL SELECT book, chapter, 'bad_number' FROM chapter_metadata WHERE display_number < 1
UNION ALL SELECT book, chapter, 'repeated_chapter' FROM (SELECT book, chapter, count(*) AS n FROM chapter_metadata GROUP BY 1, 2) WHERE n > 1
UNION ALL SELECT book, chapter, 'no_title' FROM chapter_metadata WHERE trim(coalesce(title, '')) = ''
""")
def metadata_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AU-16, SR-13: constraints of the chapter metadata."""
    return audit.metadata(table(spark, sf_dir, "chapter_metadata")).select(*CH, "rule")


_ROMANS = ", ".join(f"'{r.upper()}'" for r in tx.roman_numerals(tx.ROMAN_TITLES))


@query(rf"""
WITH c AS (SELECT book, chapter, coalesce(title, '') AS t FROM chapter_metadata),
n AS (SELECT *, lower(t) AS l, trim(t) AS s, coalesce(nullif(list_position([{_ROMANS}], regexp_extract(t, '^([IVXLCDM]+)\.', 1)), 0), try_cast(nullif(regexp_extract(t, '^(?i:chapter\s+)?([0-9]+)', 1), '') AS INTEGER)) AS number FROM c)
SELECT book, chapter, number::INTEGER AS number,
  CASE WHEN number IS NOT NULL THEN 'chapter' WHEN contains(l, 'prologue') OR contains(l, 'preface') OR contains(l, 'foreword') THEN 'preface' WHEN contains(l, 'intro') THEN 'introduction'
    WHEN contains(l, 'question') OR contains(l, 'appendix') THEN 'appendix' WHEN contains(l, 'note') THEN 'preface' ELSE 'chapter' END AS inferred,
  CASE WHEN number IS NOT NULL THEN 'Chapter ' || number WHEN contains(l, 'prologue') THEN 'Prologue'
    WHEN contains(l, 'preface') OR contains(l, 'foreword') THEN CASE WHEN contains(l, 'first') THEN 'Preface (1st Ed)' WHEN contains(l, 'second') THEN 'Preface (2nd Ed)' WHEN contains(l, 'tucker') OR contains(l, 'editorial') THEN 'Editorial Preface' ELSE 'Preface' END
    WHEN contains(l, 'intro') THEN CASE WHEN contains(l, 'third') THEN 'Intro (3rd Ed)' WHEN contains(l, 'author') THEN 'Author''s Intro' ELSE 'Introduction' END
    WHEN contains(l, 'question') THEN 'Questions' WHEN contains(l, 'appendix') THEN 'Appendix' WHEN contains(l, 'note') THEN 'Note' WHEN contains(l, 'conclusion') THEN 'Conclusions'
    WHEN length(s) <= 36 THEN s ELSE coalesce(nullif(trim(regexp_extract(s, '^(.{{1,35}})\b', 1)), ''), trim(left(s, 36))) END AS label FROM n
""")
def inferred_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC-21: role, number and label of every chapter by its title."""
    m = table(spark, sf_dir, "chapter_metadata").select(*CH, tx.chapter_role(F.col("title")).alias("r"))
    return m.select(*CH, F.col("r.number").alias("number"), F.col("r.role").alias("inferred"), F.col("r.label").alias("label"))


@query("SELECT book, chapter, CAST(coalesce(transcription_options['beam_size'], '0') AS INTEGER) AS beam FROM acoustic_runs")
def run_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MP-01: a map entry by key, with a default."""
    return table(spark, sf_dir, "acoustic_runs").select(*CH, F.coalesce(F.try_element_at("transcription_options", F.lit("beam_size")), F.lit("0")).cast("int").alias("beam"))


@query("""
WITH w AS (SELECT DISTINCT book, chapter, token_index, word, "start" AS s, "end" AS e, probability FROM acoustic_words)
SELECT book, chapter, count(*) FILTER (trim(coalesce(word, '')) = '') AS blank, count(*) FILTER (s IS NULL OR e IS NULL) AS untimed, count(*) FILTER (e < s) AS reversed, count(*) FILTER (e = s) AS zero_length,
  count(*) FILTER (trim(coalesce(word, '')) <> '' AND e > s) AS kept, count(*) FILTER (probability IS NULL) AS no_probability FROM w GROUP BY book, chapter
""")
def recognition_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SR-17: what a recognition's normalisation would drop, per chapter."""
    w = once(table(spark, sf_dir, "acoustic_words")).withColumnsRenamed({"start": "s", "end": "e"})
    blank = F.trim(F.coalesce("word", F.lit(""))) == ""
    return w.groupBy(*CH).agg(
        F.count_if(blank).alias("blank"), F.count_if(F.col("s").isNull() | F.col("e").isNull()).alias("untimed"), F.count_if(F.col("e") < F.col("s")).alias("reversed"),
        F.count_if(F.col("e") == F.col("s")).alias("zero_length"), F.count_if(~blank & (F.col("e") > F.col("s"))).alias("kept"), F.count_if(F.col("probability").isNull()).alias("no_probability"),
    )


_GATE_SQL = f"""
a AS ({ALIGNED_SQL}), r AS (SELECT *, CAST(round(coalesce(raw_start, s) * 1000) AS BIGINT) AS ta, CAST(round(coalesce(raw_end, e) * 1000) AS BIGINT) AS tb,
  coalesce(alignment_status = 'not-applicable' AND alignment_reason IN ('non_narrated_content','non_narrated_text','duplicate_source_fragment','out_of_scope_reference','structural_tabular_omitted_by_narrator'), false) AS silent,
  coalesce(alignment_status = 'validated' AND alignment_method IN ('leading_epigraph_attribution','chapter_heading_numeric_variant','opening_speaker_attribution','dialogue_attribution_reorder','dialogue_attribution_actor_omitted') AND has_audio_match AND NOT fallback_used, false) AS moved FROM a),
p AS (SELECT *, NOT silent AND NOT moved AS part,
  last_value(CASE WHEN NOT silent AND NOT moved THEN ta END IGNORE NULLS) OVER (PARTITION BY book, chapter ORDER BY seq, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ps,
  max(CASE WHEN NOT silent AND NOT moved THEN tb END) OVER (PARTITION BY book, chapter ORDER BY seq, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe,
  NOT coalesce(is_heading, false) AND NOT silent AS body FROM r),
f AS (SELECT book, chapter, id, 'non_monotonic' AS rule, 'error' AS severity FROM p WHERE part AND ta < ps
UNION ALL SELECT book, chapter, id, 'overlap', 'error' FROM p WHERE part AND ta < pe - 50
UNION ALL SELECT book, chapter, id, 'end_before_start', 'error' FROM p WHERE tb < ta
UNION ALL SELECT book, chapter, id, 'void', 'error' FROM p WHERE part AND pe > 0 AND ta - pe > 15000
UNION ALL SELECT book, chapter, id, 'no_audio', 'error' FROM p WHERE body AND NOT coalesce(has_audio_match, false)
UNION ALL SELECT book, chapter, id, 'review', 'warning' FROM p WHERE body AND (NOT coalesce(has_audio_match, false) OR coalesce(fallback_used, false) OR coalesce(alignment_status, '') NOT IN ('validated', 'reviewed') OR coalesce(matched_token_count, 0) < 1 OR coalesce(match_ratio, 0) < 0.5))"""


def _gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = aligned(spark, sf_dir).withColumn("a", F.round(F.coalesce("raw_start", "s") * 1000).cast("bigint")).withColumn("b", F.round(F.coalesce("raw_end", "e") * 1000).cast("bigint"))
    return audit.release_gate(a)


@query(f"WITH {_GATE_SQL} SELECT book, chapter, id, rule, severity FROM f")
def release_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AU-06: findings of the release gate on the aligned sentences."""
    return _gate(spark, sf_dir).select(*REC, "rule", "severity")


@query(f"WITH {_GATE_SQL} SELECT book, count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warning') AS warnings, false AS ready FROM f GROUP BY book")
def release_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-22: errors and warnings of every book with findings."""
    return audit.verdict(_gate(spark, sf_dir))


@query(f"""
WITH a AS ({ALIGNED_SQL}), m AS (SELECT book, chapter, seq, CAST(round(s * 1000) AS BIGINT) AS a, CAST(round(e * 1000) AS BIGINT) AS b FROM a WHERE s IS NOT NULL AND e IS NOT NULL),
p AS (SELECT *, max(b) OVER (PARTITION BY book, chapter ORDER BY seq, a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM m)
SELECT book, chapter, pe AS "start", a AS "end" FROM p WHERE a - pe > 2000
""")
def narration_voids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-03, AU-14: holes of over two seconds in the narration."""
    return audit.voids(aligned(spark, sf_dir).select(*CH, "seq", ms("s").alias("a"), ms("e").alias("b")), 2_000)
