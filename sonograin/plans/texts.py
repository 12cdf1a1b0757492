"""Queries over texts: sentence split, measures, filters, keys, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonograin.functions import text as tx
from sonograin.operators import kernels, sequence
from sonograin.plans.catalog import query
from sonograin.tables import once, table

CH = ["book", "chapter"]
REC = ["book", "chapter", "id"]
CANON_SQL = "SELECT DISTINCT book, chapter, seq, id, elem_idx, tag, text, is_heading, is_tabular, is_footnote FROM canonical_sentences"
FULL_SQL = "SELECT DISTINCT book, chapter, seq, id, text, trans, vocab FROM full_analysis"
_LINES_SQL = "lines AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS line_no, unnest(l) AS line FROM (SELECT doc_id, string_split(regexp_replace(text, '\\r\\n|\\r', chr(10), 'g'), chr(10)) AS l FROM documents WHERE text IS NOT NULL))"


def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical sentences counted once."""
    return once(table(spark, sf_dir, "canonical_sentences"))


def analysed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analysed sentences counted once."""
    return once(table(spark, sf_dir, "full_analysis"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, line_no, line): the lines of every document."""
    t = F.regexp_replace("text", "\r\n|\r", "\n")
    return table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.posexplode(F.split(t, "\n")).alias("p", "line")).select("doc_id", (F.col("p") + 1).cast("bigint").alias("line_no"), "line")


@query("""
WITH c AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?]+)[\\t\\n\\f\\r ]+([A-Z0-9])', '\\1' || chr(57345) || '\\2', 'g'), chr(57345)), lambda x: trim(x)), lambda x: x <> '') AS s FROM documents WHERE text IS NOT NULL)
SELECT doc_id, len(s)::BIGINT AS n_sentences, coalesce(list_sum(list_transform(s, lambda x: length(x))), 0)::BIGINT AS n_chars FROM c
""")
def sentence_split_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC-02 core: sentences per document and their characters."""
    cut = F.regexp_replace("text", r"([.!?]+)[\t\n\f\r ]+([A-Z0-9])", f"$1{tx.MARK}$2")
    s = F.filter(F.transform(F.split(cut, tx.MARK), lambda x: F.trim(x)), lambda x: x != "")
    df = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", s.alias("s"))
    return df.select("doc_id", F.size("s").cast("bigint").alias("n_sentences"), F.aggregate("s", F.lit(0).cast("bigint"), lambda a, x: a + F.length(x)).alias("n_chars"))


@query()
def canonical_sentences_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC-02 with all protections, on every record. No SQL: look-around. Checked against fixtures."""
    df = canonical(spark, sf_dir).where("text IS NOT NULL").select(*REC, F.posexplode(tx.split_sentences(F.col("text"))).alias("n", "sentence"))
    return df


_METRIC_SQL = f"""
m AS (SELECT f.book, f.chapter, f.id, len(regexp_extract_all(coalesce(f.text, ''), '[^\\t\\n\\x0B\\f\\r ]+'))::BIGINT AS words, length(coalesce(f.trans, ''))::BIGINT AS chars,
  coalesce(greatest(0, CAST(round((coalesce(a.raw_end, a."end") - coalesce(a.raw_start, a."start")) * 100) AS BIGINT)), 0) AS cs, coalesce(len(f.vocab), 0)::BIGINT AS vocab_count
  FROM (SELECT book, chapter, id, min(text) AS text, min(trans) AS trans, max(vocab) AS vocab FROM full_analysis GROUP BY 1, 2, 3) f
  LEFT JOIN (SELECT book, chapter, id, min(raw_start) AS raw_start, min(raw_end) AS raw_end, min("start") AS "start", min("end") AS "end" FROM aligned_sentences GROUP BY 1, 2, 3) a USING (book, chapter, id)),
l AS (SELECT *, CASE WHEN words >= 70 OR chars >= 180 OR cs >= 3500 THEN 'EXTREME' WHEN words >= 45 OR chars >= 120 OR cs >= 2200 THEN 'HIGH' ELSE 'NORMAL' END AS level,
  chars >= 120 AND vocab_count >= 4 AS ui_stress FROM m)"""


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PR-01: words, rendered characters, duration in centiseconds, vocabulary, level and display stress of every record."""
    f = table(spark, sf_dir, "full_analysis").groupBy(*REC).agg(F.min("text").alias("text"), F.min("trans").alias("trans"), F.max(F.size("vocab")).alias("v"))
    a = table(spark, sf_dir, "aligned_sentences").groupBy(*REC).agg(*[F.min(c).alias(c) for c in ("raw_start", "raw_end", "start", "end")])
    dur = F.round((F.coalesce("raw_end", "end") - F.coalesce("raw_start", "start")) * 100).cast("bigint")
    df = f.join(a, REC, "left").select(
        *REC, F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\t\n\x0B\f\r ]+"), 0)).cast("bigint").alias("words"),
        F.length(F.coalesce("trans", F.lit(""))).cast("bigint").alias("chars"), F.coalesce(F.greatest(F.lit(0).cast("bigint"), dur), F.lit(0).cast("bigint")).alias("cs"),
        F.greatest(F.lit(0), F.coalesce("v", F.lit(0))).cast("bigint").alias("vocab_count"),
    )
    c = F.col
    level = F.when((c("words") >= 70) | (c("chars") >= 180) | (c("cs") >= 3500), "EXTREME").when((c("words") >= 45) | (c("chars") >= 120) | (c("cs") >= 2200), "HIGH").otherwise("NORMAL")
    return df.withColumn("level", level).withColumn("ui_stress", (c("chars") >= 120) & (c("vocab_count") >= 4))


@query(f"WITH {_METRIC_SQL} SELECT book, chapter, id, words, chars, cs, vocab_count, level, ui_stress FROM l")
def sentence_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PR-01 on every analysed record."""
    return metrics(spark, sf_dir)


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = metrics(spark, sf_dir).where("words > 0")
    aggs = [F.count("*").alias("total"), F.count_if(F.col("level") == "EXTREME").alias("extreme_count"), F.count_if(F.col("level") == "HIGH").alias("high_count"), F.count_if("ui_stress").alias("ui_stress_count")]
    for c in ("words", "chars"):
        aggs += [F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY {c})").cast("bigint").alias(f"{c}_p{int(q * 100)}") for q in (0.5, 0.9, 0.99)] + [F.max(c).alias(f"{c}_max")]
    aggs += [F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY CASE WHEN cs > 0 THEN cs END)").cast("bigint").alias(f"cs_p{int(q * 100)}") for q in (0.5, 0.9, 0.99)]
    return m.groupBy("book").agg(*aggs)


@query(f"""
WITH {_METRIC_SQL}
SELECT book, count(*) AS total, count(*) FILTER (level = 'EXTREME') AS extreme_count, count(*) FILTER (level = 'HIGH') AS high_count, count(*) FILTER (ui_stress) AS ui_stress_count,
  quantile_disc(words, 0.5) AS words_p50, quantile_disc(words, 0.9) AS words_p90, quantile_disc(words, 0.99) AS words_p99, max(words) AS words_max,
  quantile_disc(chars, 0.5) AS chars_p50, quantile_disc(chars, 0.9) AS chars_p90, quantile_disc(chars, 0.99) AS chars_p99, max(chars) AS chars_max,
  quantile_disc(CASE WHEN cs > 0 THEN cs END, 0.5) AS cs_p50, quantile_disc(CASE WHEN cs > 0 THEN cs END, 0.9) AS cs_p90, quantile_disc(CASE WHEN cs > 0 THEN cs END, 0.99) AS cs_p99
FROM l WHERE words > 0 GROUP BY book
""")
def sentence_metrics_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-01, AG-02: per book, counts of levels and nearest-rank percentiles."""
    return _profile(spark, sf_dir)


@query(f"WITH {_METRIC_SQL} SELECT book, max(words) AS max_words, max(chars) AS max_chars, count(*) FILTER (level = 'EXTREME') AS extreme_count, count(*) AS total FROM l WHERE words > 0 GROUP BY book")
def library_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-15: longest sentences, extreme ones and total of every book."""
    p = metrics(spark, sf_dir).where("words > 0").groupBy("book").agg(F.max("words").alias("max_words"), F.max("chars").alias("max_chars"), F.count_if(F.col("level") == "EXTREME").alias("extreme_count"), F.count("*").alias("total"))
    return p


@query(f"WITH {_METRIC_SQL} SELECT book, chapter, id, words, chars, level FROM l WHERE level = 'EXTREME' ORDER BY words DESC, chars DESC, book, chapter, id LIMIT 50")
def sentence_outliers_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TK-02: the 50 most extreme sentences (a top-k report)."""
    m = metrics(spark, sf_dir).where("level = 'EXTREME'").select(*REC, "words", "chars", "level")
    return m.orderBy(F.desc("words"), F.desc("chars"), *REC).limit(50)


@query(f"WITH {_METRIC_SQL} SELECT book, chapter, id, words >= 70 AS long_text, chars >= 180 AS long_rendering, cs >= 3500 AS long_audio FROM l WHERE words >= 70 OR chars >= 180 OR cs >= 3500")
def extreme_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AU-10: records over an extreme threshold, and over which."""
    m = metrics(spark, sf_dir)
    return m.where("words >= 70 OR chars >= 180 OR cs >= 3500").select(*REC, (F.col("words") >= 70).alias("long_text"), (F.col("chars") >= 180).alias("long_rendering"), (F.col("cs") >= 3500).alias("long_audio"))


@query("SELECT w AS word, count(*) AS n, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9'']+')) AS w FROM documents) GROUP BY w")
def token_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC-06, SC-08: words of all documents with their frequencies. Counted per document first, so a frequent word shuffles once a document."""
    per = table(spark, sf_dir, "documents").select("doc_id", F.explode(tx.words(F.col("text"))).alias("word")).groupBy("doc_id", "word").agg(F.count("*").alias("c"))
    return per.groupBy("word").agg(F.sum("c").alias("n"), F.count("*").alias("docs"))


@query("""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9'']+') AS w FROM documents WHERE text IS NOT NULL)
SELECT doc_id, array_to_string(w[1:45], ' ') AS head, array_to_string(w[greatest(1, len(w) - 44):], ' ') AS tail FROM w
""")
def document_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC-07: first and last 45 words of every document."""
    t = F.col("text")
    return table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", tx.anchor(t).alias("head"), tx.anchor(t, tail=True).alias("tail"))


@query(f"""
WITH {_LINES_SQL}
SELECT doc_id, line_no, regexp_full_match(trim(line), '[*\\-–—•·#\\s]{{2,}}') AS divider,
  list_bool_or(list_transform(['www.globalgreyebooks.com', 'global grey ebooks', 'produced by global grey', 'end of the project gutenberg', 'project gutenberg license', 'distributed by standard ebooks', 'download more free ebooks at'], lambda m: contains(lower(trim(line)), m))) AS promo,
  regexp_matches(line, '[a-zA-Z]') AS has_letter FROM lines
""")
def line_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC-13, SC-15, FL-03 on every line."""
    c = F.col("line")
    return lines(spark, sf_dir).select("doc_id", "line_no", tx.is_divider(c).alias("divider"), tx.is_promo(c).alias("promo"), c.rlike("[a-zA-Z]").alias("has_letter"))


@query(f"""
WITH {_LINES_SQL}, f AS (SELECT doc_id, line_no, trim(line) AS t FROM lines WHERE trim(line) <> ''), p AS (SELECT *, lag(t) OVER (PARTITION BY doc_id ORDER BY line_no) AS p FROM f)
SELECT doc_id, line_no FROM p WHERE p IS NULL OR p <> t OR length(t) >= 100
""")
def consecutive_line_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-01: lines left when repeats of the line before are dropped."""
    return sequence.drop_repeats(lines(spark, sf_dir), ["doc_id"], ["line_no"], "line").select("doc_id", "line_no")


_TITLE_SQL = """
list_filter(regexp_extract_all({c}, '[a-zA-Z0-9''’]+'), lambda w: NOT list_contains(['a','an','the','and','but','or','for','nor','on','in','at','to','from','by','with','of','off','out','as','into','over','up','down','vs','versus','v'], lower(w)))"""


@query(f"""
WITH c AS ({CANON_SQL}), w AS (SELECT *, regexp_extract_all(text, '[a-zA-Z0-9''’]+') AS w, {_TITLE_SQL.format(c='text')} AS big FROM c WHERE text IS NOT NULL)
SELECT book, chapter, id, len(w) BETWEEN 1 AND 12 AND NOT regexp_matches(trim(text), '[.!?…]$') AND NOT regexp_matches(trim(text), '-\\s*$') AND (
  regexp_matches(text, '^(Part |Chapter |Section |Appendix |Preface |Introduction |Book |Prologue|Epilogue|Table |Figure )')
  OR (NOT (len(w) = 1 AND lower(w[1]) IN ('however','therefore','moreover','furthermore','meanwhile','nevertheless','instead','consequently','thus','if','when','although'))
    AND ((len(big) > 0 AND len(list_filter(big, lambda x: NOT regexp_matches(x[1], '\\p{{Lu}}'))) = 0) OR (upper(text) = text AND lower(text) <> text)))) AS is_title FROM w
""")
def heading_title_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC-16 on every record."""
    return canonical(spark, sf_dir).where("text IS NOT NULL").select(*REC, tx.is_title(F.col("text")).alias("is_title"))


@query()
def heading_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC-17 on every record, beside the stored flag."""
    return canonical(spark, sf_dir).select(*REC, "is_heading", tx.is_heading(F.col("text"), F.col("tag")).alias("found"))


@query(f"""
WITH c AS ({CANON_SQL})
SELECT book, chapter, id, trim(regexp_replace(lower(regexp_replace(regexp_replace(text, '\\([^)]*\\)', '', 'g'), '\\[[^\\]]*\\]', '', 'g')), '[^a-z0-9]+', '-', 'g'), '-') AS slug,
  array_to_string(list_transform(regexp_extract_all(lower(text), '[0-9]+|[^0-9]+'), lambda p: CASE WHEN regexp_full_match(p, '[0-9]+') THEN lpad(p, 12, '0') ELSE p END), '') AS natural_key,
  sha256(text) AS digest FROM c WHERE text IS NOT NULL
""")
def text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC-20, SC-22, SC-31: slug, natural sort key and digest of every record."""
    t = F.col("text")
    return canonical(spark, sf_dir).where(t.isNotNull()).select(*REC, tx.slug(t).alias("slug"), tx.natural_key(t).alias("natural_key"), F.sha2(t, 256).alias("digest"))


@query()
def acoustic_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC-11: acoustic weight (in tenths) of every spelling, numbers written out. No SQL: numbers as words. Checked against a plain computation."""
    df = table(spark, sf_dir, "acoustic_words").where("word IS NOT NULL").select("word").distinct()
    w = F.col("word")
    df = df.withColumn("spoken", kernels.numbers_written(w))
    return df.select("word", tx.syllables(w).cast("bigint").alias("syllables"), F.round(tx.acoustic_weight(w, F.col("spoken")) * 10).cast("bigint").alias("tenths"))


@query()
def word_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC-12: times of every word of the aligned sentences by acoustic weight."""
    df = once(table(spark, sf_dir, "aligned_sentences")).where("`end` >= `start` AND source_text IS NOT NULL")
    ws = F.filter(F.split("source_text", r"\s+"), lambda x: x != "")
    ex = df.select(*REC, "start", "end", F.posexplode(ws).alias("n", "word")).withColumn("spoken", kernels.numbers_written(F.col("word")))
    return sequence.word_spans(ex, [*REC, "start"], "n", tx.acoustic_weight(F.col("word"), F.col("spoken")), "start", "end").select(*REC, "n", "word", "span_start", "span_end")


@query()
def spoken_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC-03: tokens as spoken, per record. No SQL: look-around. Checked against fixtures."""
    df = canonical(spark, sf_dir).where("text IS NOT NULL")
    return df.select(*REC, F.array_join(tx.spoken_tokens(F.col("text")), " ").alias("tokens"))


@query(r"""
WITH d AS (SELECT doc_id, text AS t FROM documents WHERE text IS NOT NULL),
a AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '\*\*([^*]+)\*\*', '\1', 'g'), '\*([^*]+)\*', '\1', 'g'), '__([^_]+)__', '\1', 'g'), '~~([^~]+)~~', '\1', 'g') AS t FROM d),
b AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '\[\s*\d+(?:\s*[,–-]\s*\d+)*\s*\]', '', 'g'), '\[([^\]]+)\]', '\1', 'g'), '[\[\]]', ' ', 'g'), '[*†‡§¶•◦▪▫‣#~_]', ' ', 'g') AS t FROM a),
c AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '(\d),(\d{3}(?:\b|\D))', '\1\2', 'g'), '(\d),(\d{3}(?:\b|\D))', '\1\2', 'g'), '(\d),(\d{3}(?:\b|\D))', '\1\2', 'g'), '(\d),(\d{3}(?:\b|\D))', '\1\2', 'g'), '(\d),(\d{3}(?:\b|\D))', '\1\2', 'g'), '(\d),(\d{3}(?:\b|\D))', '\1\2', 'g') AS t FROM b)
SELECT doc_id, trim(regexp_replace(regexp_replace(t, '[\t\n\x0B\f\r ]+([,.:;?!])', '\1', 'g'), '[\t\n\x0B\f\r ]+', ' ', 'g')) AS clean FROM c
""")
def speech_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC-09: every document cleaned for a synthesizer."""
    return table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", tx.clean_for_speech(F.col("text")).alias("clean"))


@query("""
SELECT book, track_index, CASE WHEN floor(d / 60) >= 60 THEN floor(d / 3600)::BIGINT || 'h ' || lpad(((floor(d / 60)::BIGINT) % 60)::VARCHAR, 2, '0') || 'm' ELSE (floor(d / 60)::BIGINT % 60) || 'm' END AS shown
FROM (SELECT book, track_index, greatest(0, coalesce(duration, 0)) * 40 AS d FROM tracks)
""")
def track_lengths_shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC-26: track lengths (at forty times, so that hours occur) as shown on a shelf."""
    return table(spark, sf_dir, "tracks").select("book", "track_index", tx.hours_minutes(F.col("duration") * 40).alias("shown"))


@query(f"""
WITH c AS ({CANON_SQL}), q AS (SELECT book, chapter, seq, id, (length(text) - length(replace(text, '“', '')))::BIGINT AS o, (length(text) - length(replace(text, '”', '')))::BIGINT AS k FROM c WHERE text IS NOT NULL)
SELECT book, chapter, seq, id, sum(o - k) OVER (PARTITION BY book, chapter ORDER BY seq, id ROWS UNBOUNDED PRECEDING)::BIGINT AS depth FROM q
""")
def running_quote_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-10: open curly quotations after each record."""
    def n(ch: str):
        return (F.length("text") - F.length(F.replace(F.col("text"), F.lit(ch), F.lit("")))).cast("bigint")
    df = canonical(spark, sf_dir).where("text IS NOT NULL")
    return sequence.running_balance(df, CH, ["seq", "id"], n("“"), n("”")).select(*CH, "seq", "id", "depth")


@query(f"""
WITH c AS ({CANON_SQL}), q AS (SELECT book, chapter, sum(length(text) - length(replace(text, '“', ''))) AS o, sum(length(text) - length(replace(text, '”', ''))) AS k, sum(length(text) - length(replace(text, '"', ''))) AS s FROM c GROUP BY book, chapter)
SELECT book, chapter, (o - k)::BIGINT AS curly_balance, (s % 2)::BIGINT AS straight_odd FROM q WHERE o <> k OR s % 2 = 1
""")
def chapter_quote_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-20: chapters whose quotation marks do not balance."""
    def n(ch: str):
        return F.sum(F.length("text") - F.length(F.replace(F.col("text"), F.lit(ch), F.lit(""))))
    q = canonical(spark, sf_dir).groupBy(*CH).agg(n("“").alias("o"), n("”").alias("k"), n('"').alias("s"))
    return q.where("o <> k OR s % 2 = 1").select(*CH, (F.col("o") - F.col("k")).cast("bigint").alias("curly_balance"), (F.col("s") % 2).cast("bigint").alias("straight_odd"))


@query(f"""
WITH c AS ({CANON_SQL}), g AS (SELECT *, sum(CASE WHEN elem_idx IS NULL OR p IS NULL OR p <> elem_idx THEN 1 ELSE 0 END) OVER (PARTITION BY book, chapter ORDER BY seq, id, elem_idx NULLS FIRST, text NULLS FIRST ROWS UNBOUNDED PRECEDING) AS run
  FROM (SELECT *, lag(elem_idx) OVER (PARTITION BY book, chapter ORDER BY seq, id, elem_idx NULLS FIRST, text NULLS FIRST) AS p FROM c))
SELECT book, chapter, run::BIGINT AS run, count(*) AS n, min(seq) AS first_seq, string_agg(text, ' ' ORDER BY seq, id, text) AS text FROM g GROUP BY book, chapter, run
""")
def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-05, AG-21: records of one element joined to paragraphs."""
    runs = sequence.run_ids(canonical(spark, sf_dir), CH, ["seq", "id", "elem_idx", "text"], F.col("elem_idx"))
    parts = F.sort_array(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("seq", "id", "text"))))
    g = runs.groupBy(*CH, "run").agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"), parts.alias("p"))
    return g.select(*CH, "run", "n", "first_seq", F.when(F.size("p") > 0, F.array_join(F.transform("p", lambda x: x["text"]), " ")).alias("text"))


@query(f"WITH c AS ({CANON_SQL}) SELECT book, chapter, id, (row_number() OVER (PARTITION BY book, chapter ORDER BY seq, id) - 1)::BIGINT AS pos, 's-' || (row_number() OVER (PARTITION BY book, chapter ORDER BY seq, id)) AS new_id FROM c")
def sequence_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-11: position and sequence id of every record."""
    df = canonical(spark, sf_dir).withColumnRenamed("id", "old")
    w = sequence.sequence_ids(df.withColumnRenamed("seq", "k"), CH, ["k", "old"], first=1)
    return w.select(*CH, F.col("old").alias("id"), (F.col("seq") - 1).cast("bigint").alias("pos"), F.col("id").alias("new_id"))


@query(f"""
WITH c AS ({CANON_SQL})
SELECT book, chapter, count(*) AS n, count(DISTINCT elem_idx) AS elems, count(*) >= 15 AND count(DISTINCT elem_idx)::DOUBLE / count(*) > 0.85 AS shredded FROM c GROUP BY book, chapter
""")
def shredded_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-19: chapters in which nearly every sentence is an element of its own."""
    g = canonical(spark, sf_dir).groupBy(*CH).agg(F.count("*").alias("n"), F.count_distinct("elem_idx").alias("elems"))
    return g.withColumn("shredded", (F.col("n") >= 15) & (F.col("elems") / F.col("n") > 0.85))


@query("""
SELECT doc_id, sha256(text) AS digest, count(*) OVER (PARTITION BY sha256(text)) AS copies, min(doc_id) OVER (PARTITION BY sha256(text)) AS class_id FROM documents WHERE text IS NOT NULL
""")
def exact_duplicate_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-19 exact, SC-31: every document with the class of its copies. Classes are counted by digest before documents meet them, so a hot text shuffles as one row a task."""
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.sha2("text", 256).alias("digest"))
    classes = d.groupBy("digest").agg(F.count("*").alias("copies"), F.min("doc_id").alias("class_id"))
    return d.join(classes, "digest").select("doc_id", "digest", "copies", "class_id")


@query(r"""
SELECT doc_id, regexp_replace(lower(replace(translate(text, '“”„«»‘’‚‹›—–−', repeat('"', 5) || repeat('''', 5) || '---'), '…', '...')), '[\t\n\x0B\f\r ]+', ' ', 'g') AS folded FROM documents WHERE text IS NOT NULL
""")
def folded_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP-08: every document with all quote, dash and ellipsis classes folded."""
    df = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    return df.select("doc_id", F.regexp_replace(tx.fold(F.col("text")), r"[\t\n\x0B\f\r ]+", " ").alias("folded"))
