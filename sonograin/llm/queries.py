"""Registered queries of the training-data operators, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonograin.llm import canon, leaks, pairs, quality, quantiles, reading, runs, sentences, tokens
from sonograin.tables import once, plan_bytes, table

CHAPTER = ["book", "chapter"]
RECORD = ["book", "chapter", "id"]


def chapter_langs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(book, chapter, lang), one row per chapter."""
    return table(spark, sf_dir, "chapter_metadata").groupBy(*CHAPTER).agg(F.min("lang").alias("lang"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentence units of every record."""
    rows = once(table(spark, sf_dir, "canonical_sentences").select(*RECORD, "is_heading", "text", "written_at"))
    df = rows.join(chapter_langs(spark, sf_dir), CHAPTER, "left")
    words = sentences.corpus_words(table(spark, sf_dir, "canonical_sentences"), "text")
    return sentences.split_sentences(df, "text", "lang", "is_heading", words).select(*RECORD, "char_start", "char_end").distinct()


def p1_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentence units with their number in the record and their text."""
    rows = once(table(spark, sf_dir, "canonical_sentences").select(*RECORD, "is_heading", "text", "written_at"))
    df = rows.join(chapter_langs(spark, sf_dir), CHAPTER, "left")
    words = sentences.corpus_words(table(spark, sf_dir, "canonical_sentences"), "text")
    units = df.select(*RECORD, "text", F.posexplode(sentences.sentence_units(F.col("text"), F.col("lang"), F.col("is_heading"), words)).alias("unit", "u"))
    return units.select(*RECORD, "unit", F.expr("substring(text, u.char_start + 1, u.char_end - u.char_start)").alias("sentence"))


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.collapse_runs(table(spark, sf_dir, "acoustic_words"), CHAPTER, "token_index", canon.key_column(F.col("word")), "start", "end")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of at least two alike words."""
    found = _runs(spark, sf_dir).where(F.col("count") >= 2)
    return found.select(*CHAPTER, F.col("first_index").cast("int").alias("first_index"), F.col("last_index").cast("int").alias("last_index"))


def p2_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word event, runs collapsed to one with count and duration."""
    return _runs(spark, sf_dir).withColumn("duration", F.round("duration", 3))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading level of every English chapter."""
    english = chapter_langs(spark, sf_dir).where("lang = 'en'").select(*CHAPTER)
    rows = once(table(spark, sf_dir, "canonical_sentences").select(*RECORD, "text", "written_at"))
    df = english.join(rows, CHAPTER, "left")
    return reading.reading_levels(df, table(spark, sf_dir, "reading_labels"), CHAPTER, "text")


def p3_word_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acquisition grade of every word met in the labelled chapters."""
    rows = once(table(spark, sf_dir, "canonical_sentences").select(*RECORD, "text", "written_at"))
    labels = table(spark, sf_dir, "reading_labels").select(*CHAPTER, "reading_level").distinct()
    counts = reading.words_of(rows.join(labels.select(*CHAPTER), CHAPTER, "left_semi"), CHAPTER, "text")
    return reading.word_grades(counts, labels, CHAPTER, "reading_level").where("grade IS NOT NULL").withColumn("grade", F.round("grade", 6))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and spellings of a chapter that look the same but are stored differently."""
    out = []
    for name, text, key in (("canonical_sentences", "text", "id"), ("acoustic_words", "word", None)):
        found = canon.look_alike_pairs(table(spark, sf_dir, name), CHAPTER, text, key)
        out.append(found.select(F.lit(name).alias("tbl"), *CHAPTER, "key_1", "key_2"))
    return out[0].unionByName(out[1])


def p4_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of look-alike records, one row a record."""
    return canon.look_alike_classes(table(spark, sf_dir, "canonical_sentences"), CHAPTER, "text", "id")


def p4_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record's text in the consistent form."""
    rows = once(table(spark, sf_dir, "canonical_sentences").select(*RECORD, "text", "written_at"))
    return canon.canonicalize(rows, "text", "text")


def _first_delivery(df: DataFrame) -> DataFrame:
    """Rows delivered twice once, with the day of the first delivery."""
    return df.groupBy(*[c for c in df.columns if c != "written_at"]).agg(F.to_date(F.min("written_at")).alias("day"))


def p6_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored sketch per measure, book and day of delivery."""
    a = _first_delivery(table(spark, sf_dir, "aligned_sentences").select(*RECORD, "start", "end", "written_at"))
    b = _first_delivery(table(spark, sf_dir, "full_analysis").select(*RECORD, "trans", "written_at"))
    values = a.select(F.lit("duration").alias("measure"), "book", "day", (F.col("end") - F.col("start")).alias("x")).unionByName(
        b.select(F.lit("trans_length").alias("measure"), "book", "day", F.length("trans").cast("double").alias("x"))
    )
    return quantiles.sketch(values, ["measure", "book", "day"], "x")


def p6_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of sentence duration and rendering length, per book and overall (book null), out of the
    merged sketches of all deliveries, with the bound of the rank error."""
    books = quantiles.merge_sketches(p6_deliveries(spark, sf_dir), ["measure", "book"])
    overall = quantiles.merge_sketches(books, ["measure"]).withColumn("book", F.lit(None).cast("string"))
    both = books.unionByName(overall)
    return quantiles.percentiles(both, ["measure", "book"]).withColumn("rank_error", F.lit(round(quantiles.rank_error(), 6)))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text and rendering pairs with a defect."""
    raw = table(spark, sf_dir, "full_analysis").select(*RECORD, "text", "trans", "written_at")
    return pairs.broken_pairs(once(raw).join(chapter_langs(spark, sf_dir), CHAPTER, "left"), RECORD, "text", "trans", "lang", raw)


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document by byte_bpe_50k."""
    path, pattern = tokens.default_files()
    return tokens.encode_texts(table(spark, sf_dir, "documents"), "doc_id", "text", path, pattern)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the passages they leak."""
    found = leaks.find_leaks(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text")
    return found.select("doc_id", "item_id")


def _common(spark: SparkSession, sf_dir: str) -> list[str]:
    words = table(spark, sf_dir, "common_words").select("word").where("word IS NOT NULL").distinct()
    if plan_bytes(words) > 64 << 20:
        raise ValueError("common_words is larger than a word list may be")
    return [r[0] for r in words.collect()]


def p10_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and kind of every document (kind null: running text)."""
    counts = quality.text_counts(table(spark, sf_dir, "documents"), "doc_id", "text", _common(spark, sf_dir))
    return quality.with_ratios(counts).withColumn("kind", quality.kind_rules())


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are mainly no running text."""
    return p10_stats(spark, sf_dir).where("kind IS NOT NULL").select("doc_id", "kind")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (p1_found, p1_sentences, p2_found, p2_runs, p3_found, p3_word_grades, p4_found, p4_classes, p4_canonical, p6_deliveries, p6_percentiles, p7_found, p8_ids, p9_found, p10_found, p10_stats)
}
ORACLES: dict[str, str] = {}
