"""Queries of the sequence algorithms and of the aligner."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonograin.functions import text as tx
from sonograin.operators import align, kernels
from sonograin.plans.catalog import query
from sonograin.plans.texts import CH, REC, analysed, canonical
from sonograin.plans.timeline import spoken
from sonograin.tables import once, table


def _sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical(spark, sf_dir).where("text IS NOT NULL").dropDuplicates(REC)


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spoken(spark, sf_dir).withColumnsRenamed({"s": "start", "e": "end"})


def _english(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "chapter_metadata").where("lang = 'en'").select(*CH).distinct()


@query()
def aligned_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQ-12: sentences of every chapter that has audio, aligned anew. Checked against fixtures."""
    words = _words(spark, sf_dir)
    s = _sentences(spark, sf_dir).join(words.select(*CH).distinct(), CH, "left_semi")
    return align.align_chapters(s, words, CH, ["seq", "id"], "id", "text", "token_index")


@query()
def monotone_subsequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQ-01 over the word positions of each chapter's sentences. Checked against brute force."""
    a = once(table(spark, sf_dir, "aligned_sentences")).where("has_audio_match")
    return kernels.monotone_rows(a.select(*CH, "seq", "word_start"), CH, "seq", "word_start")


@query()
def passage_locate_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-16, TK-01: where the opening record of each chapter starts in the chapter's audio. Checked against brute force."""
    first = canonical(spark, sf_dir).where("text IS NOT NULL AND NOT is_heading").groupBy(*CH).agg(F.min_by(F.struct("id", "text"), F.struct("seq", "id")).alias("r"))
    t = first.select(*CH, "r.id", "r.text")
    words = _words(spark, sf_dir).select(*CH, "token_index", "word")
    return kernels.locate_texts(t.join(words.select(*CH).distinct(), CH, "left_semi"), words, CH, "id", "text", "token_index", "word")


@query()
def book_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQ-02, JN-17, AG-12: chapters of each book paired with its tracks by anchors, lengths and counts."""
    rows = canonical(spark, sf_dir).where("text IS NOT NULL")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "id", "text"))), lambda x: x["text"]), " ")
    c = rows.groupBy(*CH).agg(joined.alias("t")).select("book", F.col("chapter").alias("n"), tx.anchor(F.col("t")).alias("head"), tx.anchor(F.col("t"), tail=True).alias("tail"), F.length("t").alias("chars"))
    heard = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("token_index", F.coalesce("word", F.lit("")).alias("w")))), lambda x: x["w"]), " ")
    w = _words(spark, sf_dir).groupBy(*CH).agg(heard.alias("t"))
    t = table(spark, sf_dir, "tracks").select("book", F.col("track_index").alias("chapter"), "duration").dropDuplicates(CH).join(w, CH, "left")
    t = t.select("book", F.col("chapter").alias("n"), F.coalesce(tx.anchor(F.col("t")), F.lit("")).alias("head"), F.coalesce(tx.anchor(F.col("t"), tail=True), F.lit("")).alias("tail"), F.coalesce("duration", F.lit(0.0)).alias("duration"))
    return kernels.reconcile_books(c.join(t.select("book").distinct(), "book", "left_semi"), t).select("book", "step", "kind", F.array_join("chapters", ",").alias("chapters"), F.array_join("tracks", ",").alias("tracks"), "confidence")


@query()
def rebuilt_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-16: paragraph numbers of every chapter, shredded ones rebuilt. Checked against fixtures."""
    return kernels.per_group(_sentences(spark, sf_dir), CH, ["seq", "id"], "text,elem_idx,is_heading", "paragraph", "int", kernels.rebuild_paragraphs)


@query()
def healed_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQ-14: texts of every chapter with balanced quotation marks. Checked against fixtures."""
    return kernels.per_group(_sentences(spark, sf_dir), CH, ["seq", "id"], "text", "healed", "string", lambda rows: kernels.balance_quotes([r["text"] for r in rows]))


@query()
def rendering_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQ-03, SC-23: likeness of each analysed text and its canonical record, where they are not the same but for marks."""
    c = canonical(spark, sf_dir).select(*REC, F.col("text").alias("ct"))
    j = analysed(spark, sf_dir).select(*REC, "text").join(c, REC).where("text IS NOT NULL AND ct IS NOT NULL")
    j = j.withColumn("same", tx.same_but_for_marks(F.col("text"), F.col("ct")))
    return j.withColumn("likeness", F.when(F.col("same"), F.lit(1.0)).otherwise(kernels.ratio_column(F.col("text"), F.col("ct")))).select(*REC, "same", "likeness")


@query()
def spoken_number_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC-10: records with numbers, written out. Checked against fixtures."""
    return canonical(spark, sf_dir).where(F.col("text").rlike(r"\d")).select(*REC, kernels.spoken_numbers("text").alias("text"))


@query()
def aligned_word_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQ-10: times of the words of every sentence that is found in the audio. Checked against fixtures."""
    words = _words(spark, sf_dir)
    s = _sentences(spark, sf_dir).join(words.select(*CH).distinct(), CH, "left_semi")
    return align.word_times(s, words, CH, ["seq", "id"], "id", "text", "token_index")
