"""Reading level of each document (problem 3).

Each word gets an acquisition grade from graded text: the grade by which most of its use, corrected for
how much text each grade has, has been met.  A document is then described by quantiles of the grades of
its known words, and the quantiles are calibrated on the labelled documents: a level's profile is
the mean and spread of each quantile over its documents, and a document gets the nearest level.
Everything is counted over all rows; only the profiles (levels x quantiles) reach every task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonograin.llm.canon import canonical_column
from sonograin.tables import maybe_broadcast

#: Share of a word's corrected use by which it counts as acquired.
ACQUIRED = 0.25
#: Quantiles of the word grades that describe a document.
QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9, 0.95)
#: Least number of graded documents a word must be met in to have a grade, and least spread of a quantile.
LEAST_DOCS, LEAST_SPREAD = 2, 0.08


def words_of(df: DataFrame, doc: list[str], text: str) -> DataFrame:
    """(doc, word, n): how often each word occurs in each document, case and look-alike writing set aside; every document has
    a row, one without words that of the word ''."""
    low = F.lower(canonical_column(F.coalesce(F.col(text), F.lit(""))))
    words = df.select(*doc, F.explode_outer(F.regexp_extract_all(low, F.lit(r"([\p{L}]+)"))).alias("word"))
    return words.groupBy(*doc, F.coalesce("word", F.lit("")).alias("word")).agg(F.count("*").alias("n"))


def _labelled(df: DataFrame, labels: DataFrame, doc: list[str], level: str) -> DataFrame:
    """Rows of the labelled documents with their level as `lv`. Keys are compared null-safely: nothing is filtered below, so that
    branches of one plan that start from the same rows share their shuffle."""
    side = labels.select(*[F.col(d).alias(f"__l{i}") for i, d in enumerate(doc)], F.col(level).alias("lv")).where("lv IS NOT NULL")
    return df.join(maybe_broadcast(side), reduce(lambda a, b: a & b, [F.col(d).eqNullSafe(F.col(f"__l{i}")) for i, d in enumerate(doc)])).drop(*[f"__l{i}" for i in range(len(doc))])


def word_grades(counts: DataFrame, labels: DataFrame, doc: list[str], level: str) -> DataFrame:
    """(word, grade DOUBLE): acquisition grade from the labelled documents.

    A word's rate per grade is its share of the grade's running words; the grade is interpolated to where
    the cumulated rates pass ACQUIRED of their sum.  Words met in fewer than LEAST_DOCS labelled
    documents, and '', have a null one. No labels: no rows."""
    per = _labelled(counts, labels, doc, level).groupBy("word", "lv").agg(F.sum(F.when(F.col("word") != "", F.col("n")).otherwise(0)).alias("n"), F.count("*").alias("docs"))
    # levels are few: their totals are one map, a scalar for every row
    totals = per.groupBy("lv").agg(F.sum("n").alias("total")).agg(F.map_from_entries(F.collect_list(F.struct("lv", "total"))))
    rate = per.withColumn("total", F.try_element_at(totals.scalar(), F.col("lv")))
    up = F.sort_array(F.collect_list(F.struct("lv", F.try_divide(F.col("n"), F.col("total")).alias("rate"))))
    words = rate.groupBy("word").agg(up.alias("up"), F.sum("docs").alias("docs"))
    whole = F.aggregate("up", F.lit(0.0), lambda a, x: a + x["rate"])

    def step(a: Column, x: Column) -> Column:
        cum = a["cum"] + x["rate"] / whole
        reached = (x["lv"] - 1 + (F.lit(ACQUIRED) - a["cum"]) / (cum - a["cum"])).cast("double")
        return F.struct(cum.alias("cum"), F.when(a["grade"].isNotNull(), a["grade"]).when(cum >= ACQUIRED, reached).alias("grade"))

    start = F.struct(F.lit(0.0).alias("cum"), F.lit(None).cast("double").alias("grade"))
    known = (F.col("word") != "") & (F.col("docs") >= LEAST_DOCS)
    return words.select("word", F.when(known, F.aggregate("up", start, step)["grade"]).alias("grade"))


def profiles(counts: DataFrame, grades: DataFrame, doc: list[str]) -> DataFrame:
    """(doc, q ARRAY<DOUBLE>): quantiles of the grades of a document's known words, by occurrence.

    A document without a known word has q null."""
    return counts.join(grades, "word", "left").groupBy(*doc).agg(F.percentile("grade", F.array(*map(F.lit, QUANTILES)), F.col("n")).alias("q"))


def calibrate(described: DataFrame, labels: DataFrame, doc: list[str], level: str) -> DataFrame:
    """(level, mean ARRAY, spread ARRAY, docs): the profile of each level over its labelled documents."""
    known = _labelled(described, labels, doc, level).where("q IS NOT NULL")
    n = range(len(QUANTILES))
    mean = F.array(*[F.avg(F.col("q")[i]) for i in n])
    spread = F.array(*[F.greatest(F.coalesce(F.stddev_samp(F.col("q")[i]), F.lit(0.0)), F.lit(LEAST_SPREAD)) for i in n])
    return known.groupBy(F.col("lv").alias(level)).agg(mean.alias("mean"), spread.alias("spread"), F.count("*").alias("docs"))


def _distance(q: Column, mean: Column, spread: Column) -> Column:
    parts = F.zip_with(F.arrays_zip(q.alias("q"), mean.alias("m")), spread, lambda a, s: F.pow((a["q"] - a["m"]) / s, F.lit(2)) + 2 * F.log(s))
    return F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)


def reading_levels(df: DataFrame, labels: DataFrame, doc: list[str], text: str, level: str = "reading_level") -> DataFrame:
    """(doc, level): the level of every document of df, labelled or not, from its words alone.

    Null and empty texts add no words.  Documents without a known word get the smallest level. No
    labels in: level null for all.  Labels of other documents are ignored; one label a document.  The words are counted
    once, the profiles made once: the branches that read them share the shuffle."""
    labels = labels.select(*doc, level).distinct()
    counts = words_of(df, doc, text)
    described = profiles(counts, word_grades(counts, labels, doc, level), doc)
    levels = calibrate(described, labels, doc, level)
    # a level is one small row; all of them are one array, a scalar for every document
    table = levels.agg(F.sort_array(F.collect_list(F.struct(F.col(level).alias("lv"), "mean", "spread"))))
    scored = described.withColumn("levels", table.scalar()).withColumn(
        "best", F.array_min(F.transform("levels", lambda v: F.struct(F.coalesce(_distance(F.col("q"), v["mean"], v["spread"]), F.lit(0.0)).alias("d"), v["lv"].alias("lv"))))
    )
    return scored.select(*doc, F.col("best.lv").alias(level))
