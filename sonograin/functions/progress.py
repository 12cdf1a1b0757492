
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def book_percent(chapter_index: Column, chapter_percent: Column, chapters: Column) -> Column:
    """RP-01: progress in a book of the place in its chapter; null for a book without chapters."""
    inside = F.greatest(F.lit(0.0), F.least(F.lit(100.0), chapter_percent))
    return F.round(F.try_divide(chapter_index + inside / 100, chapters) * 100).cast("int")


def words_per_minute(correct: Column, seconds: Column) -> Column:
    """RP-04: five correct characters are a word; null for no time."""
    return F.round(F.try_divide(correct / 5, seconds / 60)).cast("int")


def accuracy(correct: Column, total: Column) -> Column:
    """RP-04: correct of all characters in percent; 100 if there are none."""
    return F.when(total == 0, 100).otherwise(F.round(F.try_divide(correct, total) * 100).cast("int"))


def merge_ledger(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """RP-06: attempts and best of both, `completed` once true stays true: columns key, attempts, best, completed."""
    both = old.select(*key, "attempts", "best", "completed").unionByName(new.select(*key, "attempts", "best", "completed"))
    return both.groupBy(*key).agg(F.sum("attempts").alias("attempts"), F.max("best").alias("best"), F.bool_or(F.coalesce("completed", F.lit(False))).alias("completed"))


def completion(ledger: DataFrame, sentences: DataFrame, by: list[str], key: list[str]) -> DataFrame:
    """RP-05: (by, total, done, share) of the sentences that are completed."""
    j = sentences.select(*key).distinct().join(ledger.where("completed").select(*key).distinct().withColumn("__d", F.lit(1)), key, "left")
    g = j.groupBy(*by).agg(F.count("*").alias("total"), F.count("__d").alias("done"))
    return g.withColumn("share", F.try_divide("done", "total"))
