
from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sonograin.functions.text import natural_key

SENTENCE = "id string, text string, elem_idx int, tag string, is_heading boolean, is_tabular boolean, is_footnote boolean"
ANALYSIS = "id string, text string, trans string, vocab array<struct<word:string,pos:string,def:string>>"
WORD = "word string, start double, `end` double, probability double"
ACOUSTIC = f"schema_version int, acoustic_profile_version int, model string, source_audio_sha256 string, transcription_options map<string,string>, word_timestamps boolean, dropped_zero_duration_words int, words array<struct<{', '.join(x.split()[0].strip('`') + ':' + x.split()[1] for x in WORD.split(', '))}>>"
ALIGNED = "id string, text string, source_text string, start double, `end` double, raw_start double, raw_end double, word_start int, word_end int, has_audio_match boolean, matched_token_count int, source_token_count int, match_ratio double, alignment_method string, fallback_used boolean, alignment_status string, alignment_reason string, is_heading boolean"


def chapter_of(path: Column) -> Column:
    """SR-11: chapter number in an artifact's file name, `..._ch12_...`; null if there is none."""
    return F.nullif(F.regexp_extract(path, r"_ch0*(\d+)_", 1), F.lit("")).try_cast("int")


def read_records(spark: SparkSession, path: str, schema: str, pattern: str) -> DataFrame:
    """SR-12: records of JSON array files as rows with `book` (the folder), `chapter`, `seq` and `corrupt`.

    The array position becomes `seq`. A file that is no valid JSON gives one row with `corrupt`."""
    whole = spark.read.option("wholetext", "true").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(path).withColumn("__p", F.col("_metadata.file_path"))
    parsed = whole.withColumn("__r", F.from_json("value", f"array<struct<{_inline(schema)}>>"))
    rows = parsed.select("__p", F.col("__r").isNull().alias("corrupt"), F.posexplode_outer("__r").alias("seq", "r"))
    return rows.select(F.regexp_extract("__p", r"([^/]+)/[^/]+$", 1).alias("book"), chapter_of(F.col("__p")).alias("chapter"), F.coalesce("seq", F.lit(0)).alias("seq"), "r.*", "corrupt")


def _inline(schema: str) -> str:
    """A column list as the fields of a struct type."""
    out, depth, field = [], 0, ""
    for ch in schema + ",":
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            name, kind = field.strip().split(" ", 1)
            out.append(f"{name}: {kind}")
            field = ""
        else:
            field += ch
    return ", ".join(out)


def read_acoustic(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SR-12, SR-16: recognition files as (runs, words): header fields per chapter, and words with token_index."""
    whole = spark.read.option("wholetext", "true").option("pathGlobFilter", "*_acoustic_words.json").option("recursiveFileLookup", "true").text(path).withColumn("__p", F.col("_metadata.file_path"))
    doc = whole.select(F.regexp_extract("__p", r"([^/]+)/[^/]+$", 1).alias("book"), chapter_of(F.col("__p")).alias("chapter"), F.from_json("value", f"struct<{_inline(ACOUSTIC)}>").alias("a"))
    runs = doc.select("book", "chapter", *[f"a.{c}" for c in ("schema_version", "acoustic_profile_version", "model", "source_audio_sha256", "transcription_options", "word_timestamps", "dropped_zero_duration_words")])
    words = doc.select("book", "chapter", F.posexplode("a.words").alias("token_index", "w")).select("book", "chapter", "token_index", "w.word", "w.start", "w.end", "w.probability")
    return runs, words


def normalise_words(words: DataFrame, keys: list[str], strict: bool = False) -> DataFrame:
    """SR-17: words with text and a positive length, times to 2 and probability to 4 places (null: 0.95), numbered anew.

    strict: a blank, untimed or reversed word is an error instead of being left out."""
    bad = (F.trim(F.coalesce("word", F.lit(""))) == "") | F.col("start").isNull() | F.col("end").isNull() | (F.col("end") < F.col("start"))
    if strict:
        words = words.withColumn("word", F.when(bad, F.raise_error(F.lit("blank, untimed or reversed word"))).otherwise(F.col("word")))
    kept = words.where(~F.coalesce(bad, F.lit(True)) & (F.col("end") > F.col("start")))
    w = Window.partitionBy(*keys).orderBy("token_index")
    return kept.select(*keys, (F.row_number().over(w) - 1).alias("token_index"), F.trim("word").alias("word"), F.round("start", 2).alias("start"), F.round("end", 2).alias("end"), F.round(F.coalesce("probability", F.lit(0.95)), 4).alias("probability"))


def read_tracks(spark: SparkSession, path: str, duration: Callable[[Column], Column] | None = None) -> DataFrame:
    """SR-10: audio files as (book, track_index, path, name, bytes, sha256, duration), in natural order within a folder.

    `duration` computes seconds from the content; without it the column is null."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", "*.{mp3,m4a,m4b,aac,flac,opus}").option("recursiveFileLookup", "true").load(path)
    name = F.regexp_extract("path", "([^/]+)$", 1)
    d = duration(F.col("content")) if duration else F.lit(None).cast("double")
    rows = f.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("book"), "path", name.alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), d.alias("duration"))
    return rows.withColumn("track_index", F.row_number().over(Window.partitionBy("book").orderBy(natural_key(F.col("name")), "name")))


def read_reader_pages(spark: SparkSession, path: str) -> DataFrame:
    """SR-15: sections of compiled reader pages: (book, chapter, audio, unit, s, e), one row per sentence unit with times."""
    whole = spark.read.option("wholetext", "true").option("pathGlobFilter", "*.html").option("recursiveFileLookup", "true").text(path).withColumn("__p", F.col("_metadata.file_path"))
    sec = whole.select(F.regexp_extract("__p", r"([^/]+)/[^/]+$", 1).alias("book"), F.explode(F.regexp_extract_all("value", F.lit(r"(?s)(<section\b.*?</section>)"), 1)).alias("h"))
    sec = sec.select("book", F.regexp_extract("h", r'data-ch="(\d+)"', 1).try_cast("int").alias("chapter"), F.nullif(F.regexp_extract("h", r'data-audio="([^"]*)"', 1), F.lit("")).alias("audio"), "h")
    a, b = (F.regexp_extract_all("h", F.lit(rf'data-start="([^"]*)"[^>]*data-end="([^"]*)"'), i) for i in (1, 2))
    return sec.select("book", "chapter", "audio", F.posexplode(F.arrays_zip(a.alias("s"), b.alias("e"))).alias("unit", "u")).select("book", "chapter", "audio", "unit", F.col("u.s").try_cast("double").alias("s"), F.col("u.e").try_cast("double").alias("e"))


def manifest(tracks: DataFrame, base_url: str) -> DataFrame:
    """SK-02: entries of an audio manifest: chapter from 1, object key and address of every track."""
    key = F.concat_ws("/", "book", F.concat(F.lpad(F.col("track_index").cast("string"), 3, "0"), F.lit("_"), F.left("sha256", F.lit(12)), F.regexp_extract("name", r"(\.[^.]+)$", 1)))
    return tracks.select("book", F.col("track_index").alias("chapter"), F.col("path").alias("source_path"), "sha256", "bytes", key.alias("object_key"), F.concat(F.lit(base_url.rstrip("/") + "/"), key).alias("public_url"))


def write_records(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """SK-01: rows as JSON lines, written anew by Spark's committer: readers see all of it or nothing (_SUCCESS)."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*by) if by else w).json(path)


def replay(spark: SparkSession, path: str) -> Callable[[DataFrame], DataFrame]:
    """X-01, SR-16: a recogniser that answers from recorded words: chapters in, their recorded words out."""
    words = spark.read.parquet(os.path.join(path, "acoustic_words.parquet"))
    return lambda chapters: words.join(chapters.select("book", "chapter").distinct(), ["book", "chapter"], "left_semi")
