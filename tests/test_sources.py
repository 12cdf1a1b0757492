"""EPUB and artifact sources, streams, audits."""

import json
import zipfile

from pyspark.sql import functions as F

from sonograin.operators import audit
from sonograin.sources import artifacts, epub
from sonograin.streaming.islands import session_islands

PAGE = "<html><body>{}</body></html>"


def make_epub(path):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("META-INF/container.xml", '<container><rootfiles><rootfile full-path="O/c.opf"/></rootfiles></container>')
        z.writestr("O/c.opf", '<package xmlns:dc="d"><metadata><dc:title>My Book</dc:title><dc:creator>Me</dc:creator></metadata><manifest><item id="e" href="e.xhtml" media-type="application/xhtml+xml"/><item id="a" href="a.xhtml" media-type="application/xhtml+xml"/><item id="b" href="b.xhtml" media-type="application/xhtml+xml"/><item id="n" href="nav.xhtml" media-type="application/xhtml+xml" properties="nav"/></manifest><spine><itemref idref="e"/><itemref idref="a"/><itemref idref="b"/></spine></package>')
        z.writestr("O/nav.xhtml", '<html><a href="a.xhtml#x">One</a><a href="b.xhtml">Two</a></html>')
        z.writestr("O/e.xhtml", PAGE.format(""))
        z.writestr("O/a.xhtml", PAGE.format("<h1>Chapter 1</h1><p>Alpha begins.<sup>1</sup> Beta<br/>follows.</p><div>Outer <p>inner one.</p></div><p class='footnote'>gone <br> x</p><table><tr><td>cell</td></tr></table>"))
        z.writestr("O/b.xhtml", PAGE.format("<p>Second text here.</p><script>no()</script>"))


def test_epub(spark, tmp_path):
    make_epub(tmp_path / "x.epub")
    (tmp_path / "bad.epub").write_bytes(b"not a zip")
    df = epub.read_epubs(spark, str(tmp_path))
    rows = df.where("error IS NULL").orderBy("position").collect()
    assert [(r["toc_title"], r["title"], r["author"]) for r in rows] == [("One", "My Book", "Me"), ("Two", "My Book", "Me")]
    assert "no()" not in rows[1]["text"] and rows[1]["head"] == "second text here"
    assert df.where("error IS NOT NULL").count() == 1
    els = epub.elements(df.where("error IS NULL"), ["path", "position"]).where("position = 0").orderBy("elem").collect()
    assert [(e["tag"], e["text"], e["is_tabular"]) for e in els] == [("h1", "Chapter 1", False), ("p", "Alpha begins. Beta follows.", False), ("div", "Outer", False), ("p", "inner one.", False), ("td", "cell", True)]
    can = epub.canonical_sentences(epub.elements(df.where("error IS NULL"), ["path", "position"]), ["path", "position"]).where("position = 0").orderBy("seq").collect()
    assert [c["text"] for c in can][:3] == ["Chapter 1", "Alpha begins.", "Beta follows."] and can[0]["is_heading"] and can[0]["id"] == "s-1"
    assert epub.blocks(None) == [] and epub.blocks("") == []


def test_between_markers(spark):
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(["x", "START", "a", "STOP", "b", "START", "c"])], "k int, i int, t string")
    got = epub.between_markers(df, ["k"], "i", F.col("t") == "START", F.col("t") == "STOP").orderBy("i").collect()
    assert [r["t"] for r in got] == ["START", "a"]


def test_artifacts(spark, tmp_path):
    d = tmp_path / "book"
    d.mkdir()
    (d / "x_ch01_canonical_sentences.json").write_text(json.dumps([{"id": "s-1", "text": "Alpha begins."}, {"id": "s-2", "text": "Beta follows."}]))
    (d / "x_ch02_canonical_sentences.json").write_text("{broken")
    (d / "x_ch01_acoustic_words.json").write_text(json.dumps({"model": "m", "word_timestamps": True, "transcription_options": {"beam": "5"}, "words": [{"word": "Alpha", "start": 0.0, "end": 0.3}, {"word": " ", "start": 0.3, "end": 0.4}, {"word": "z", "start": 0.5, "end": 0.5}]}))
    rows = artifacts.read_records(spark, str(tmp_path), artifacts.SENTENCE, "*_canonical_sentences.json").orderBy("chapter", "seq").collect()
    assert [(r["book"], r["chapter"], r["seq"], r["id"], r["corrupt"]) for r in rows] == [("book", 1, 0, "s-1", False), ("book", 1, 1, "s-2", False), ("book", 2, 0, None, True)]
    runs, words = artifacts.read_acoustic(spark, str(tmp_path))
    assert runs.first()["model"] == "m" and words.count() == 3
    assert [tuple(r)[2:] for r in artifacts.normalise_words(words, ["book", "chapter"]).collect()] == [(0, "Alpha", 0.0, 0.3, 0.95)]
    (d / "10.mp3").write_bytes(b"b")
    (d / "9.mp3").write_bytes(b"a")
    t = artifacts.read_tracks(spark, str(tmp_path)).orderBy("track_index").collect()
    assert [r["name"] for r in t] == ["9.mp3", "10.mp3"]
    m = artifacts.manifest(artifacts.read_tracks(spark, str(tmp_path)), "https://x/").orderBy("chapter").first()
    assert m["public_url"].startswith("https://x/book/001_")
    (d / "r.html").write_text('<section data-ch="1" data-audio="a.mp3"><span class="sentence-unit" data-start="0.5" data-end="1.5">x</span></section>')
    u = artifacts.read_reader_pages(spark, str(tmp_path)).first()
    assert (u["chapter"], u["audio"], u["s"], u["e"]) == (1, "a.mp3", 0.5, 1.5)


def test_stream_equals_batch(spark, tmp_path):
    schema = "u int, ts timestamp"
    rows = [(1, "2030-01-01 00:00:00"), (1, "2030-01-01 00:05:00"), (1, "2030-01-01 02:00:00"), (2, "2030-01-01 00:01:00")]
    src = spark.createDataFrame(rows, "u int, t string").select("u", F.to_timestamp("t").alias("ts"))
    src.coalesce(1).write.parquet(str(tmp_path / "in/1"))
    spark.createDataFrame([(9, "2031-01-01 00:00:00")], "u int, t string").select("u", F.to_timestamp("t").alias("ts")).coalesce(1).write.parquet(str(tmp_path / "in/2"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    q = session_islands(stream, ["u"], "ts", "30 minutes", "1 minute").writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("u", "n").collect()}
    want = {tuple(r) for r in session_islands(src, ["u"], "ts", "30 minutes", "1 minute").select("u", "n").collect()}
    assert got == want == {(1, 2), (1, 1), (2, 1)}


def test_audits(spark):
    schema = "book string, chapter int, seq int, id string, elem_idx int, tag string, text string, is_heading boolean, is_tabular boolean, is_footnote boolean"
    rows = [("b", 1, i, f"s-{i}", i, "p", t, False, False, False) for i, t in enumerate(["Good one.", "chopped wo-", "lower start.", "", "orphan", "““Twice.”", "https://x.y"])]
    c = spark.createDataFrame(rows, schema)
    got = {(r["id"], r["rule"]) for r in audit.orthography(c).collect()}
    assert got == {("s-1", "trailing_hyphen"), ("s-1", "lowercase_start"), ("s-2", "lowercase_start"), ("s-3", "empty_text"), ("s-4", "lowercase_start"), ("s-4", "orphan_word")}
    assert ("s-5", "repeated_quotes") in {(r["id"], r["rule"]) for r in audit.typography(c).collect()}
    v = audit.verdict(audit.union([audit.orthography(c), audit.typography(c)])).first()
    assert not v["ready"] and v["errors"] == 3
    assert audit.orthography(c.where("1 = 0")).count() == 0
    open_quotes = [r["id"] for r in audit.orthography(c, quotes=True).where("rule = 'unclosed_quote'").collect()]
    assert open_quotes == ["s-5"]
    texts = ["He ran. She hid.", "Mr. Hill ran.", "J. Hill ran.", "No. Never mind.", "He left. Oh no. Never mind.", "“Go!” He ran.", "“Go. Now he ran.", "He said “No.” Then he ran.", "It was *odd* Then it went.", "In the U.S. Army.", "All is one"]
    rows = spark.createDataFrame([("b", 1, i, f"s-{i}", i, "p", t, False, False, False) for i, t in enumerate(texts)], schema)
    assert {r["id"] for r in audit.boundaries(rows).collect()} == {"s-0", "s-4", "s-7", "s-8"}


def test_preflight_and_selection(spark, tmp_path):
    make_epub(tmp_path / "x.epub")
    docs = epub.read_epubs(spark, str(tmp_path))
    p = epub.preflight(docs).first()
    assert (p["documents"], p["paragraphs"], p["image_only"]) == (2, 4, True if p["images"] > 10 else False)
    assert epub.select_chapters(docs).count() == 0 and epub.select_chapters(docs, 10).count() == 2 and epub.select_chapters(docs, 10, ("b.xhtml",)).count() == 1


def test_sound(spark):
    import io
    import wave

    import numpy as np

    from sonograin.functions import sound

    rng = np.random.default_rng(1)
    quiet, loud = rng.normal(0, 5, 16000), 8000 * np.sin(np.arange(16000) / 10)
    pcm = np.concatenate([quiet, loud]).astype("<i2")
    df = spark.createDataFrame([(bytearray(pcm.tobytes()),), (bytearray(b""),), (None,)], "c binary")
    assert [r[0] for r in df.select(sound.silence_ratio("c")).collect()] == [0.5, 0.0, None]
    assert abs(sound.onset(pcm, 0.5, 1.5) - 1.0) <= 0.02 and sound.onset(pcm, 0.1, 0.12) == 0.1
    assert sound.calibrated_starts(pcm, [(0.5, 1.9)]) == [0.92] or abs(sound.calibrated_starts(pcm, [(0.5, 1.9)])[0] - 0.93) <= 0.02
    b = io.BytesIO()
    with wave.open(b, "wb") as w:
        w.setparams((1, 2, 16000, 0, "NONE", ""))
        w.writeframes(pcm.tobytes())
    df = spark.createDataFrame([(bytearray(b.getvalue()),), (bytearray(b"x"),)], "c binary")
    assert [r[0] for r in df.select(sound.wav_seconds("c")).collect()] == [2.0, None]


def test_progress(spark):
    from sonograin.functions import progress

    df = spark.createDataFrame([(2, 150.0, 10, 500, 60.0, 100, 90), (0, 0.0, 0, 0, 0.0, 0, 0)], "i int, p double, n int, c int, s double, t int, k int")
    c = F.col
    rows = df.select(progress.book_percent(c("i"), c("p"), c("n")), progress.words_per_minute(c("c"), c("s")), progress.accuracy(c("k"), c("t"))).collect()
    assert [tuple(r) for r in rows] == [(30, 100, 90), (None, None, 100)]
    a = spark.createDataFrame([("x", 1, 50, True)], "id string, attempts int, best int, completed boolean")
    b = spark.createDataFrame([("x", 1, 70, False), ("y", 1, 20, None)], "id string, attempts int, best int, completed boolean")
    m = progress.merge_ledger(a, b, ["id"])
    assert {tuple(r) for r in m.collect()} == {("x", 2, 70, True), ("y", 1, 20, False)}
    assert tuple(progress.completion(m.withColumn("b", F.lit(1)), b.withColumn("b", F.lit(1)), ["b"], ["b", "id"]).first()) == (1, 2, 1, 0.5)


def test_page_integrity(spark):
    u = spark.createDataFrame([("b", 2, 0, 5.0, 6.0), ("b", 2, 1, 6.5, 7.0), ("b", 2, 2, 20.0, 21.0), ("b", 2, 3, 40.0, 41.0), ("b", 1, 0, 20.0, 21.0), ("b", 2, 4, None, 50.0)], "book string, chapter int, unit int, s double, e double")
    none = spark.createDataFrame([], "book string, chapter int, start bigint, end bigint")
    got = {(r["chapter"], r["rule"], r["start"], r["end"]) for r in audit.page_integrity(u, none).collect()}
    assert got == {(2, "LEADING_VOID", 0, 5000), (2, "INTER_SENTENCE_VOID", 7000, 20000), (2, "INTER_SENTENCE_VOID", 21000, 40000)}
    skip = spark.createDataFrame([("b", 2, 6500, 19000)], "book string, chapter int, start bigint, end bigint")
    assert {r["start"] for r in audit.page_integrity(u, skip).collect()} == {0, 21000}
