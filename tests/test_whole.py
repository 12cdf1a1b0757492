"""Queries and operators over what shortcuts would leave out."""

import __spark_entry__
from sonograin.operators import audit, relate


def put(spark, folder, **tables):
    """Write tables (rows, schema) as the files that the queries read."""
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_folded_text_of_every_document(spark, tmp_path):
    texts = ["„Ja“ ‚so‘", "« Oui » ‹ non ›", "−3 – 4", "Plain…", None]
    d = put(spark, tmp_path, documents=(list(enumerate(texts)), "doc_id bigint, text string"))
    got = {r["doc_id"]: r["folded"] for r in __spark_entry__.queries()["folded_text"](spark, d).collect()}
    assert got == {0: "\"ja\" 'so'", 1: "\" oui \" ' non '", 2: "-3 - 4", 3: "plain..."}


def test_text_keys_of_records_with_brackets(spark, tmp_path):
    texts = ["The Book (2nd ed.) of X!", "A [note] b", "x (a [b] c) y", "p [q (r] s) t", "open ( end", "none", None]
    rows = [("b", 1, i, f"s-{i}", 0, "p", t, False, False, False) for i, t in enumerate(texts)]
    schema = "book string, chapter int, seq int, id string, elem_idx int, tag string, text string, is_heading boolean, is_tabular boolean, is_footnote boolean"
    d = put(spark, tmp_path, canonical_sentences=(rows, schema))
    got = {r["id"]: (r["slug"], r["natural_key"], len(r["digest"])) for r in __spark_entry__.queries()["text_keys"](spark, d).collect()}
    slugs = ["the-book-of-x", "a-b", "x-y", "p-q-t", "open-end", "none"]
    assert {k: v[0] for k, v in got.items()} == {f"s-{i}": s for i, s in enumerate(slugs)}
    assert got["s-0"][1:] == ("the book (000000000002nd ed.) of x!", 64)


def test_exact_starts_compares_long_phrases_to_the_end(spark):
    toks = ["x", *[f"w{i}" for i in range(100)], "y", *[f"w{i}" for i in range(90)], "z"]
    seq = spark.createDataFrame([("k", i, t) for i, t in enumerate(toks)] + [(None, 0, "x")], "k string, i int, t string")
    ph = spark.createDataFrame([("k", 1, [f"w{i}" for i in range(100)]), ("k", 2, [f"w{i}" for i in range(90)]), ("k", 3, [*[f"w{i}" for i in range(90)], "q"]), ("k", 4, ["w89", "z", "x"]), (None, 5, ["x"])], "k string, p int, w array<string>")
    got = {(r["p"], r["start"]) for r in relate.exact_starts(ph, ["p"], "w", seq, ["k"], "i", "t").collect()}
    assert got == {(1, 1), (2, 1), (2, 102)}


def test_passages_stand_with_all_their_words(spark, tmp_path):
    words = "he went home again . he went home late . yes he went".split()
    texts = {"s-1": "He went home again.", "s-2": "He went home!", "s-3": "Yes.", "s-4": "He went", "s-5": "He went home never", "s-6": "..."}
    d = put(
        spark, tmp_path, acoustic_words=([("b", 1, i, w) for i, w in enumerate(words)], "book string, chapter int, token_index bigint, word string"),
        aligned_sentences=([("b", 1, k, t) for k, t in texts.items()], "book string, chapter int, id string, source_text string"),
    )
    got = {(r["id"], r["start"], r["places"]) for r in __spark_entry__.queries()["passage_locate_exact"](spark, d).collect()}
    assert got == {("s-1", 0, 1), ("s-2", 0, 2), ("s-2", 5, 2), ("s-3", 10, 1), ("s-4", 0, 3), ("s-4", 5, 3), ("s-4", 11, 3)}


def test_runs_of_single_sentence_paragraphs(spark):
    plain, rows = "This line stands alone here in print.", []

    def chapter(n, texts, before=(), after=("Two of one.", "The other of it.") * 20):
        paired = [(t, 900 + i // 2, False) for i, t in enumerate(after)]
        for i, (t, e, h) in enumerate([*before, *[(t, 100 + i, False) for i, t in enumerate(texts)], *paired]):
            rows.append(("b", n, i, f"s-{i}", e, "p", t, h, False, False))

    chapter(1, [plain] * 8)
    chapter(2, [plain] * 7)
    chapter(3, [plain] * 8, [("The following lines all belong to this:", 1, False)])
    chapter(4, [plain] * 8, [("Glossary", 1, True)])
    chapter(5, [plain] * 8, [("Glossary", 1, True)], ())
    chapter(6, ["One part of this; the other part of it."] * 6 + [plain] * 2)
    chapter(7, ["Does this line stand alone in print?"] * 4 + [plain] * 4)
    chapter(8, ["But this line stands alone in print."] * 3 + [plain] * 5)
    chapter(9, [plain] * 4 + ["“This line is spoken by someone here.”"] + [plain] * 4)
    chapter(10, [plain] * 8, [("Acknowledgments", 1, True)])
    chapter(11, ["This = that and the other of it."] * 4 + [plain] * 5)
    c = spark.createDataFrame(rows, "book string, chapter int, seq int, id string, elem_idx int, tag string, text string, is_heading boolean, is_tabular boolean, is_footnote boolean")
    got = {(r["chapter"], r["detail"]) for r in audit.typography(c).where("rule = 'one_sentence_run'").collect()}
    assert got == {(1, "8: s-0, s-1, s-2, s-3"), (5, "8: s-1, s-2, s-3, s-4")}
