"""Registered queries of the package over whole tables of the smallest scale: columns, uniqueness, determinism where promised."""

import os

import pytest

from sonograin.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "p1_found": ["book", "chapter", "id", "char_start", "char_end"], "p2_found": ["book", "chapter", "first_index", "last_index"], "p3_found": ["book", "chapter", "reading_level"],
    "p4_found": ["tbl", "book", "chapter", "key_1", "key_2"], "p7_found": ["book", "chapter", "id", "defect"], "p8_ids": ["doc_id", "ids"], "p9_found": ["doc_id", "item_id"], "p10_found": ["doc_id", "kind"],
}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", list(COLUMNS))
def test_shape(spark, name):
    df = queries.QUERIES[name](spark, SF)
    rows = [tuple(str(x) for x in r) for r in df.collect()]
    assert df.columns == COLUMNS[name] and rows and len(rows) == len(set(rows))
    assert sorted(rows) == sorted(tuple(str(x) for x in r) for r in queries.QUERIES[name](spark, SF).collect())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_percentiles_cover_books_and_all(spark):
    rows = queries.p6_percentiles(spark, SF).collect()
    assert {r["measure"] for r in rows if r["book"] is None} == {"duration", "trans_length"}
    whole = next(r for r in rows if r["book"] is None and r["measure"] == "duration")
    books = {r["book"]: r["n"] for r in rows if r["book"] and r["measure"] == "duration"}
    assert whole["n"] == sum(books.values()) and all(r["lo"] <= r["value"] <= r["hi"] for r in rows)
