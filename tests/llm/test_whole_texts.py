"""Training-data operators on texts longer or wider than those of the tables."""

import random

import pytest

from sonograin.llm import pairs, quality
from sonograin.llm.sentences import sentence_spans


@pytest.mark.parametrize("n", [5_000, 30_000, 100_000])
def test_copies_of_long_texts(n):
    rng = random.Random(n)
    stock = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 10))) for _ in range(4_000)]
    words = [rng.choice(stock) for _ in range(n // 6)]
    near = [rng.choice(stock) if rng.random() < 0.05 else w for w in words]
    other = [rng.choice(stock) for _ in words]
    text = " ".join(words)
    assert pairs.copied_share(text, text) < 0.05 and pairs.copied_share(text, " ".join(near)) < 0.4 and pairs.copied_share(text, " ".join(other)) > pairs.COPIED
    assert pairs.defect(text, text, "en", frozenset(), None) == "copy"


def test_tables_of_wide_rows(spark):
    def table(n, m, sep, last="7", edge=""):
        return "\n".join(edge + sep.join([*(f"name{j}" if j % 3 else f"{i * j}.25" for j in range(m - 1)), last]) + edge for i in range(n))

    prose = " ".join(["He went home; it was late, and the rain had not stopped; nobody was there to open the door for him."] * 30)
    texts = {1: table(6, 90, ","), 2: table(6, 90, "\t"), 3: table(6, 90, " | ", edge="| "), 4: prose + "\n" + prose, 5: table(6, 90, ",", "total"), 6: table(3, 12_000, "\t")}
    texts |= {7: table(2, 90, ",").replace("name", "abc") + "\n", 8: table(1, 30_000, "\t"), 9: "\n".join(",".join(["abc"] * 120 + [str(i)]) for i in range(5))}
    df = quality.with_ratios(quality.text_counts(spark.createDataFrame(list(texts.items()), "k bigint, t string"), "k", "t", ["the", "and", "was"]))
    got = {r["k"]: (r["kind"], r["row_lines"], r["field_cells"], r["prose_chars"] > 0) for r in df.withColumn("kind", quality.kind_rules()).collect()}
    assert got[4][0] is None and got[4][1] == 0 and got[4][3]
    assert {k: v for k, v in got.items() if k in (1, 2, 3, 5)} == dict.fromkeys((1, 2, 3, 5), ("table", 6, 540, False))
    assert got[6] == ("table", 3, 36_000, False) and got[7] == ("table", 2, 180, False) and got[8][1:] == (1, 30_000, False) and got[9][1:] == (5, 605, False)


@pytest.mark.parametrize(("lang", "opening", "closing", "n"), [("en", '"', '"', 900), ("en", "'", "'", 90), ("de", "»", "«", 30)])
def test_long_speech_is_closed(lang, opening, closing, n):
    text = "She began. " + opening + "Here it went on and on. " * n + "It ended." + closing + " Then all left."
    units = [text[a:b] for a, b in sentence_spans(text, lang)]
    assert units[-2:] == ["It ended." + closing, "Then all left."] and len(units) >= n + 2
