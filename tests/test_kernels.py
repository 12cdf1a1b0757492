"""Sequence kernels and aligner against pinned values and brute force."""

import random
from itertools import combinations

from sonograin.functions import text as tx  # noqa: F401
from sonograin.operators import kernels
from sonograin.operators.align import Chapter, align_chapters


def chapter(texts, words, **flags):
    ws = [{"word": w, "start": float(i), "end": i + 0.5} for i, w in enumerate(words.split())]
    return Chapter([{"text": t, "is_heading": False, "is_tabular": False} | flags for t in texts], ws).run()


def test_exact_and_weak():
    r = chapter(["Alpha begins right here."], "alpha begins right here and goes on")[0]
    assert (r["matched"], r["tokens"], r["match_ratio"], r["status"], r["method"]) == (4, 4, 1.0, "validated", "unique_exact_match")
    r = chapter(["Wholly other text stands."], "alpha begins right here")[0]
    assert r["status"] == "review-required" and r["start"] is None


def test_out_of_order_and_short():
    rows = chapter(["Gamma delta epsilon zeta.", "Alpha beta one two."], "alpha beta one two gamma delta epsilon zeta")
    assert rows[1]["reason"] == "global_match_out_of_order" and rows[1]["status"] == "review-required"
    rows = chapter(["No."], "no well no")
    assert rows[0]["reason"] == "ambiguous_short_sentence"
    rows = chapter(["First words come here.", "Excuse me!", "Then the end came."], "first words come here excuse me then the end came")
    assert rows[1]["method"] == "contextual_short_exact_match" and rows[1]["start"] == 4.0


def test_attribution_left_out():
    rows = chapter(["We shall go north today.", "said Boxer", "Nobody ever answered him again."], "we shall go north today nobody ever answered him again")
    assert rows[1]["method"] == "dialogue_attribution_actor_omitted" and rows[1]["start"] == 4.5


def test_align_edges(spark):
    s = spark.createDataFrame([("b", 1, 1, "s-1", "Alpha begins here.", None, None), ("b", 2, 1, "s-1", None, True, False)], "book string, chapter int, seq int, id string, text string, is_heading boolean, is_tabular boolean")
    w = spark.createDataFrame([("b", 1, i, x, float(i), i + 0.5) for i, x in ((10, "alpha"), (11, "begins"), (13, "here"))] + [("b", 3, 0, "x", None, 1.0)], "book string, chapter int, token_index int, word string, start double, end double")
    got = {r["chapter"]: r for r in align_chapters(s, w, ["book", "chapter"], ["seq"], "id", "text", "token_index").collect()}
    assert (got[1]["word_start"], got[1]["word_end"], got[1]["has_audio_match"]) == (10, 13, True)
    assert got[2]["status"] == "not-applicable" and got[2]["start"] is None and set(got) == {1, 2}


def test_longest_increasing():
    rng = random.Random(1)
    for _ in range(200):
        v = [rng.randrange(6) for _ in range(rng.randrange(9))]
        got = kernels.longest_increasing(v)
        assert all(v[a] <= v[b] for a, b in zip(got, got[1:]))
        best = max((len(c) for n in range(len(v) + 1) for c in combinations(v, n) if list(c) == sorted(c)), default=0)
        assert len(got) == best


def test_locate():
    assert kernels.locate("alpha begins".split(), "noise noise alpha begins now".split())[1][0][0] == 2
    assert kernels.locate([], ["x"]) == ("no-match", [])
    status, found = kernels.locate("a b c d".split(), "a b c d x x a b c d".split())
    assert status == "ambiguous" and len(found) >= 2


def test_reconcile():
    c = [{"head": f"chapter {w} begins", "tail": f"so ends {w}", "chars": 100} for w in ("one", "two", "three")]
    t = [{"head": f"chapter {w} begins", "tail": f"so ends {w}", "duration": 10.0} for w in ("one", "two", "three")]
    assert [r["kind"] for r in kernels.reconcile(c, t)] == ["match"] * 3
    rows = kernels.reconcile([c[0], {"head": "zzz qqq", "tail": "vvv", "chars": 5}, c[1]], t[:2])
    assert [(r["kind"], r["chapters"]) for r in rows if r["kind"] != "match"] == [("skip_chapter", [1])]


def test_numbers_json_quotes():
    for s, w in (("7", "seven"), ("42", "forty two"), ("107", "one hundred and seven"), ("1905", "nineteen oh five"), ("2000", "two thousand"), ("3.14", "three point fourteen"), ("3.05", "three point zero five"), ("1234567", "1234567")):
        assert kernels.spoken_number(s) == w
    assert kernels.read_json('```json\n[{"a": 1}]\n```') == [{"a": 1}]
    assert kernels.read_json('text [{"a": 1} {"b": 2},] more') == [{"a": 1}, {"b": 2}]
    assert kernels.read_json('broken [ {"a": 1}, {"b": ') == [{"a": 1}] and kernels.read_json(None) is None
    for texts, want in ((["“Hi.", "Bye."], ["“Hi.", "Bye.”"]), (['"Hi.', "Bye."], ['"Hi.', 'Bye."']), (["Hi.”"], ["“Hi.”"]), ([], [])):
        assert kernels.balance_quotes(texts) == want and kernels.balance_quotes(want) == want


def test_blocks_and_paragraphs():
    rows = [{"text": "An oversimplifi-", "tag": "p"}, {"text": "cation of it.", "tag": "p"}, {"text": "It went", "tag": "p"}, {"text": "on for long.", "tag": "p"}]
    out = kernels.merge_blocks(rows, lambda b: b["tag"] == "h1", lambda t: False)
    assert [b["text"] for b in out] == ["An oversimplification of it.", "It went on for long."]
    ps = kernels.rebuild_paragraphs([{"text": f"Sentence {i} here.", "elem_idx": i, "is_heading": i == 0} for i in range(16)])
    assert ps == [1, 2, 2, 2, 2, 3, 3, 3, 3, 4, 4, 4, 4, 5, 5, 5]
    kept = [{"text": "x", "elem_idx": 1, "is_heading": False}] * 3
    assert kernels.rebuild_paragraphs(kept) == [1, 1, 1]


def test_word_spans_settle_retakes():
    from sonograin.operators.align import monotone_spans, retakes, settle, source_tokens

    ws = [{"word": w, "start": float(i), "end": i + 0.5} for i, w in enumerate("alpha bitter gamma delta".split())]
    c = Chapter([{"text": "Alpha better gamma delta.", "is_heading": False, "is_tabular": False}], ws)
    c.run()
    assert [(w, a, o) for w, a, _, o in c.word_spans(0)] == [("Alpha", 0.0, "observed"), ("better", 1.0, "observed"), ("gamma", 2.0, "observed"), ("delta.", 3.0, "observed")]
    assert source_tokens("He had sixty eight men") == (["he", "had", "68", "men"], [0, 1, 2, 4])
    assert monotone_spans([(1.0, 1.0), (1.0, 0.5), (2.004, 2.5)]) == [(1.0, 1.01), (1.01, 1.02), (2.0, 2.5)]
    base = {"has_audio_match": True, "status": "validated", "reason": None, "word_end": 9}
    rows = settle([base | {"start": 0.0, "end": 5.0, "word_start": 0, "matched": 4}, base | {"start": 3.0, "end": 4.0, "word_start": 5, "matched": 4}])
    assert rows[0]["end"] == 3.0
    rows = settle([base | {"start": 3.0, "end": 4.0, "word_start": 9, "matched": 1}, base | {"start": 2.0, "end": 5.0, "word_start": 2, "matched": 9}])
    assert rows[0]["start"] is None and rows[0]["reason"] == "non_narrated_text"
    text = "one fine day the old man went down to the sea and sang"
    words = [{"word": w, "start": float(i), "end": i + 0.5} for i, w in enumerate(f"{text} {text} then he slept".split())]
    n = len(text.split())
    rows = [{"has_audio_match": True, "start": 0.0, "end": n - 0.5, "word_start": 0, "word_end": n - 1}, {"has_audio_match": True, "start": 2.0 * n, "end": 2 * n + 2.5, "word_start": 2 * n, "word_end": 2 * n + 2}]
    assert retakes(rows, [text, "then he slept"], words) == [{"first": 0, "last": 0, "skip_start": 0.0, "skip_end": float(n), "likeness": 1.0}]


def test_headings_and_epigraphs():
    for spoken in ("chapter 21", "chapter twenty one"):
        r = chapter(["CHAPTER TWENTY-ONE", "It was a dark night."], f"{spoken} it was a dark night")[0]
        assert (r["method"], r["start"], r["match_ratio"]) == ("chapter_heading_numeric_variant", 0.0, 1.0)
    rows = chapter(["All things pass in time.", "— The Book of Long Days", "It was a dark night."], "a quote from the book of long days all things pass in time it was a dark night")
    assert rows[1]["method"] == "leading_epigraph_attribution" and rows[1]["start"] == 0.0 and rows[1]["status"] == "validated"
    assert rows[0]["method"] == rows[2]["method"] == "unique_exact_match"
