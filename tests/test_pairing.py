"""Pairing of chapters and tracks: the same rows as the recurrence over the whole grid, with few anchors compared."""

from __future__ import annotations

import difflib
import random

import pytest

from sonograin.operators import kernels

WORDS = "the of a lonely market boat queen river stone jazz quick fox vexed zebra kept wall mill".split()


def _whole_grid(chapters: list[dict], tracks: list[dict]) -> list[tuple]:
    n, m = len(chapters), len(tracks)
    chars, time = max(1, sum(max(1, c["chars"]) for c in chapters)), max(0.01, sum(max(0.01, t["duration"]) for t in tracks))

    def like(a: str, b: str) -> float:
        return difflib.SequenceMatcher(None, a, b).ratio() if b else 0.0

    def confidence(cs: list[dict], ts: list[dict]) -> float:
        h, t = like(cs[0]["head"], ts[0]["head"]), like(cs[-1]["tail"], ts[-1]["tail"])
        anchors = (h + t) / 2 if ts[0]["head"] and ts[-1]["tail"] else max(h, t)
        share, length = sum(max(1, c["chars"]) for c in cs) / chars, sum(max(0.01, x["duration"]) for x in ts) / time
        return round(0.75 * anchors + 0.15 * min(share, length) / max(share, length) + 0.10 * (min(len(cs), len(ts)) / max(len(cs), len(ts))), 6)

    best = {(0, 0): (0.0, [])}
    for i in range(n + 1):
        for j in range(m + 1):
            score, rows = best[i, j]
            ways = [(i + 1, j, score - 0.10, "skip_chapter")] * (i < n) + [(i, j + 1, score - 0.10, "skip_audio")] * (j < m)
            for c in range(1, min(3, n - i) + 1):
                ways += [(i + c, j + a, score + confidence(chapters[i : i + c], tracks[j : j + a]) - 0.04 * (c + a - 2), "match") for a in range(1, min(3, m - j) + 1)]
            for x, y, new, kind in ways:
                if (x, y) not in best or new > best[x, y][0]:
                    best[x, y] = (new, [*rows, (kind, [*range(i, x)], [*range(j, y)])])
    return best[n, m][1]


def _book(rng: random.Random, n: int, words: int) -> tuple[list[dict], list[dict]]:
    def text() -> str:
        return " ".join(rng.choices(WORDS, k=words))

    chapters = [{"head": text(), "tail": text(), "chars": rng.randrange(5000)} for _ in range(n)]
    return chapters, [{"head": c["head"], "tail": c["tail"], "duration": c["chars"] / 15} for c in chapters]


@pytest.mark.parametrize("case", ["same", "lost", "cut", "others", "equal", "mixed"])
def test_same_as_whole_grid(case):
    for seed in range(6):
        rng = random.Random(f"{case} {seed}")
        c, t = _book(rng, rng.randrange(1, 22), rng.choice([1, 4, 45]))
        if case == "lost":
            c, t = [x for x in c if rng.random() < 0.7], [x for x in t if rng.random() < 0.7]
        elif case == "cut":
            t = [y for x in t for y in ([x | {"tail": "vexed"}, x | {"head": "fox"}] if rng.random() < 0.3 else [x])]
        elif case == "others":
            t = _book(rng, rng.randrange(22), 45)[1]
        elif case == "equal":
            c, t = [{"head": "a", "tail": "b", "chars": 1}] * len(c), [{"head": "a", "tail": "b", "duration": 1.0}] * rng.randrange(22)
        elif case == "mixed":
            rng.shuffle(t)
        t = [x | {k: "" for k in ("head", "tail") if rng.random() < 0.1} for x in t]
        assert [(r["kind"], r["chapters"], r["tracks"]) for r in kernels.reconcile(c, t)] == _whole_grid(c, t)


def test_long_book_compares_few_anchors(monkeypatch):
    compared = []
    ratio = difflib.SequenceMatcher.ratio
    monkeypatch.setattr(difflib.SequenceMatcher, "ratio", lambda self: compared.append(1) or ratio(self))
    rng = random.Random(7)
    c, t = _book(rng, 150, 20)
    t = [x | {"head": x["head"][:-2], "tail": x["tail"][2:]} for k, x in enumerate(t) if k != 70]
    rows = kernels.reconcile(c, t)
    assert [r["chapters"] for r in rows if r["kind"] != "match"] in ([[70]], []) and sum(len(r["tracks"]) for r in rows) == 149
    assert len(compared) < 20 * 150  # of 2 * 150 * 149
