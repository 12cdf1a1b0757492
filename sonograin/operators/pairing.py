"""

The pairing is the best path through the grid of (chapters used, tracks used). Comparing two anchors costs far more than a step of the grid, so
likenesses start as upper bounds (characters in common) and are computed only where a path could still be the best one:

* a corridor around the diagonal gives a path; its true score rules out every cell that no path of that score can reach even if all likenesses were 1;
* the corridor grows until it holds every cell that is left;
* in it, cells whose best path by the bounds scores less than the path found drop out, the others are compared, until none is left to compare.

What is left holds every best path, so the plain recurrence over it gives the same rows, equal scores included, as over the whole grid.
Held in memory: the corridor (some 18 bytes a cell) and a book's anchors."""

from __future__ import annotations

import difflib
from collections import Counter

import numpy as np

#: First half width of the corridor; what bounds have above the value they bound, for rounding; what a score may lack by floating point.
WIDTH, ROUNDING, SLACK = 16, 1e-6, 1e-6
#: Frequent characters counted one by one in the bounds; the others share as many counts.
LETTERS = 48


def _cut(row: np.ndarray, at: int, lo: int, hi: int) -> np.ndarray:
    """row, whose first place is `at`, over [lo, hi); -inf where it has no places."""
    if at == lo and len(row) == hi - lo:
        return row
    out = np.full(hi - lo, -np.inf)
    a, b = max(lo, at), min(hi, at + len(row))
    if a < b:
        out[a - lo : b - lo] = row[a - at : b - at]
    return out


class _Likeness:
    """Likeness of two lists of texts: bounds a row at a time, values where asked for."""

    def __init__(self, a: list[str], b: list[str]) -> None:
        self.a, self.b, self.known = a, b, {}
        rank = {ch: k for k, (ch, _) in enumerate(Counter("".join(a) + "".join(b)).most_common())}
        kind = np.min_scalar_type(max(map(len, [*a, *b, ""])))
        self.ca, self.cb = (self._counts(x, rank, kind) for x in (a, b))
        self.la, self.lb = (np.array([len(t) for t in x], dtype=np.float64) for x in (a, b))
        self.total = np.uint32 if kind.itemsize > 2 else np.uint16

    @staticmethod
    def _counts(texts: list[str], rank: dict[str, int], kind: np.dtype) -> np.ndarray:
        """(character, text): how often; rare characters share places, which can only raise what two texts have in common."""
        out = np.zeros((min(2 * LETTERS, len(rank)), len(texts)), dtype=kind)
        for i, t in enumerate(texts):
            for ch, k in Counter(t).items():
                out[r if (r := rank[ch]) < LETTERS else LETTERS + r % LETTERS if len(rank) > 2 * LETTERS else r, i] += k
        return out

    def bounds(self, i: int, lo: int, hi: int) -> np.ndarray:
        """Of text i and texts lo to hi of the other list; 0 if the other is empty."""
        common = np.minimum(self.cb[:, lo:hi], self.ca[:, i : i + 1]).sum(axis=0, dtype=self.total)
        return np.where(self.lb[lo:hi] > 0, 2.0 * common / np.maximum(self.la[i] + self.lb[lo:hi], 1), 0).astype(np.float32)

    def value(self, i: int, j: int) -> float:
        pair = self.a[i], self.b[j]
        if pair not in self.known:
            self.compare([(i, j)])
        return self.known[pair]

    def compare(self, cells: list[tuple[int, int]]) -> None:
        """Values of the cells; a text of the second list is taken apart once."""
        matcher, last = difflib.SequenceMatcher(), None
        for i, j in sorted(cells, key=lambda c: c[1]):
            pair = a, b = self.a[i], self.b[j]
            if pair in self.known:
                continue
            if not b:
                self.known[pair] = 0.0
            elif a == b:
                self.known[pair] = 1.0
            else:
                if last != j:
                    matcher.set_seq2(b)
                    last = j
                matcher.set_seq1(a)
                self.known[pair] = matcher.ratio()


class Pairing:
    """chapters: head, tail, chars; tracks: head, tail, duration. See kernels.reconcile."""

    def __init__(self, chapters: list[dict], tracks: list[dict], most: int, skip: float, grouping: float) -> None:
        self.n, self.m, self.most, self.skip, self.grouping = len(chapters), len(tracks), most, skip, grouping
        self.like = [_Likeness([c[k] or "" for c in chapters], [t[k] or "" for t in tracks]) for k in ("head", "tail")]
        self.chars, self.time = [max(1, c["chars"]) for c in chapters], [max(0.01, t["duration"]) for t in tracks]
        self.all_chars, self.all_time = max(1, sum(self.chars)), max(0.01, sum(self.time))
        self.has = [np.array([bool(t[k]) for t in tracks] + [False] * (most + 1)) for k in ("head", "tail")]
        self.whole = bool(all(h[: self.m].all() for h in self.has))
        sums = np.concatenate([[0.0], np.cumsum(self.time)])
        self.lengths = {a: np.concatenate([np.maximum(sums[a:] - sums[:-a], 1e-9), np.ones(most + 1 + min(a, self.m + 1))])[: self.m + 1 + most] / self.all_time for a in range(1, most + 1)}
        self.groups = [(c, a) for c in range(1, most + 1) for a in range(1, most + 1)]
        self.compared: set[tuple[int, int, int]] = set()  # 0 head or 1 tail, chapter, track
        self.least = -np.inf  # true score of the best path so far
        #: What a step at least loses for each chapter or track by which it is uneven, against 1 for each pair.
        uneven = [(min(c, a) - 0.9 - 0.1 * min(c, a) / max(c, a) + grouping * (c + a - 2)) / abs(c - a) for c, a in self.groups if c != a]
        self.loss = max(0.0, min([skip, *uneven]))

    def confidence(self, i: int, j: int, c: int, a: int) -> float:
        """Of the match of c chapters from i and a tracks from j."""
        head, tail = self.has[0][j], self.has[1][j + a - 1]
        h = self.like[0].value(i, j) if head else 0.0
        t = self.like[1].value(i + c - 1, j + a - 1) if tail else 0.0
        anchors = (h + t) / 2 if head and tail else max(h, t)
        share, length = sum(self.chars[i : i + c]) / self.all_chars, sum(self.time[j : j + a]) / self.all_time
        return round(0.75 * anchors + 0.15 * min(share, length) / max(share, length) + 0.10 * (min(c, a) / max(c, a)), 6)

    def steps(self, i: int, j: int):
        """Ways on from a cell in the order in which they are tried: (to, kind, chapters, tracks)."""
        if i < self.n:
            yield (i + 1, j), "skip_chapter", 1, 0
        if j < self.m:
            yield (i, j + 1), "skip_audio", 0, 1
        for c in range(1, min(self.most, self.n - i) + 1):
            for a in range(1, min(self.most, self.m - j) + 1):
                yield (i + c, j + a), "match", c, a

    def most_through(self, i: int, j: int) -> float:
        """What a path through a cell can score if all likenesses are 1."""
        n, m = self.n, self.m
        return min(i, j) + min(n - i, m - j) - self.loss * (abs(i - j) + abs(n - i - m + j))

    def reach(self) -> tuple[list[int], list[int]]:
        """First and last place, by row, of the cells through which a path can score what the best one so far does: a convex set."""
        lo, hi = [], []
        for i in range(self.n + 1):
            ends = []
            top = max((min(self.m, max(0, j)) for j in (i, i + self.m - self.n)), key=lambda j: self.most_through(i, j))
            for far in (0, self.m):
                near, out = top, far
                if self.most_through(i, far) >= self.least - SLACK:
                    near = far
                while abs(out - near) > 1:
                    mid = (near + out) // 2
                    near, out = (mid, out) if self.most_through(i, mid) >= self.least - SLACK else (near, mid)
                ends.append(near)
            lo.append(ends[0])
            hi.append(ends[1])
        return lo, hi

    def open(self, lo: list[int], hi: list[int]) -> None:
        """A corridor: places lo to hi (without hi) of each row, with bounds of the likenesses and the values known so far."""
        self.lo, self.hi = lo, hi
        self.bound = [[], []]
        self.done = [[], []]
        for kind, like in enumerate(self.like):
            for i in range(self.n):
                row = np.zeros(hi[i] - lo[i], dtype=np.float32)
                end = min(hi[i], self.m)
                row[: end - lo[i]] = like.bounds(i, lo[i], end)
                self.bound[kind].append(row)
                self.done[kind].append(np.zeros(hi[i] - lo[i], dtype=bool))
                self.done[kind][i][: end - lo[i]] = like.lb[lo[i] : end] == 0
        self.enter(self.compared)

    def enter(self, cells) -> None:
        for kind, i, j in cells:
            if self.lo[i] <= j < self.hi[i]:
                self.bound[kind][i][j - self.lo[i]] = self.like[kind].value(i, j)
                self.done[kind][i][j - self.lo[i]] = True

    def compare(self, cells: list[tuple[int, int, int]]) -> None:
        for kind in (0, 1):
            self.like[kind].compare([(i, j) for k, i, j in cells if k == kind])
        self.compared.update(cells)
        self.enter(cells)

    def gains(self, i: int, c: int, a: int) -> np.ndarray:
        """Bounds of what matching c chapters from i and a tracks adds, by the first track."""
        lo, hi = self.lo[i], self.hi[i]
        h, t = self.bound[0][i], _cut(self.bound[1][i + c - 1], self.lo[i + c - 1], lo + a - 1, hi + a - 1)
        if self.whole:
            anchors = (h + t) / 2
        else:
            anchors = np.where(self.has[0][lo:hi] & self.has[1][lo + a - 1 : hi + a - 1], (h + t) / 2, np.maximum(h, t))
        share, length = sum(self.chars[i : i + c]) / self.all_chars, self.lengths[a][lo:hi]
        return 0.75 * anchors + 0.15 * (np.minimum(share, length) / np.maximum(share, length)) + (0.10 * (min(c, a) / max(c, a)) - self.grouping * (c + a - 2) + ROUNDING)

    def backward(self) -> None:
        """What is at most still to come, by cell."""
        n, m, lo, hi = self.n, self.m, self.lo, self.hi
        self.rest: list[np.ndarray] = [np.empty(0)] * (n + 1)
        for i in range(n, -1, -1):
            v = np.full(hi[i] - lo[i], -np.inf)
            if i == n:
                v[m - lo[i]] = 0.0
            else:
                v = np.maximum(v, _cut(self.rest[i + 1], lo[i + 1], lo[i], hi[i]) - self.skip)
            for c, a in self.groups:
                if i + c <= n:
                    v = np.maximum(v, self.gains(i, c, a) + _cut(self.rest[i + c], lo[i + c], lo[i] + a, hi[i] + a))
            slope = self.skip * np.arange(lo[i], hi[i])
            self.rest[i] = np.maximum.accumulate((v - slope)[::-1])[::-1] + slope

    def forward(self):
        """Row by row (i, what cells have at most, by group what a path through the step has at most)."""
        n, lo, hi = self.n, self.lo, self.hi
        ahead = {0: np.full(hi[0] - lo[0], -np.inf)}
        ahead[0][0 - lo[0]] = 0.0
        for i in range(n + 1):
            slope = self.skip * np.arange(lo[i], hi[i])
            v = np.maximum.accumulate(ahead.pop(i) + slope) - slope
            through = {}
            for c in range(1, min(self.most, n - i) + 1):
                to = ahead.setdefault(i + c, np.full(hi[i + c] - lo[i + c], -np.inf))
                if c == 1:
                    np.maximum(to, _cut(v, lo[i], lo[i + 1], hi[i + 1]) - self.skip, out=to)
                for a in range(1, self.most + 1):
                    x = v + self.gains(i, c, a)
                    through[c, a] = x + _cut(self.rest[i + c], lo[i + c], lo[i] + a, hi[i] + a)
                    np.maximum(to, _cut(x, lo[i] + a, lo[i + c], hi[i + c]), out=to)
            yield i, v, through

    def try_path(self) -> bool:
        """Compares along the path that is best by the bounds and keeps its true score; whether anything was left to compare there."""
        i = j = 0
        steps = []
        place = lambda r, k, none: r[k] if 0 <= k < len(r) else none
        while (i, j) != (self.n, self.m):
            best, way = -np.inf, None
            for (x, y), kind, c, a in self.steps(i, j):
                if not self.lo[x] <= y < self.hi[x]:
                    continue
                rest = self.rest[x][y - self.lo[x]]
                if kind != "match":
                    total = rest - self.skip
                else:
                    t = place(self.bound[1][x - 1], y - 1 - self.lo[x - 1], None)
                    if t is None:
                        continue
                    h = self.bound[0][i][j - self.lo[i]]
                    anchors = (h + t) / 2 if self.has[0][j] and self.has[1][y - 1] else max(h, t)
                    share, length = sum(self.chars[i:x]) / self.all_chars, self.lengths[a][j]
                    total = rest + 0.75 * anchors + 0.15 * (min(share, length) / max(share, length)) + 0.10 * (min(c, a) / max(c, a)) - self.grouping * (c + a - 2)
                if way is None or total > best:
                    best, way = total, (i, j, c, a, x, y)
            steps.append(way)
            i, j = way[4:]
        matches = [s for s in steps if s[2] and s[3]]
        cells = [(0, i, j) for i, j, *_ in matches] + [(1, x - 1, y - 1) for *_, x, y in matches]
        cells = [(k, i, j) for k, i, j in cells if not self.done[k][i][j - self.lo[i]]]
        self.compare(cells)
        score = 0.0
        for i, j, c, a, *_ in steps:
            score = score + self.confidence(i, j, c, a) - self.grouping * (c + a - 2) if c and a else score - self.skip
        self.least = max(self.least, score)
        return bool(cells)

    def left(self) -> list[tuple[float, int, int, int]]:
        """(most of a path, kind, chapter, track) of what is not compared and on a path that may be the best."""
        out = []
        tails: dict[int, np.ndarray] = {}

        def open_cells(kind: int, i: int, most: np.ndarray) -> None:
            for k in np.flatnonzero((most >= self.least - SLACK) & ~self.done[kind][i]):
                out.append((float(most[k]), kind, i, int(k) + self.lo[i]))

        for i, _, through in self.forward():
            if through:
                open_cells(0, i, np.maximum.reduce([*through.values()]))
            for (c, a), x in through.items():
                r = i + c - 1
                t = tails.setdefault(r, np.full(self.hi[r] - self.lo[r], -np.inf))
                np.maximum(t, _cut(x, self.lo[i] + a - 1, self.lo[r], self.hi[r]), out=t)
            if i in tails:
                open_cells(1, i, tails.pop(i))
        return out

    def narrow(self) -> list[list[int]]:
        """Opens corridors until one holds all best paths with everything on them compared; its cells on paths that may be the best, by row."""
        n, m, most = self.n, self.m, self.most
        lo, hi, width = [0] * (n + 1), [m] * (n + 1), WIDTH
        while True:
            line = [i * m // n if n else 0 for i in range(n + 1)]
            near = [max(0, a - most, x - width) for a, x in zip(lo, line, strict=True)], [min(m, b + most, (m if i == n or not n else (i + 1) * m // n) + width) + 1 for i, b in enumerate(hi)]
            self.open(*near)
            for _ in range(12):
                self.backward()
                before = self.least
                if not self.try_path() or self.least <= before:
                    break
            if min(self.skip, self.grouping) >= 0:
                lo, hi = self.reach()
            if all(x <= max(0, a - most) and y > min(m, b + most) for x, y, a, b in zip(*near, lo, hi, strict=True)):
                break
            width *= 4
        self.open([max(0, a - most) for a in lo], [min(m, b + most) + 1 for b in hi])
        while True:
            self.backward()
            self.try_path()
            if not (rows := self.left()):
                break
            rows.sort(reverse=True)
            self.compare([r[1:] for r in rows[: max(2 * (n + m), len(rows) // 8)]])
        return [(np.flatnonzero(v + self.rest[i] >= self.least - SLACK) + self.lo[i]).tolist() for i, v, _ in self.forward()]

    def rows(self) -> list[dict]:
        """The best pairing; of equal scores the way found first."""
        cells = self.narrow()
        kept = [set(r) for r in cells]
        best: dict[tuple[int, int], tuple] = {(0, 0): (0.0, None, None)}  # score, from, row
        for i, places in enumerate(cells):
            for j in places:
                if (i, j) not in best:
                    continue
                score = best[i, j][0]
                for to, kind, c, a in self.steps(i, j):
                    if to[1] not in kept[to[0]]:
                        continue
                    k = self.confidence(i, j, c, a) if kind == "match" else 1.0
                    new = score + k - self.grouping * (c + a - 2) if kind == "match" else score - self.skip
                    if to not in best or new > best[to][0]:
                        best[to] = (new, (i, j), {"kind": kind, "chapters": [*range(i, i + c)], "tracks": [*range(j, j + a)], "confidence": k})
        out, at = [], (self.n, self.m)
        while at != (0, 0):
            _, came, row = best[at]
            out.append(row)
            at = came
        return out[::-1]
