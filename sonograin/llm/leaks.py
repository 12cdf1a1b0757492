"""Evaluation passages that leak into training documents (problem 9).

Q-gram lemma filter: a stretch of n characters with at most k edits keeps n + 1 - q * (k + 1) of its q-grams, all
near one diagonal.  Shared q-grams of document and passage are counted in overlapping diagonal bands; a pair whose two best bands are
under the bound of the edit budget is dropped; what is left is verified by a banded alignment of words.
The budget: of 20 words four may be changed, added or missing.  Passages are written with stock phrases, so q-grams and words are told
apart by how many passages hold them: a pair needs RARE_GRAMS rare q-grams, and if more than a few words are edited, rare word
triples.  The passages are the fixed query set; their index goes to every task in blocks of a bounded size, and every
document is compared with all blocks; what is rare is counted over all passages, so blocks change nothing.
"""

from __future__ import annotations

import difflib
import re
import uuid
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonograin.llm.canon import canonical
from sonograin.tables import spread

#: Characters of a q-gram and width of a band in characters.
Q, BAND = 16, 48
#: Rare q-grams that the two best bands of a pair hold at least under the edit budget (a share of 0.99 of stretches of 20 words with five
#: of them changed hold 10). Others propose nothing, so they are in no index.
RARE_GRAMS = 10
#: Passages (copies and near-copies counted once) up to which a q-gram or triple of words is rare, as a number and as a share of all;
#: share of its q-grams that makes a passage a near-copy of another.
RARE, RARE_SHARE, NEAR_COPY = 2, 0.005, 0.5
#: Words of the passage that a case holds, in one or two stretches; least words of a stretch; share of the words that must be
#: unchanged; cost of an edited word against a kept one.
WORDS, LEAST_STRETCH, UNCHANGED, EDIT = 20, 6, 0.75, 1.2
#: Share of unchanged words over which the aligned stretches are sure; else the unchanged words must hold so many rare triples (of 20 words with
#: four changed at least five triples are left).
SURE, RARE_TRIPLES = 0.85, 5
#: Half width of the alignment band, in words, and words around the shared q-grams that are aligned.
HALF, MARGIN = 6, 14
#: Most characters of passages in one index block: about 40 bytes of index each; bytes of the query set as a whole, which
#: the driver reads.
BLOCK_CHARS, QUERY_BYTES = 4 << 20, 64 << 20
#: Characters of a piece of a huge text, and of the overlap of two pieces (longer than any quotation's stretch by far).
PIECE, OVERLAP = 150_000, 4_000
#: A leading sentence of at least so many passages, and this share of them, is a stock instruction.
STOCK_ITEMS, STOCK_SHARE = 3, 0.01

_OTHER = re.compile(r"[\W_]+")
_SENTENCE = re.compile(r".*?[.!?](?=\s|$)", re.S)
_B = np.uint64(0x9E3779B97F4A7C15)


def plain(text: str | None) -> str:
    """Words of a text in lower case, one blank apart: case, punctuation, line breaks and look-alike writing set aside."""
    if not text:
        return ""
    t = canonical(text).casefold().replace("’", "").replace("'", "")
    return _OTHER.sub(" ", t).strip()


def stock_instructions(passages: list[str | None]) -> set[str]:
    """Leading sentences that many passages share."""
    count: dict[str, int] = {}
    for p in passages:
        m = _SENTENCE.match((p or "").strip())
        if m:
            count[plain(m.group())] = count.get(plain(m.group()), 0) + 1
    least = max(STOCK_ITEMS, STOCK_SHARE * len(passages))
    return {s for s, n in count.items() if n >= least}


def without_instruction(passage: str | None, stock: set[str]) -> str:
    p = (passage or "").strip()
    m = _SENTENCE.match(p)
    while m and plain(m.group()) in stock:
        p = p[m.end() :].strip()
        m = _SENTENCE.match(p)
    return plain(p)


def grams(codes: np.ndarray) -> np.ndarray:
    """Hash of the Q characters from each position, by doubling."""
    h, n, p = codes.astype(np.uint64) + np.uint64(1), 1, _B
    with np.errstate(over="ignore"):
        h = h * np.uint64(0xBF58476D1CE4E5B9) ^ (h >> np.uint64(7))
        while n < Q:
            if len(h) <= n:
                return h[:0]
            h = h[:-n] * p + h[n:]
            p = p * p
            n *= 2
    return h ^ (h >> np.uint64(31))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def _triples(words: list[str]) -> np.ndarray:
    """Hash of the three words from each position."""
    h = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        t = h[:-2] * np.uint64(3) + h[1:-1] * _B + h[2:] * np.uint64(0xBF58476D1CE4E5B9)
        return t ^ (t >> np.uint64(29))


def _held_by(keys: list[np.ndarray], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(different keys, number of groups that hold each)."""
    k = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    g = np.repeat(group, [len(x) for x in keys]) if keys else np.zeros(0, np.int64)
    order = np.lexsort((g, k))
    k, g = k[order], g[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    fresh = new.copy()
    fresh[1:] |= g[1:] != g[:-1]
    at = np.flatnonzero(new)
    return k[at], np.add.reduceat(fresh.astype(np.int64), at) if len(k) else np.zeros(0, np.int64)


def _near_copies(keys: list[np.ndarray]) -> np.ndarray:
    """Group of each passage: those that share NEAR_COPY of their q-grams with the first passage that holds these are one group."""
    n = len(keys)
    sizes = np.array([len(x) for x in keys], np.int64)
    k, item = (np.concatenate(keys), np.repeat(np.arange(n), sizes)) if n else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    order = np.lexsort((item, k))
    k, item = k[order], item[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    leader = item[np.flatnonzero(new)][np.cumsum(new) - 1] if len(k) else item
    link, shared = np.unique(item[item != leader] * max(n, 1) + leader[item != leader], return_counts=True)
    up = np.arange(n)

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for pair, c in zip(link.tolist(), shared.tolist(), strict=True):
        i, j = divmod(pair, n)
        if c >= NEAR_COPY * min(sizes[i], sizes[j]):
            up[root(i)] = root(j)
    return np.array([root(i) for i in range(n)], np.int64)


def common_keys(passages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the q-grams and of the triples of words that are not rare, over all passages."""
    keys = [np.unique(grams(_codes(t))) for t in passages]
    group = _near_copies(keys)
    most = max(RARE, RARE_SHARE * len(np.unique(group)))
    out = []
    for ks in (keys, [np.unique(_triples(t.split())) for t in passages]):
        k, n = _held_by(ks, group)
        out.append(k[n > most])
    return out[0], out[1]


class Index:
    """Rare q-grams of a block of passages: sorted hashes, postings, and a bit per hash prefix to rule most out; the passages' words."""

    def __init__(self, items: list[tuple[int, str]], common: tuple[np.ndarray, np.ndarray] | None = None) -> None:
        self.ids = np.array([i for i, _ in items], np.int64)
        texts = [t for _, t in items]
        common_grams, common_triples = common or common_keys(texts)
        self.vocabulary: dict[str, int] = {}
        words = [t.split() for t in texts]
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.first_word = np.append(0, np.cumsum(self.sizes))
        self.numbers = np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for ws in words for w in ws], np.int32)
        self.rare_triple = np.zeros(len(self.numbers) + 2, bool)
        for at, ws in zip(self.first_word.tolist(), words, strict=False):
            if len(ws) > 2:
                self.rare_triple[at : at + len(ws) - 2] = ~np.isin(_triples(ws), common_triples)
        codes = [_codes(t) for t in texts]
        hs = [grams(c) for c in codes]
        h = np.concatenate(hs) if hs else np.zeros(0, np.uint64)
        sizes = np.array([len(x) for x in hs], np.int64)
        item = np.repeat(np.arange(len(hs)), sizes)
        pos = np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        rare = np.flatnonzero(~np.isin(h, common_grams))
        order = rare[np.argsort(h[rare], kind="stable")]
        self.item, self.pos = item[order], pos[order]
        self.keys, self.first = np.unique(h[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(order)))
        self.bits = np.zeros(1 << 24, bool)
        self.bits[(self.keys >> np.uint64(40)).astype(np.int64)] = True
        #: word of the passage that a q-gram begins in (behind the blank it may begin with)
        self.word_at = np.concatenate([np.cumsum(c == 32)[: len(x)] for c, x in zip(codes, hs, strict=True)])[order] if len(h) else np.zeros(0, np.int64)

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in the text, posting) of every shared q-gram."""
        h = grams(codes)
        at = np.flatnonzero(self.bits[(h >> np.uint64(40)).astype(np.int64)]) if len(h) else np.zeros(0, np.int64)
        if not len(at) or not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        k = np.searchsorted(self.keys, h[at])
        k[k == len(self.keys)] = 0
        ok = self.keys[k] == h[at]
        at, k = at[ok], k[ok]
        n = self.count[k]
        rep = np.repeat(np.arange(len(at)), n)
        offs = np.arange(len(rep)) - np.repeat(np.cumsum(n) - n, n)
        return at[rep], self.first[k][rep] + offs


def align(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Best local alignment of each row of word numbers a with the row of b, near the diagonal: word i of a meets
    words i .. i + 2 * HALF of b.  A match counts 1, a changed, added or missing word costs EDIT.  Returns matches,
    a from, a to, b from, b to; all rows at once.  Matches and both starts travel as one number per cell."""
    n, rows = a.shape
    width = 2 * HALF + 1
    cost = np.float32(EDIT)
    col = np.arange(width, dtype=np.int64)
    slope = (cost * col).astype(np.float32)
    one = np.int64(1) << 40
    s, code = np.zeros((n, width + 1), np.float32), np.zeros((n, width + 1), np.int64)
    best = np.zeros(n, np.float32)
    kept, end_a, end_b = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    k = np.arange(n)
    for i in range(rows):
        same = a[:, i, None] == b[:, i : i + width]
        fresh = same & (s[:, :width] <= 0)
        c = s[:, :width] + np.where(same, np.float32(1), -cost)
        x = np.where(fresh, one + (i << 20) + col + i, code[:, :width] + same * one)
        up = s[:, 1:] - cost
        better = up > c
        c, x = np.where(better, up, c), np.where(better, code[:, 1:], x)
        t = np.maximum(c, 0) + slope  # an added word of b: the best cell to the left
        top = np.maximum.accumulate(t, axis=1)
        if (top > t).any():
            src = np.maximum.accumulate(np.where(t >= top, col, 0), axis=1)
            x = np.take_along_axis(x, src, 1)
        c = np.maximum(top - slope, 0)
        s[:, :width], code[:, :width] = c, x
        d = c.argmax(axis=1)
        now = c[k, d]
        new = now > best
        if new.any():
            best[new] = now[new]
            kept[new], end_a[new], end_b[new] = x[k, d][new], i + 1, d[new] + i + 1
    low = (1 << 20) - 1
    return kept >> 40, (kept >> 20) & low, end_a, kept & low, end_b


#: Columns of a band: document, item, set of bands, diagonal band, q-grams, and the first and last word of its q-grams in the text and
#: in the passage.
_DOC, _ITEM, _SET, _KEY, _GRAMS, _T0, _T1, _P0, _P1 = range(9)


def _bands(index: Index, parts: list[tuple[int, int, int, bool, str]]) -> np.ndarray:
    """Shared q-grams of texts (document, characters and words before it, whether it is a whole document, text) counted in overlapping
    diagonal bands, a row a band; of whole documents only where a pair has enough of them at all."""
    n_items = len(index.ids)
    codes = _codes("\n\n".join(p[-1] for p in parts))
    ends = np.cumsum([len(p[-1]) + 2 for p in parts])
    at, posting = index.hits(codes)
    part = np.searchsorted(ends, at, "right")
    pair = part * n_items + index.item[posting]
    shared, where = np.unique(pair, return_inverse=True)
    least = np.array([RARE_GRAMS if p[3] else 1 for p in parts])
    some = np.flatnonzero((np.bincount(where, minlength=len(shared)) >= least[shared // max(n_items, 1)])[where])
    if not len(some):
        return np.zeros((0, 9), np.int64)
    at, posting, part, pair = at[some], posting[some], part[some], pair[some]
    doc, chars, words = (np.array([p[i] for p in parts], np.int64)[part] for i in (0, 1, 2))
    begin = np.append(0, ends[:-1])[part]
    blanks = np.append(0, np.cumsum(codes == 32))
    t_word = blanks[at + 1] - blanks[begin] + words
    pos, p_word = index.pos[posting], index.word_at[posting]
    diag = at - begin + chars - pos + (1 << 40)
    out = []
    for half in (0, 1):
        band = (diag + half * (BAND // 2)) // BAND
        order = np.lexsort((band, pair))
        k, d = pair[order], band[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
        first = np.flatnonzero(new)
        tw, pw = t_word[order], p_word[order]
        low, high = np.minimum.reduceat, np.maximum.reduceat
        cols = [doc[order][first], k[first] % n_items, np.full(len(first), half), d[first], np.diff(np.append(first, len(k))), low(tw, first), high(tw, first), low(pw, first), high(pw, first)]
        out.append(np.stack(cols, axis=1))
    return np.concatenate(out)


def _starts(rows: np.ndarray, last: int) -> np.ndarray:
    """Where sorted rows begin to differ from the row before in the columns up to `last`."""
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, : last + 1] != rows[:-1, : last + 1]).any(axis=1)
    return np.flatnonzero(new)


def _candidates(bands: np.ndarray) -> np.ndarray:
    """Bands of the pairs whose two best bands of one set hold what the edit budget leaves.

    A band that two pieces of a text both hold, in their overlap, counts once."""
    if not len(bands):
        return bands
    b = bands[np.lexsort(bands[:, [_KEY, _SET, _ITEM, _DOC]].T)]
    at = _starts(b, _KEY)
    b = np.stack([b[at, c] if c <= _KEY else (np.minimum if c in (_T0, _P0) else np.maximum).reduceat(b[:, c], at) for c in range(9)], axis=1)
    b = b[np.lexsort((-b[:, _GRAMS], b[:, _SET], b[:, _ITEM], b[:, _DOC]))]
    at = _starts(b, _SET)
    group = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(b))))
    best = np.arange(len(b)) - at[group] < 2
    held = np.add.reduceat(b[:, _GRAMS] * best, at)
    # of the two sets of bands, which overlap, a pair is taken from the one that holds more
    head = b[at]
    order = np.lexsort((head[:, _SET], -held, head[:, _ITEM], head[:, _DOC]))
    use = np.zeros(len(at), bool)
    use[order[_starts(head[order], _ITEM)]] = True
    return b[(use & (held >= RARE_GRAMS))[group]]


#: Matches, passage from, to, text from, to in words.
Stretch = tuple[int, int, int, int, int]


def stretches_of(index: Index, bands: np.ndarray, words: dict[int, np.ndarray]) -> dict[tuple[int, int], list[Stretch]]:
    """Verified stretches of each (document, item): the bands aligned word by word, those of like length side by side."""
    found: dict[tuple[int, int], list[Stretch]] = {}
    docs = np.unique(bands[:, _DOC])
    sizes = np.array([len(words[d]) for d in docs.tolist()], np.int64)
    starts = np.append(0, np.cumsum(sizes))[:-1]
    every = np.concatenate([words[d] for d in docs.tolist()]) if len(docs) else np.zeros(0, np.int32)
    which = np.searchsorted(docs, bands[:, _DOC])
    item = bands[:, _ITEM]
    lo, hi = np.maximum(0, bands[:, _P0] - MARGIN), np.minimum(index.sizes[item], bands[:, _P1] + MARGIN + 4)
    shift = (bands[:, _T0] - bands[:, _P0] + bands[:, _T1] - bands[:, _P1]) // 2
    order = np.argsort(hi - lo, kind="stable")
    for at in range(0, len(order), 512):
        x = order[at : at + 512]
        rows = int((hi[x] - lo[x]).max())
        i = lo[x, None] + np.arange(rows)
        a = np.where(i < hi[x, None], index.numbers[np.minimum(index.first_word[item[x], None] + i, len(index.numbers) - 1)], -1)
        j = (lo[x] + shift[x] - HALF)[:, None] + np.arange(rows + 2 * HALF)
        inside = (j >= 0) & (j < sizes[which[x], None])
        b = np.where(inside, every[np.clip(starts[which[x], None] + j, 0, len(every) - 1)], -3)
        left = np.arange(len(x))
        for _ in range(2):  # the best stretch, and where that is too short the best beside it
            m, a0, a1, b0, b1 = align(a[left], b[left])
            good = (a1 - a0 >= LEAST_STRETCH) & (m >= UNCHANGED * (a1 - a0))
            for g in np.flatnonzero(good).tolist():
                r = int(left[g])
                k = x[r]
                f, t = int(lo[k]), int(j[r, 0])
                found.setdefault((int(bands[k, _DOC]), int(item[k])), []).append((int(m[g]), int(a0[g]) + f, int(a1[g]) + f, int(b0[g]) + t, int(b1[g]) + t))
                a[r, a0[g] : a1[g]] = -1
                b[r, b0[g] : b1[g]] = -3
            left = left[good & (a1 - a0 < WORDS)]
            if not len(left):
                break
    return found


def pieces(text: str) -> list[tuple[int, int, str]]:
    """A text in pieces of at most PIECE characters that overlap by OVERLAP, cut at blanks: (characters and words before it, piece)."""
    out, at, before = [], 0, 0
    while True:
        end = at + PIECE
        if end < len(text):
            cut = text.rfind(" ", at + PIECE // 2, end)
            end = cut if cut > 0 else end
        out.append((at, before, text[at : min(end, len(text))]))
        if end >= len(text):
            return out
        nxt = text.rfind(" ", at + 1, end - OVERLAP) + 1
        nxt = nxt if nxt > at else end
        before += text.count(" ", at, nxt)
        at = nxt


def leaks_of(index: Index, texts: list[str]) -> Iterator[tuple[int, int, int]]:
    """(number of the text, item, words held) of every pair with a verified stretch.

    Huge texts go in pieces and many small ones together, so that the memory for shared q-grams is bounded; the bound of the budget
    is put to the bands of all pieces of a text."""
    bands: list[np.ndarray] = []
    queue: list[tuple[int, int, int, bool, str]] = []
    size = 0
    for d, t in enumerate(texts):
        parts = pieces(t)
        for chars, before, part in parts:
            queue.append((d, chars, before, len(parts) == 1, part))
            size += len(part)
            if size >= 2 * PIECE:
                bands.append(_bands(index, queue))
                queue, size = [], 0
    if queue:
        bands.append(_bands(index, queue))
    chosen = _candidates(np.concatenate(bands) if bands else np.zeros((0, 9), np.int64))
    if not len(chosen):
        return
    words = {d: np.array([index.vocabulary.get(w, -2) for w in texts[d].split(" ")], np.int32) for d in np.unique(chosen[:, _DOC]).tolist()}
    for (d, item), ws in sorted(stretches_of(index, chosen, words).items()):
        yield d, item, held_words(index, item, words[d], ws)


def _rare_triples(index: Index, item: int, words: np.ndarray, s: Stretch) -> int:
    """Rare triples of the passage's words that a stretch keeps."""
    at = int(index.first_word[item]) + s[1]
    kept = difflib.SequenceMatcher(None, index.numbers[at : at + s[2] - s[1]].tolist(), words[s[3] : s[4]].tolist(), autojunk=False).get_matching_blocks()
    return sum(int(index.rare_triple[at + b.a : at + b.a + b.size - 2].sum()) for b in kept if b.size > 2)


def _extended(passage: np.ndarray, words: np.ndarray, s: Stretch) -> Stretch:
    """A stretch lengthened over edited words at its ends, which the best local alignment leaves out, to the next unchanged one, as
    often as enough of its words stay unchanged."""
    m, a0, a1, b0, b1 = s

    def step(at: int, to: int, side: int) -> tuple[int, int] | None:
        """How far, in the passage and in the text, the next unchanged word is: words between changed, or one missing in the text."""
        for n in range(1, int((m + 1) / UNCHANGED) - (a1 - a0) + 1):
            for d in range(n, max(1, n - 1) - 1, -1):
                i, j = at + side * n - (side > 0), to + side * d - (side > 0)
                if 0 <= i < len(passage) and 0 <= j < len(words) and passage[i] == words[j]:
                    return n, d
        return None

    while x := step(a0, b0, -1):
        m, a0, b0 = m + 1, a0 - x[0], b0 - x[1]
    while x := step(a1, b1, 1):
        m, a1, b1 = m + 1, a1 + x[0], b1 + x[1]
    return m, a0, a1, b0, b1


def held_words(index: Index, item: int, words: np.ndarray, stretches: list[Stretch]) -> int:
    """Words of the passage held in their order in at most two of the stretches; a changed word inside a
    stretch counts as held, so few edits do not undo a case.  With more edits than SURE allows, RARE_TRIPLES must be left:
    sentences that only share their frame of common phrases are no case."""
    # of one stretch of the passage its first and its last place in the text are enough
    first, last = {}, {}
    for s in stretches:
        k = s[:3]
        first[k] = min(first.get(k, s), s, key=lambda x: x[4])
        last[k] = max(last.get(k, s), s, key=lambda x: x[3])
    passage = index.numbers[index.first_word[item] : index.first_word[item + 1]]
    long = {s: _extended(passage, words, s) for s in {*first.values(), *last.values()}}
    options = []  # (held, kept, stretches, as aligned)
    for s in first.values():
        for x in {s, long[s]}:
            options.append((x[2] - x[1], x[0], (x,), x is s))
    for k, v in combinations(sorted(first, key=lambda x: x[1]), 2):
        if k[2] <= v[1] and first[k][4] <= last[v][3]:
            for x, y in {(first[k], last[v]), (long[first[k]], long[last[v]])}:
                both = max(0, x[2] - y[1])  # lengthened into each other
                options.append((x[2] - x[1] + y[2] - y[1] - both, x[0] + y[0] - both, (x, y), x is first[k] and y is last[v]))
    best = 0
    for held, kept, parts, plainly in sorted(options, key=lambda o: -o[0]):
        if held <= best:
            break
        if (plainly and kept > SURE * held) or (kept >= UNCHANGED * held and sum(_rare_triples(index, item, words, s) for s in parts) >= RARE_TRIPLES):
            best = held
    return best


_LOADED: dict[str, Index] = {}


def _index(key: str, held) -> Index:
    """The index of a broadcast block, made once in a worker; the last one is kept."""
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Index(*held.value)
    return _LOADED[key]


def find_leaks(docs: DataFrame, doc: str, text: str, items: DataFrame, item: str, passage: str, least: int = WORDS, batch: int = 256) -> DataFrame:
    """(doc, item, words_held): one row per document and passage of which it holds at least `least` words.

    Null and empty texts and passages of fewer than WORDS words give none. Repeated documents each count; keys
    must be unique. `items` is the query set: it is measured and read to the driver (up to QUERY_BYTES, else
    ValueError: give it in parts) and sent to the tasks in blocks of BLOCK_CHARS characters."""
    query = items.select(F.col(item).cast("bigint"), passage).where(F.col(item).isNotNull())
    if (query.agg(F.sum(F.octet_length(passage))).first()[0] or 0) > QUERY_BYTES:
        raise ValueError("the query set is larger than one search takes")
    rows = [(r[0], r[1]) for r in query.collect()]
    stock = stock_instructions([p for _, p in rows])
    plain_items = [(i, without_instruction(p, stock)) for i, p in sorted(rows, key=lambda r: (r[0], r[1] or ""))]
    common = common_keys([t for _, t in plain_items])
    blocks: list[list[tuple[int, str]]] = [[]]
    size = 0
    for i, t in plain_items:
        if size and size + len(t) > BLOCK_CHARS:
            blocks.append([])
            size = 0
        blocks[-1].append((i, t))
        size += len(t)
    kind = dict(docs.dtypes)[doc]
    src = docs.select(F.col(doc).alias("__d"), F.col(text).alias("__t")).where("__t IS NOT NULL AND __t <> ''")
    # the work per byte is high: even, small tasks, more of them as the table grows
    src = spread(src, "__d")
    found = None
    for block in blocks:
        held, name = docs.sparkSession.sparkContext.broadcast((block, common)), uuid.uuid4().hex

        def run(batches, held=held, name=name):
            index = _index(name, held)
            for b in batches:
                for at in range(0, b.num_rows, batch):
                    part = b.slice(at, batch)
                    keys = part.column(0)
                    out = [(d, int(index.ids[k]), n) for d, k, n in leaks_of(index, [plain(t) for t in part.column(1).to_pylist()]) if n >= least]
                    yield pa.RecordBatch.from_arrays([keys.take(pa.array([o[0] for o in out], pa.int64())), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int32())], names=["d", "i", "n"])

        one = src.mapInArrow(run, f"d {kind}, i bigint, n int")
        found = one if found is None else found.unionByName(one)
    return found.select(F.col("d").alias(doc), F.col("i").alias(item), F.col("n").alias("words_held"))
