"""Token ids of whole texts by a public byte-level BPE vocabulary (problem 8).

Texts are cut into pretokens by the vocabulary's pattern; different pretokens are merged together, once,
as rows of padded numpy matrices, bucketed by length.  Each round every row looks its pairs up in
a hash table, finds the leftmost pair of least rank, merges it and closes the gap; rows without a
mergeable pair leave the matrix.  A pretoken is first cut wherever no vocabulary entry holds the two bytes
side by side: no merge can cross such a place, so rows stay short in every script.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows wider than this merge all occurrences of their least pair in a round (the same result: a pair that
#: holds a new token has a higher rank than the one that made it).
WIDE = 48
#: Characters from which a text is encoded by itself, some pretokens at a time.
LONG = 1 << 20
#: Most pretokens remembered between batches of a worker.
REMEMBERED = 400_000
#: Least rows of a matrix bucket that are worth a matrix of their own width.
_WIDTHS = (2, 3, 4, 5, 6, 8, 10, 12, 16, 20, 24, 32, 48, 64, 96, 128, 192, 256)


def default_files() -> tuple[str, str]:
    """Path of the vocabulary byte_bpe_50k and its pattern, as the installed tokenizers name them."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


class Bpe:
    """A vocabulary of byte strings with ranks, read from a file of base64 and rank per line."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.pattern = regex.compile(pattern)
        self.byte = np.full(256, -1, np.int64)
        adjacent = np.zeros((256, 256), bool)
        for tok, rank in self.ranks.items():
            if len(tok) == 1:
                self.byte[tok[0]] = rank
            b = np.frombuffer(tok, np.uint8)
            adjacent[b[:-1], b[1:]] = True
        self.adjacent = adjacent
        self.base = max(self.ranks.values()) + 2
        self._table()
        self.known: dict[str, list[int]] = {}

    def _table(self) -> None:
        """Open-addressing hash table of every pair of tokens whose bytes together are a token."""
        keys, vals = [], []
        for tok, rank in self.ranks.items():
            for i in range(1, len(tok)):
                a, b = self.ranks.get(tok[:i]), self.ranks.get(tok[i:])
                if a is not None and b is not None:
                    keys.append(a * self.base + b)
                    vals.append(rank)
        key, val = np.asarray(keys, np.int64), np.asarray(vals, np.int64)
        bits = max(4, int(np.ceil(np.log2(len(key) * 4 + 1))))
        self.mask = (1 << bits) - 1
        self.shift = np.uint64(64 - bits)
        slot_key, slot_val = np.full(self.mask + 1, -1, np.int64), np.full(self.mask + 1, 1 << 40, np.int64)
        at, left, self.probes = self._slot(key), np.arange(len(key)), 0
        while len(left):  # place what finds its slot free, move the rest on
            where = (at[left] + self.probes) & self.mask
            free = slot_key[where] < 0
            first = np.unique(where[free], return_index=True)[1]
            placed = np.flatnonzero(free)[first]
            slot_key[where[placed]], slot_val[where[placed]] = key[left[placed]], val[left[placed]]
            left = np.delete(left, placed)
            self.probes += 1
        self.slot_key, self.slot_val = slot_key, slot_val

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, 1 << 40 where it does not merge."""
        none = np.int64(1 << 40)
        shape = a.shape
        key = (a * self.base + b).ravel()
        out = np.full(key.shape, none, np.int64)
        todo = np.flatnonzero((a.ravel() >= 0) & (b.ravel() >= 0))
        at = self._slot(key[todo])
        for _ in range(self.probes):
            found = self.slot_key[at]
            hit = found == key[todo]
            out[todo[hit]] = self.slot_val[at[hit]]
            go = ~hit & (found >= 0)
            todo, at = todo[go], (at[go] + 1) & self.mask
            if not len(todo):
                break
        return out.reshape(shape)

    def _matrix(self, rows: list[np.ndarray], width: int) -> list[list[int]]:
        """Merge rows of token ids, all of at most `width`, until nothing merges."""
        m = np.full((len(rows), width), -1, np.int64)
        for i, r in enumerate(rows):
            m[i, : len(r)] = r
        size = np.fromiter(map(len, rows), np.int64, len(rows))
        none = np.int64(1 << 40)
        done: list[list[int]] = [[]] * len(rows)
        ids = np.arange(len(rows))
        rank = self.rank_of(m[:, :-1], m[:, 1:])
        while len(ids):
            at = rank.argmin(axis=1)
            low = rank[np.arange(len(ids)), at]
            out = low >= none
            if out.any():
                for i, r, n in zip(ids[out], m[out], size[out], strict=True):
                    done[i] = r[:n].tolist()
                stay = ~out
                ids, m, rank, size, at, low = ids[stay], m[stay], rank[stay], size[stay], at[stay], low[stay]
                if not len(ids):
                    break
                w = int(size.max())
                if w < m.shape[1]:
                    m, rank = np.ascontiguousarray(m[:, :w]), np.ascontiguousarray(rank[:, : w - 1])
            k = np.arange(len(ids))
            w = m.shape[1]
            if w <= WIDE:
                m[k, at] = low
                cols = np.arange(w - 1)[None, :]
                src = cols + (cols > at[:, None])  # close the gap right of the merged pair
                body = np.take_along_axis(m, src, 1)
                m = np.concatenate([body, np.full((len(ids), 1), -1, np.int64)], axis=1)
                size = size - 1
            else:
                hit = rank == low[:, None]
                # overlapping occurrences: of each run of hits, from the left, every other one
                col = np.broadcast_to(np.arange(hit.shape[1]), hit.shape)
                before = np.maximum.accumulate(np.where(hit, -1, col), axis=1)
                hit &= (col - before) % 2 == 1
                keep = np.ones(m.shape, bool)
                keep[:, 1:] = ~hit
                m[:, :-1] = np.where(hit, low[:, None], m[:, :-1])
                order = np.argsort(~keep, axis=1, kind="stable")
                m = np.where(np.take_along_axis(keep, order, 1), np.take_along_axis(m, order, 1), -1)
                size = size - hit.sum(1)
            rank = self.rank_of(m[:, :-1], m[:, 1:])
        return done

    def pieces(self, word: str) -> list[bytes]:
        """A pretoken's bytes, cut where no vocabulary entry holds the neighbouring bytes."""
        raw = word.encode("utf-8", "replace")
        if len(raw) < 2:
            return [raw] if raw else []
        b = np.frombuffer(raw, np.uint8)
        cut = np.flatnonzero(~self.adjacent[b[:-1], b[1:]]) + 1
        if not len(cut):
            return [raw]
        edges = [0, *cut.tolist(), len(raw)]
        return [raw[i:j] for i, j in zip(edges, edges[1:], strict=False)]

    def encode_pieces(self, pieces: list[bytes]) -> dict[bytes, list[int]]:
        """Ids of each different piece, by length-bucketed matrices."""
        out: dict[bytes, list[int]] = {}
        buckets: dict[int, list[bytes]] = {}
        for p in pieces:
            if p in self.ranks:
                out[p] = [self.ranks[p]]
            else:
                w = next((x for x in _WIDTHS if len(p) <= x), 0) or 1 << (len(p) - 1).bit_length()
                buckets.setdefault(w, []).append(p)
        for w, rows in buckets.items():
            step = max(1, (1 << 20) // w)
            for i in range(0, len(rows), step):
                part = rows[i : i + step]
                for p, ids in zip(part, self._matrix([self.byte[np.frombuffer(p, np.uint8)] for p in part], w), strict=True):
                    out[p] = ids
        return out

    def lookup(self, words: set[str]) -> dict[str, list[int]]:
        """Ids of pretokens; those met before are remembered, at most REMEMBERED of them."""
        known = self.known
        parts = {w: self.pieces(w) for w in words if w not in known}
        ids = self.encode_pieces(list({p for ps in parts.values() for p in ps}))
        fresh = {w: [x for p in ps for x in ids[p]] for w, ps in parts.items()}
        if len(known) + len(fresh) <= REMEMBERED:
            known.update(fresh)
            return known
        table = {w: known[w] for w in words if w in known} | fresh
        self.known = fresh if len(fresh) <= REMEMBERED else {}
        return table

    def encode(self, texts: list[str | None]) -> list:
        """Ids of each text. Null and empty texts have the empty list."""
        found = [self.pattern.findall(t) if t and len(t) <= LONG else [] for t in texts]
        table = self.lookup({w for ws in found for w in ws})
        out = [[x for w in ws for x in table[w]] for ws in found]
        for i, t in enumerate(texts):
            if t and len(t) > LONG:
                out[i] = self.encode_long(t)
        return out

    def encode_long(self, text: str) -> array:
        """Ids of one huge text, its pretokens taken some at a time."""
        out, matches = array("i"), self.pattern.finditer(text)
        while words := [m.group() for m in islice(matches, 100_000)]:
            table = self.lookup(set(words))
            for w in words:
                out.extend(table[w])
        return out


_LOADED: dict[tuple[str, str], Bpe] = {}


def _lists(rows: list) -> pa.Array:
    """Rows of ids, lists or arrays, as an Arrow list array."""
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int64)
    flat = np.empty(int(ends[-1]), np.int32)
    for r, a, b in zip(rows, ends, ends[1:], strict=False):
        flat[a:b] = r
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))


def encode_texts(df: DataFrame, key: str, text: str, path: str, pattern: str, batch: int = 512) -> DataFrame:
    """(key, ids ARRAY<INT>): token ids of every row's whole text, without special tokens.

    Null and empty texts have the empty list. Rows are neither dropped nor merged; other columns are ignored."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]):
        bpe = _LOADED.get((path, pattern)) or _LOADED.setdefault((path, pattern), Bpe(path, pattern))
        for b in batches:
            for i in range(0, b.num_rows, batch):
                part = b.slice(i, batch)
                ids = bpe.encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(ids)], names=["__key", "ids"])

    out = df.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text")).mapInArrow(run, f"__key {kind}, ids array<int>")
    return out.select(F.col("__key").alias(key), "ids")
