"""Text statistics of each document and the kind of what is not running text (problem 10).

A document's text is cut at fixed positions, every CHUNK characters.  A chunk's partial is a vector of counts plus the state
of the two lines that its borders cut.  How a cut line is put together depends on those positions alone: a line over one of them is
counted whole; a line over two or more is counted chunk by chunk, words and cells over a border being joined, and becomes prose, row
or entry by where most of its characters belong.  So partials merge associatively, in any tree, and hold at most a chunk's
length of text at either end however long a line is.  All lines of an Arrow batch are counted together in numpy; only lines
that may be entries or rows are looked at one by one.  Ratios and rules are plain columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonograin.tables import spread

#: Characters in a chunk, and chunks of a document that one task merges before the partials meet.
CHUNK, FAN = 1 << 16, 64
#: Characters from a chunk's border within which a cell's end is preferred to a word's as the place to cut a long line.
NEAR_BORDER = 1024

# Marks that end a sentence, and closing marks that may stand behind them.
FULL_MARKS, CLOSING_MARKS = ".!?…。！？؟।॥", "”’»›」』）)]\"'*_"
_BULLET = re.compile(r"\s*(?:[-–—*•·・‣◦▪●○■□+]\s?(?:\[[ xX]?\]\s*)?|[(（]?(?:\d{1,4}|[ivxlcIVXLC]{1,5}|[a-zA-Z])[.)、）．]\s*|[☐☑✓✔]\s*)(?=\S)")
_LEADER = re.compile(r"(?:\.{3,}|…{2,}|(?: \.){3,}|·{3,}|_{3,})\s*\d{0,5}\s*$|[^\d\s],\s*\d{1,4}(?:\s*[-–,]\s*\d{1,4})*$")
_GLOSS = re.compile(r"^[^.!?。！？]{1,40}(?:\([\w. ]{1,12}\))?\s*[:：=–—-]\s*[^.!?。！？]{1,30}$")
_WORD = re.compile(r"[^\W_]+(?:[’'\-][^\W_]+)*")
_FIELD = re.compile(r"\t+|\s*\|\s*| {2,}|;|,(?=\S)")
_SPACED = re.compile(r"\S(?:\t+| {2,}|\s*\|\s*)\S")
_RULE = re.compile(r"[\s|:+\-=_]+")
_CJK = re.compile(r"[぀-ヿ㐀-鿿豈-﫿฀-๿]")
_MARKUP = re.compile(r"</?[a-zA-Z][^<>\n]{0,200}>|&(?:[a-z]{2,8}|#\d{1,6});|<!--|-->|\]\]>|https?://\S+|\{\{|\}\}|\[\[|\]\]")
_CODE = frozenset("{}<>[]=;&|\\^~`$#@%*_/+")
_MOJIBAKE = re.compile(r"[\x80-\x9f]|Ã[\x80-ÿŒœŠšŸžƒ‚„…†‡ˆ‰‹‘’“”•–—˜™›€]?|Â[\x80-¿ ]|â[€\x80‚„†‡™œ][\x80-ÿ™œ“”˜]?|[åäãæçèéê][\x80-¿€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]|ï»¿|ï¼|ã€|Ð[\x80-¿°±²³µ]|Ñ[\x80-¿€‚ƒ„…†‡ˆ‰Š‹Œ]|�")
_VOWELS = frozenset("aeiouyáéíóúüöäâêîôûàèìòùåæøœ")
_LATIN = re.compile(r"[A-Za-zÀ-ſ]")
_BORDER = re.compile(r"[^\w’'\-]")

#: Counts of a text, in the order of the vector.  The first ones are sums over words and characters, the rest over whole lines.
TOKENS = (
    "chars", "words", "word_chars", "letters", "digits", "spaces", "symbols", "visible", "common", "vowelless", "latin_words", "markup_chars", "code_chars", "mojibake_chars",
    "long_token_chars", "odd_words", "grams",
)
LINES = ("lines", "ended_lines", "prose_chars", "entry_lines", "entry_chars", "row_lines", "row_chars", "field_cells")
COUNTS = TOKENS + LINES
_AT = {n: i for i, n in enumerate(COUNTS)}
#: Bits of the bitmap that stands for the different grams (linear counting).
BITS = 4096
#: Forms of a line; of a long line's pieces the characters of each, those of joined pieces, and the cells.
NONE, PROSE, ROW, ENTRY, CELLS = range(5)
#: How a piece ends: no full mark, a full mark, or as what is before it (nothing to see but closing marks).
OPEN, FULL, AS_BEFORE = range(3)

_ALPHA, _DIGIT, _SPACE, _WORDS, _WIDE, _LAT, _VOWEL, _CODES = (1 << i for i in range(8))
_class = np.full(0x110000, 0xFFFF, np.uint16)
_lower = np.arange(0x110000, dtype=np.uint64)
_P, _P_INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _classes(codes: np.ndarray) -> np.ndarray:
    """Class bits of each character; a character is looked up once in a process."""
    out = _class[codes]
    new = out == 0xFFFF
    if new.any():
        for cp in np.unique(codes[new]).tolist():
            ch = chr(cp)
            low = ch.lower()
            if len(low) == 1:
                _lower[cp] = ord(low)
            bits = _ALPHA * ch.isalpha() | _DIGIT * ch.isdigit() | _SPACE * ch.isspace() | _WORDS * ch.isalnum() | _WIDE * bool(_CJK.match(ch))
            _class[cp] = bits | _LAT * bool(_LATIN.match(ch) and ch.isalpha()) | _VOWEL * (low in _VOWELS) | _CODES * (ch in _CODE)
        out = _class[codes]
    return out


def _hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of each stretch, equal for equal stretches wherever they stand."""
    if len(_powers[0]) <= len(low):
        n = 1 << len(low).bit_length()
        for i, base in enumerate((_P, _P_INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate((low + np.uint64(1)) * _powers[0][: len(low)])])
        return _mixed((sums[ends] - sums[starts]) * _powers[1][starts])


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


class Common:
    """The frequent words: hashes of those that are words, and those of spaceless scripts as they are."""

    def __init__(self, words) -> None:
        plain = sorted({w.lower() for w in words if w and not _CJK.match(w)})
        self.wide = sorted({w.lower() for w in words if w and _CJK.match(w)})
        codes = [np.frombuffer(w.encode("utf-32-le"), np.uint32) for w in plain]
        ends = np.cumsum([len(c) for c in codes], dtype=np.int64)
        low = np.concatenate(codes).astype(np.uint64) if codes else np.zeros(0, np.uint64)
        self.hashes = np.sort(_hashes(low, np.append(0, ends)[:-1], ends))

    def holds(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(h), bool)
        return self.hashes[np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)] == h


def _form(text: str, words: int, word_chars: int, wide: int, full: bool, row_like: bool) -> tuple[int, int]:
    """(form, cells) of a line or piece that has something to see."""
    s = text.strip()
    cells = [c for c in _FIELD.split(s.strip("|")) if c.strip()] if row_like else []
    leader = words <= 14 and bool(_LEADER.search(s))  # an entry of a contents list or index; longer lines are none
    if row_like:
        if "|" in s and _RULE.fullmatch(s):
            return ROW, len(cells)
        if cells and word_chars / len(cells) <= 24 and not ("{" in s and "}" in s and "=" in s):
            n = len(cells)
            if n >= 2 and s.startswith("|") and s.endswith("|"):
                return ROW, n
            if n >= 3 and not leader and (_SPACED.search(s) or s.count(";") >= 3 or (s.count(",") >= 2 and not re.search(r",\s", s))):
                numeric = sum(any(map(str.isdigit, c)) for c in cells)
                if (numeric or n >= 4 or s.count("|") >= 2 or "\t" in s) and not (full and (not numeric or words > 2 * n)):
                    return ROW, n
    if not words:
        return NONE, len(cells)
    if leader:
        return ENTRY, len(cells)
    bullet = _BULLET.match(text)
    n_body = max(1, wide // 3) if wide else len(_WORD.findall(text, bullet.end())) if bullet else words
    entry = (bullet and n_body <= 3) or not full and (((n_body <= 4 or (bullet and n_body <= 7)) and wide <= 16) or (words <= 9 and wide <= 20 and _GLOSS.match(s)))
    return (ENTRY if entry else PROSE), len(cells)


@dataclass
class Counted:
    """What evaluate() finds, a row a unit: sums over words and characters, form, cells, end; and the bits of the grams with their units."""

    sums: np.ndarray
    form: np.ndarray
    cells: np.ndarray
    end: np.ndarray
    bit_unit: np.ndarray
    bit: np.ndarray


def evaluate(units: list[str], common: Common, cells_of_all: bool = False) -> Counted:
    """Count lines, or pieces of lines, all at once. Units hold no line end."""
    n = len(units)
    joined = "\n".join(units) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    nl = np.flatnonzero(codes == 10)
    starts = np.append(0, nl[:-1] + 1)
    cls = _classes(codes)
    low = _lower[codes]
    out = {c: np.zeros(n, np.int64) for c in TOKENS}

    def per(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask.astype(np.int32), starts).astype(np.int64)

    def running(mask: np.ndarray) -> np.ndarray:
        return np.append(0, np.cumsum(mask, dtype=np.int32))

    def is_(bits: int) -> np.ndarray:
        return (cls & bits) != 0

    space, wide_at, plain_at = is_(_SPACE), is_(_WIDE), codes < 128
    out["chars"], out["letters"], out["digits"], out["spaces"] = nl - starts, per(is_(_ALPHA)), per(is_(_DIGIT)), per(space) - 1
    visible = out["visible"] = out["chars"] - out["spaces"]
    out["symbols"] = visible - out["letters"] - out["digits"]
    # words: letters and digits, held together by single marks between them
    w = is_(_WORDS)
    mark = (codes == 0x2019) | (codes == 0x27) | (codes == 0x2D)
    inside = w.copy()
    inside[1:-1] |= mark[1:-1] & w[:-2] & w[2:]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    ws, we = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    unit, size = np.searchsorted(nl, ws), we - ws

    def words_where(mask: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(unit[mask], None if weight is None else weight[mask], minlength=n).astype(np.int64)

    every = np.ones(len(ws), bool)
    out["words"], out["word_chars"] = words_where(every), words_where(every, size)
    in_word = lambda mask: (c := running(mask))[we] - c[ws]
    latin = in_word(is_(_LAT)) == size
    out["latin_words"], out["vowelless"] = words_where(latin), words_where(latin & (size > 1) & (in_word(is_(_VOWEL)) == 0))
    out["odd_words"] = words_where((in_word(plain_at) == size) & (in_word(is_(_DIGIT)) > 0) & (in_word(is_(_ALPHA)) > 0))
    h = _hashes(low, ws, we)
    out["common"] = words_where(common.holds(h))
    wide = per(wide_at)
    if wide.any():
        lowered = joined.lower() if len(joined.lower()) == len(joined) else joined
        for word in common.wide:
            at = [m.start() for m in re.finditer(re.escape(word), lowered)]
            out["common"] += np.bincount(np.searchsorted(nl, at), minlength=n)
    # grams: words, and pairs of characters where a script has no spaces
    pair = np.flatnonzero(wide_at[:-1] & ~space[1:])
    with np.errstate(over="ignore"):
        pair_h = _mixed(low[pair] * np.uint64(_P) + low[pair + 1] + np.uint64(7))
    pair_unit = np.searchsorted(nl, pair)
    out["grams"] = out["words"] + np.bincount(pair_unit, minlength=n)
    bit_unit, bit = np.concatenate([unit, pair_unit]), (np.concatenate([h, pair_h]) >> np.uint64(52)).astype(np.int64)
    # tokens between blanks
    edge = np.diff((~space).astype(np.int8), prepend=0, append=0)
    ts, te = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    odd = running(plain_at)
    long = (te - ts > 40) & (odd[te] - odd[ts] == te - ts)
    out["long_token_chars"] = np.bincount(np.searchsorted(nl, ts[long]), (te - ts)[long], minlength=n).astype(np.int64)
    calls = np.zeros(len(codes), bool)
    calls[:-1] = (codes[:-1] == 40) & (codes[1:] == 41)
    out["code_chars"] = per(is_(_CODES) | calls)
    for name, pattern in (("markup_chars", _MARKUP), ("mojibake_chars", _MOJIBAKE)):
        if name == "markup_chars" or not joined.isascii():
            spans = np.array([m.span() for m in pattern.finditer(joined)], np.int64).reshape(-1, 2)
            out[name] = np.bincount(np.searchsorted(nl, spans[:, 0]), spans[:, 1] - spans[:, 0], minlength=n).astype(np.int64)
    # how each ends: the last mark behind which only closing ones stand
    seen = visible > 0
    at = nl - 1
    end = np.full(n, OPEN, np.int8)
    todo = np.flatnonzero(seen)
    place = np.where(~space, np.arange(len(codes)), -1)
    at[todo] = np.maximum.reduceat(place, starts)[todo]
    closing, full_marks = np.isin(codes, [ord(c) for c in CLOSING_MARKS]), np.isin(codes, [ord(c) for c in FULL_MARKS])
    while len(todo):
        a = at[todo]
        end[todo[full_marks[a]]] = FULL
        back = closing[a] & (a > starts[todo])
        end[todo[closing[a] & ~back]] = AS_BEFORE
        todo = todo[back]
        at[todo] -= 1
    end[~seen] = AS_BEFORE
    # forms
    semis, commas = per(codes == 0x3B), codes == 0x2C
    tight = np.append(commas[:-1] & space[1:], False)
    blanks = np.append((codes[:-1] == 32) & (codes[1:] == 32), False)
    row_like = (per((codes == 9) | (codes == 0x7C) | blanks) > 0) | (semis >= 3) | ((per(commas) >= 2) & (per(tight & (np.append(codes[1:], 10) != 10)) == 0))
    form = np.where(seen & (out["words"] > 0), PROSE, NONE).astype(np.int8)
    cells = np.zeros(n, np.int64)
    look = seen & (row_like | ((out["words"] <= 14) & (out["words"] > 0)))
    for i in np.flatnonzero(seen if cells_of_all else look).tolist():
        form[i], cells[i] = _form(units[i], int(out["words"][i]), int(out["word_chars"][i]), int(wide[i]), end[i] == FULL, bool(row_like[i]) or cells_of_all)
    return Counted(np.stack([out[c] for c in TOKENS], axis=1), form, cells, end, bit_unit, bit)


@dataclass
class Edge:
    """The line that a border cuts: its text, if it is cut by this border only; else (`long`) the text up to the next place where a
    word or cell ends, with the forms of what was counted already and how that ends."""

    text: str = ""
    long: bool = False
    forms: np.ndarray = field(default_factory=lambda: np.zeros(5, np.int64))
    end: int = AS_BEFORE


@dataclass
class Partial:
    """Counts of a stretch of whole chunks; `solid` when it holds no line end (both edges then are of one line)."""

    left: Edge
    right: Edge
    solid: bool
    counts: np.ndarray = field(default_factory=lambda: np.zeros(len(COUNTS), np.int64))
    bits: np.ndarray = field(default_factory=lambda: np.zeros(BITS, bool))
    lines: list[str] = field(default_factory=list)  # whole lines that settle() has yet to count


def _last_place(text: str) -> int:
    """Behind which position a chunk's last cell or word ends; 0 if it has no such place."""
    at = max(text.rfind(c, max(0, len(text) - NEAR_BORDER)) for c in "\t|;,") + 1
    if not at:
        at = next((len(text) - m.start() for m in _BORDER.finditer(text[::-1])), 0)
    return at


def _first_place(text: str) -> int:
    """Behind which position a chunk's first cell or word ends; 0 if it has no such place."""
    hits = [a for a in (text.find(c, 0, NEAR_BORDER) for c in "\t|;,") if a >= 0]
    m = None if hits else _BORDER.search(text)
    return min(hits) + 1 if hits else m.end() if m else 0


def _count_piece(p: Partial, text: str, common: Common, forms: np.ndarray, joined: bool) -> int:
    """Add a piece of a long line to p and its characters to `forms`; how it ends."""
    if not text:
        return AS_BEFORE
    c = evaluate([text], common, cells_of_all=True)
    p.counts[: len(TOKENS)] += c.sums[0]
    p.bits[c.bit] = True
    forms[NONE if joined else c.form[0]] += c.sums[0][_AT["visible"]]
    forms[CELLS] += c.cells[0]
    return int(c.end[0])


def _then(end: int, later: int) -> int:
    return end if later == AS_BEFORE else later


def partial(chunk: str, first: bool, last: bool, common: Common) -> Partial:
    """Partial of one chunk; a document begins and ends like a line."""
    if first or last or "\n" in chunk:
        head, *rest = ("\n" * first + chunk + "\n" * last).split("\n")
        return Partial(Edge(head), Edge(rest[-1]), False, lines=rest[:-1])
    a, b = _first_place(chunk), _last_place(chunk)
    p = Partial(Edge(chunk[:a], True), Edge(chunk[b:] if b else "", True), True)
    p.left.end = _count_piece(p, chunk[a:b] if b else chunk, common, p.left.forms, False)
    return p


def _lengthen(p: Partial, edge: Edge, leftwards: bool, common: Common) -> Edge:
    """The edge of a line that turns out to be a long one: all but what the next border may cut is counted."""
    if edge.long:
        return edge
    t, out = edge.text, Edge(long=True)
    if leftwards:  # the line begins in this text and goes on to the right
        at = _last_place(t)
        out.text, rest = t[at:], t[:at]
    else:
        at = _first_place(t) or len(t)
        out.text, rest = t[:at], t[at:]
    out.end = _count_piece(p, rest, common, out.forms, False)
    return out


def _close_line(p: Partial, forms: np.ndarray, end: int) -> None:
    """Count a long line, whose words are counted, as a line."""
    whole = forms[:CELLS].sum()
    if not whole:
        return
    p.counts[_AT["lines"]] += 1
    p.counts[_AT["ended_lines"]] += end == FULL
    kind = max((ROW, ENTRY, PROSE), key=lambda k: forms[k])
    if kind == PROSE or not forms[kind]:
        p.counts[_AT["prose_chars"]] += whole
    else:
        name = "row" if kind == ROW else "entry"
        p.counts[_AT[f"{name}_lines"]] += 1
        p.counts[_AT[f"{name}_chars"]] += whole
        p.counts[_AT["field_cells"]] += forms[CELLS] if kind == ROW else 0


def merge(a: Partial, b: Partial, common: Common) -> Partial:
    """Partial of a followed by b. Associative: what becomes of a line over the border depends on its chunks alone."""
    p = Partial(a.left, b.right, a.solid and b.solid, a.counts + b.counts, a.bits | b.bits, a.lines + b.lines)
    if not (a.solid or b.solid or a.right.long or b.left.long):
        p.lines.append(a.right.text + b.left.text)
        return p
    left = _lengthen(p, a.right, True, common)
    right = _lengthen(p, b.left, False, common)
    forms = (a.left.forms if a.solid else left.forms) + right.forms
    before = a.left.end if a.solid else left.end
    between = _count_piece(p, left.text + right.text, common, forms, True)
    end = _then(_then(before, between), right.end)
    if a.solid:
        p.left = Edge(a.left.text, True, forms, end)
    if b.solid:
        p.right = Edge(b.right.text, True, *(() if a.solid else (forms, end)))
    if not (a.solid or b.solid):
        _close_line(p, forms, end)
    return p


def settle(parts: list[Partial], common: Common) -> None:
    """Count the whole lines of all partials in one go."""
    units = [s for p in parts for s in p.lines]
    if not units:
        return
    of = np.repeat(np.arange(len(parts)), [len(p.lines) for p in parts])
    c = evaluate(units, common)
    seen, vis = c.sums[:, _AT["visible"]] > 0, c.sums[:, _AT["visible"]]
    form = lambda k: (c.form == k).astype(np.int64)
    extra = [seen, seen & (c.end == FULL), form(PROSE) * vis, form(ENTRY), form(ENTRY) * vis, form(ROW), form(ROW) * vis, form(ROW) * c.cells]
    rows = np.concatenate([c.sums, np.stack(extra, axis=1).astype(np.int64)], axis=1)
    total = np.zeros((len(parts), len(COUNTS)), np.int64)
    np.add.at(total, of, rows)
    keys = np.unique(of[c.bit_unit] * BITS + c.bit)
    for p, t, a, b in zip(parts, total, np.searchsorted(keys, np.arange(len(parts)) * BITS), np.searchsorted(keys, np.arange(1, len(parts) + 1) * BITS), strict=True):
        p.counts = p.counts + t
        p.bits[keys[a:b] % BITS] = True
        p.lines = []


_EDGE = pa.struct([("text", pa.string()), ("long", pa.bool_()), ("forms", pa.list_(pa.int64())), ("end", pa.int32())])
_STATE = pa.struct([("left", _EDGE), ("right", _EDGE), ("solid", pa.bool_()), ("bits", pa.binary())])
_EDGE_SQL = "struct<text: string, long: boolean, forms: array<bigint>, end: int>"
#: Columns of the partials: document, block of FAN chunks and their number, counts (with the different grams) and, of documents of several blocks, the state.
_ROW = f"__id bigint, __h bigint, __b bigint, __n bigint, c array<bigint>, state struct<left: {_EDGE_SQL}, right: {_EDGE_SQL}, solid: boolean, bits: binary>"


def _packed(ids: list[tuple], parts: list[Partial]) -> pa.RecordBatch:
    def edge(e: Edge) -> dict:
        return {"text": e.text, "long": e.long, "forms": e.forms.tolist(), "end": e.end}

    states = [{"left": edge(p.left), "right": edge(p.right), "solid": p.solid, "bits": np.packbits(p.bits).tobytes()} if i[3] > 1 else None for i, p in zip(ids, parts, strict=True)]
    cols = [pa.array(list(x), pa.int64()) for x in zip(*ids, strict=True)]
    counts = pa.array([[*p.counts.tolist(), int(p.bits.sum())] for p in parts], pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([*cols, counts, pa.array(states, _STATE)], names=["__id", "__h", "__b", "__n", "c", "state"])


def _unpacked(c: list[int], s: dict) -> Partial:
    left, right = (Edge(e["text"], e["long"], np.array(e["forms"], np.int64), e["end"]) for e in (s["left"], s["right"]))
    return Partial(left, right, s["solid"], np.array(c[:-1], np.int64), np.unpackbits(np.frombuffer(s["bits"], np.uint8)).astype(bool))


def fold(text: str, first: bool, last: bool, common: Common) -> Partial:
    """Partial of a stretch of chunks, not settled yet."""
    whole = None
    for at in range(0, max(1, len(text)), CHUNK):
        p = partial(text[at : at + CHUNK], first and not at, last and at + CHUNK >= len(text), common)
        whole = p if whole is None else merge(whole, p, common)
    return whole


def _count_blocks(words: list[str], chars: int = 1 << 21):
    def run(batches: Iterator[pa.RecordBatch]):
        common = Common(words)
        for b in batches:
            ids, parts, size = [], [], 0
            for i, h, k, n, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                ids.append((i, h, k, n))
                parts.append(fold(text, k == 0, k == n - 1, common))
                size += len(text)
                if size > chars or len(parts) >= 4096:
                    settle(parts, common)
                    yield _packed(ids, parts)
                    ids, parts, size = [], [], 0
            if parts:
                settle(parts, common)
                yield _packed(ids, parts)

    return run


def _merge_blocks(words: list[str]):
    """Blocks of a document, which follow each other in order, to one row; documents of one block pass."""

    def run(batches: Iterator[pa.RecordBatch]):
        common = Common(words)
        held: list = [None, None, -1, 0]  # document, partial, last block, copies of the document

        def emit():
            if held[1] is not None:
                settle([held[1]], common)
                yield _packed([(held[0][0], held[0][1], 0, 1)] * held[3], [held[1]] * held[3])
            held[:] = [None, None, -1, 0]

        for b in batches:
            n = b.column("__n").to_numpy()
            if (n == 1).any():
                yield b.filter(pa.array(n == 1))
            for r in b.filter(pa.array(n > 1)).to_pylist():
                doc = (r["__id"], r["__h"])
                if doc != held[0]:
                    yield from emit()
                    held[0] = doc
                if r["__b"] == 0:
                    held[3] += 1
                if r["__b"] == held[2]:
                    continue  # a repeated row of the same text
                p = _unpacked(r["c"], r["state"])
                held[1] = p if held[1] is None else merge(held[1], p, common)
                settle([held[1]], common)
                held[2] = r["__b"]
        yield from emit()

    return run


def text_counts(df: DataFrame, key: str, text: str, common: list[str]) -> DataFrame:
    """One row per document: (key, the COUNTS as BIGINT columns, distinct_grams). Null and empty texts have zeros.

    `common`: frequent words. A row is a document; repeated rows give repeated results, null keys are kept.  One scan, one pass in
    Python; then the partials, some 200 bytes a document, meet by document, FAN chunks each."""
    block = CHUNK * FAN
    t = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "\r\n?|[\u2028\u2029\u0085]", "\n")
    parts = F.when(F.length("__t") <= block, F.array("__t")).otherwise(F.regexp_extract_all("__t", F.lit(f"(?s)(.{{1,{block}}})"), 1))
    src = df.select(F.col(key).cast("bigint").alias("__id"), t.alias("__t")).select("__id", F.xxhash64("__t").alias("__h"), parts.alias("__p"))
    src = src.select("__id", "__h", F.size("__p").cast("bigint").alias("__n"), F.posexplode("__p").alias("__b", "__c"))
    src = spread(src.select("__id", "__h", F.col("__b").cast("bigint").alias("__b"), "__n", "__c"), "__id", "__h", "__b")
    words = [w for w in common if w]
    rows = src.mapInArrow(_count_blocks(words), _ROW)
    done = rows.repartition("__id", "__h").sortWithinPartitions("__id", "__h", "__b").mapInArrow(_merge_blocks(words), _ROW)
    return done.select(F.col("__id").alias(key), *[F.col("c")[i].alias(c) for i, c in enumerate(COUNTS)], F.col("c")[len(COUNTS)].alias("distinct_grams"))


def with_ratios(counts: DataFrame) -> DataFrame:
    """The statistics derived from the counts; a ratio over nothing is null."""
    def over(a: str, b: str) -> Column:
        return F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))

    return counts.withColumns({
        "mean_word_length": over("word_chars", "words"), "symbol_ratio": over("symbols", "visible"), "digit_ratio": over("digits", "visible"),
        "ended_line_share": over("ended_lines", "lines"), "common_word_share": over("common", "words"), "entry_share": over("entry_chars", "visible"),
        "row_share": over("row_chars", "visible"), "vowelless_share": over("vowelless", "latin_words"),
        "markup_share": over("markup_chars", "visible"), "code_share": over("code_chars", "visible"), "mojibake_share": over("mojibake_chars", "visible"),
        "long_token_share": over("long_token_chars", "visible"), "odd_word_share": over("odd_words", "words"), "letter_share": over("letters", "visible"),
    })


def kind_rules() -> Column:
    """'junk', 'table', 'list', or null for running text and blank texts; the first rule that holds."""
    c = F.col
    rows = (c("row_share") >= 0.5) & (c("row_lines") >= 2)
    entries = (c("entry_share") >= 0.5) & (c("entry_lines") >= 3)
    broken = (c("mojibake_share") > 0.12) | (c("markup_share") > 0.2) | (c("vowelless_share") > 0.5) & (c("latin_words") >= 5)
    # one phrase over and over: few different grams (words, or pairs of characters in spaceless scripts) for many
    again = (c("grams") >= 12) & (c("distinct_grams") <= 4) | (c("grams") >= 12 * c("distinct_grams")) & (c("distinct_grams") <= 15)
    blob = (c("long_token_share") > 0.5) & ~rows
    noise = (c("letter_share") < 0.35) | (c("code_share") > 0.15) | (c("odd_word_share") > 0.3)
    return (
        F.when(c("visible") == 0, None)
        .when(F.coalesce(broken | again | blob, F.lit(False)), "junk")
        .when(F.coalesce(rows, F.lit(False)), "table")
        .when(F.coalesce(entries, F.lit(False)), "list")
        .when(F.coalesce(noise, F.lit(False)), "junk")
    )
