"""

Groups are chapters, tracks or books; every function states what it holds in memory."""

from __future__ import annotations

import bisect
import difflib
import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonograin.operators.pairing import Pairing

_WORD = re.compile(r"[a-z0-9']+")
# Names of numbers.
ONES = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
TENS = ". . twenty thirty forty fifty sixty seventy eighty ninety".split()


def ratio(a, b, autojunk: bool = True) -> float:
    """SQ-03: similarity 2 * matches / total of two sequences, by longest matching blocks."""
    return difflib.SequenceMatcher(None, a, b, autojunk=autojunk).ratio()


@F.pandas_udf(T.DoubleType())
def _ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def ratio_column(a: Column, b: Column) -> Column:
    """SQ-03, SC-23: ratio() of two texts; null if one is null."""
    return _ratio_udf(a, b)


UNDER_HUNDRED = [*ONES, *(f"{t} {o}".strip() for t in TENS[2:] for o in ("", *ONES[1:10]))]


def _whole_number(n: int) -> str:
    """A number below a million as a head (pairs of a year, thousands, hundreds) and what is left of it."""
    if n < 100:
        return UNDER_HUNDRED[n]
    if n % 100 and 1100 <= n <= 2099:
        size, name, link = 100, "", "oh " if n % 100 < 10 else ""
    else:
        size, name, link = (1000, " thousand", "") if n >= 1000 else (100, " hundred", "and ")
    head, rest = divmod(n, size)
    return _whole_number(head) + name + (f" {link}{_whole_number(rest)}" if rest else "")


def spoken_number(s: str) -> str:
    """SC-10: a number as it is read: years from 1100 to 2099 in pairs, decimals after 'point', up to 999,999; what is none stays."""
    whole, point, part = s.replace(",", "").partition(".")
    read = _whole_number(int(whole)) if re.fullmatch(r"\d{1,6}|0*\d{1,6}", whole) else whole
    if not point:
        return read
    in_one = re.fullmatch(r"[1-9]\d", part)  # two decimals are read as one number
    return f"{read} point " + (UNDER_HUNDRED[int(part)] if in_one else " ".join(ONES[int(d)] if d.isdigit() else d for d in part))


@F.pandas_udf(T.StringType())
def spoken_numbers(s: pd.Series) -> pd.Series:
    """SC-10 in texts: every free-standing number written out."""
    return s.map(lambda t: None if t is None else re.sub(r"\b\d+(?:\.\d+)?\b", lambda m: spoken_number(m.group()), t))


def numbers_written(word: Column) -> Column:
    """SC-10 for single words: those with a digit, their numbers written out; null for the rest, which Python does not see."""
    return F.when(word.rlike(r"\d"), spoken_numbers(F.when(word.rlike(r"\d"), word)))


def longest_increasing(values: list[int]) -> list[int]:
    """SQ-01: positions of a longest non-decreasing subsequence; of equal ones the one that ends last is kept."""
    tops: list[int] = []
    at: list[int] = []
    back = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect.bisect_right(tops, v)
        back[i] = at[k - 1] if k else -1
        tops[k : k + 1] = [v]
        at[k : k + 1] = [i]
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def monotone_rows(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """SQ-01: (keys, order, value, kept): whether a row lies on a longest non-decreasing run of `value` in its group.

    Rows with a null value are left out. A group is held in memory as two arrays."""
    kinds = dict(df.dtypes)
    shape = ", ".join(f"{c} {kinds[c]}" for c in [*keys, order, value]) + ", kept boolean"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([order, value], kind="stable").reset_index(drop=True)
        on = set(longest_increasing(pdf[value].tolist()))
        return pdf.assign(kept=[i in on for i in range(len(pdf))])

    src = df.select(*keys, order, value).where(F.col(value).isNotNull() & F.col(order).isNotNull())
    return src.groupBy(*keys).applyInPandas(run, shape)


def locate(source: list[str], audio: list[str], lookahead: int = 24, threshold: float = 0.60, margin: float = 0.08) -> tuple[str, list[tuple[int, int, int, float]]]:
    """JN-16, TK-01: where a text starts in a word stream: (status, up to five (start, end, matched, similarity)).

    The first `lookahead` words are compared with every window; a window is looked at only if it shares enough
    words to reach the threshold at all."""
    source = source[:lookahead]
    if not source or not audio:
        return "no-match", []
    n = len(source)
    want: dict[str, int] = {}
    for w in source:
        want[w] = want.get(w, 0) + 1
    found = []
    matcher = difflib.SequenceMatcher(None, autojunk=False)
    for start in range(max(1, len(audio) - n + 2)):
        window = audio[start : start + n]
        if not window:
            continue
        have = dict(want)
        shared = 0
        for w in window:
            if have.get(w, 0) > 0:
                have[w] -= 1
                shared += 1
        if shared / max(n, len(window)) < threshold:
            continue
        matcher.set_seqs(source, window)
        matched = sum(b.size for b in matcher.get_matching_blocks())
        similarity = matched / max(n, len(window))
        if similarity >= threshold:
            found.append((start, start + len(window), matched, round(similarity, 3)))
    found.sort(key=lambda c: (-c[3], -c[2], c[0]))
    if not found:
        return "no-match", []
    unsure = len(found) > 1 and found[1][3] >= found[0][3] - margin
    return ("ambiguous" if unsure else "resolved"), found[:5]


def locate_texts(texts: DataFrame, words: DataFrame, keys: list[str], ident: str, text: str, pos: str, word: str) -> DataFrame:
    """JN-16: (keys, ident, status, place, start_token, end_token, matched, similarity), one row per candidate, and one
    without candidate where there is none. One group's words are held in memory."""
    kinds = dict(texts.dtypes)
    shape = ", ".join(f"{k} {kinds[k]}" for k in [*keys, ident]) + ", status string, place int, start_token int, end_token int, matched int, similarity double"

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        audio = _WORD.findall(" ".join(w for w in b.sort_values(pos)[word] if isinstance(w, str)).lower())
        rows = []
        for r in a.to_dict("records"):
            status, found = locate(_WORD.findall((r[text] or "").lower()), audio)
            head = [r[k] for k in [*keys, ident]]
            rows += [[*head, status, i + 1, *c] for i, c in enumerate(found)] or [[*head, status, None, None, None, None, None]]
        return pd.DataFrame(rows, columns=[*keys, ident, "status", "place", "start_token", "end_token", "matched", "similarity"])

    left = texts.select(*keys, ident, text).groupBy(*keys)
    return left.cogroup(words.select(*keys, pos, word).groupBy(*keys)).applyInPandas(run, shape)


def reconcile(chapters: list[dict], tracks: list[dict], most: int = 3, skip: float = 0.10, grouping: float = 0.04) -> list[dict]:
    """SQ-02, JN-17: best monotone pairing of chapters and tracks, in groups of up to `most`; either may be skipped.

    chapters: head, tail (normalised anchors), chars; tracks: head, tail, duration.  A group scores 0.75 of the
    anchors' likeness, 0.15 of the likeness of text and time shares and 0.10 of the count ratio, less `grouping` per
    further member; a skip costs `skip`.  Of equal scores the way found first stays."""
    return Pairing(chapters, tracks, most, skip, grouping).rows()


def reconcile_books(chapters: DataFrame, tracks: DataFrame, key: str = "book") -> DataFrame:
    """SQ-02 per book: (book, step, kind, chapters, tracks, confidence). chapters: key, n, head, tail, chars; tracks: key, n,
    head, tail, duration. A book's chapters and tracks are held in memory."""
    kind = dict(chapters.dtypes)[key]

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        rows = reconcile(a.sort_values("n").to_dict("records"), b.sort_values("n").to_dict("records"))
        book = (a if len(a) else b)[key].iloc[0]
        cols = ([book] * len(rows), range(len(rows)), [r["kind"] for r in rows], [r["chapters"] for r in rows], [r["tracks"] for r in rows], [r["confidence"] for r in rows])
        return pd.DataFrame(dict(zip((key, "step", "kind", "chapters", "tracks", "confidence"), cols, strict=True)))

    shape = f"{key} {kind}, step int, kind string, chapters array<int>, tracks array<int>, confidence double"
    return chapters.groupBy(key).cogroup(tracks.groupBy(key)).applyInPandas(run, shape)


def merge_blocks(blocks: list[dict], is_heading, is_title) -> list[dict]:
    """WN-02: neighbouring blocks of an extracted page made whole.

    Repeats of the block before (under 100 characters) go.  A word chopped by a hyphen is joined; headings and tables
    merge with nothing of another kind; a block joins the next if that begins in lower case (up to 300 words or 2000
    characters) or if it has no final mark and is no title (up to 40 words or 280 characters)."""
    out: list[dict] = []
    last = None
    for b in blocks:
        t = (b.get("text") or "").strip()
        if not t or (t == last and len(t) < 100):
            continue
        last = t
        if out:
            cur = out[-1]
            c = cur["text"].strip()
            words = len(c.split())
            if re.search(r"\b[a-zA-Z]+-\s*$", c):
                cur["text"] = re.sub(r"-\s*$", "", c) + t
                continue
            goes_on = bool(re.match(r"^[\"“‘'(\[]*[a-z]", t))
            apart = (is_heading(cur) and not goes_on) or is_heading(b) or bool(cur.get("is_tabular")) != bool(b.get("is_tabular"))
            wraps = not re.search(r"[.!?…”\"’)]$", c) and not is_title(c) and words < 40 and len(c) < 280
            if not apart and ((goes_on and words < 300 and len(c) < 2000) or wraps):
                cur["text"] = f"{c} {t}"
                continue
        out.append(dict(b, text=t))
    return out


def rebuild_paragraphs(rows: list[dict], size: int = 4, words: int = 80) -> list[int]:
    """WN-16: paragraph number of each sentence for chapters in which nearly every sentence is an element of its own
    (at least 15 sentences, over 85 % different elements); others keep theirs.

    A paragraph ends after `size` sentences or `words` words, before a quotation after two, and around headings and dividers."""
    known = {r["elem_idx"] for r in rows if r["elem_idx"] is not None}
    if len(rows) < 15 or len(known) / len(rows) <= 0.85:
        return [r["elem_idx"] for r in rows]
    out, number, held, n_words = [], 0, 0, 0
    for r in rows:
        t = (r["text"] or "").strip()
        if r["is_heading"] or t in ("* * *", "***", "---", "• • •"):
            number += 1
            out.append(number)
            number, held, n_words = number + 1, 0, 0
            continue
        full = held >= size or n_words >= words or (held >= 2 and t[:1] in ("“", '"', "‘", "'"))
        if full and held:
            number, held, n_words = number + 1, 0, 0
        out.append(number)
        held, n_words = held + 1, n_words + len(t.split())
    return out


def _surplus(text: str, mark: str) -> int:
    """Openings less closings of curly marks; for straight ones, whether their number is odd."""
    return text.count('"') % 2 if mark == '"' else text.count("“") - text.count("”")


def _mend(texts: list[str], mark: str, n: int, closing: bool) -> None:
    """Put n marks at the outer end of the chapter, or one at the record that is itself out of balance if the end is quoted already."""
    step = -1 if closing else 1
    order = range(len(texts))[::step]
    quoted = ('"', "”", "’") if closing else ('"', "“", "‘")
    def edge(t: str) -> str:
        return t.rstrip()[-1:] if closing else t.lstrip()[:1]
    def with_mark(t: str, k: int) -> str:
        return t.rstrip() + mark * k if closing else mark * k + t.lstrip()
    first = order[0]
    if edge(texts[first]) not in quoted:
        texts[first] = with_mark(texts[first], n)
        return
    kind = '"' if mark == '"' else "“"
    for i in order:
        s = _surplus(texts[i], kind)
        if (s > 0 if closing else s < 0) and edge(texts[i]) not in quoted[:2]:
            texts[i] = with_mark(texts[i], 1)
            return


def balance_quotes(texts: list[str]) -> list[str]:
    """SQ-14: a chapter's texts with its quotation marks balanced by at most two marks at its ends (or in the record that
    opened or closed too much). Balanced texts come back unchanged, so healing twice changes nothing more."""
    out = list(texts)
    if out and sum(_surplus(t, '"') for t in out) % 2:
        _mend(out, '"', 1, True)
    curly = sum(_surplus(t, "“") for t in texts)
    if out and curly:
        _mend(out, "”" if curly > 0 else "“", min(abs(curly), 2), curly > 0)
    return out


def per_group(df: DataFrame, keys: list[str], order: list[str], column: str, into: str, kind: str, fn) -> DataFrame:
    """A function over a group's ordered rows, one value a row, as column `into`: for folds with carried state (WN-16, SQ-14)."""
    kinds = dict(df.dtypes)
    cols = [*keys, *[o for o in order if o not in keys]]
    shape = ", ".join(f"{c} {kinds[c]}" for c in cols) + f", {into} {kind}"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        clean = pdf.astype(object).where(pdf.notna(), None)
        return pdf[cols].assign(**{into: pd.Series(fn(clean.to_dict("records")), index=pdf.index, dtype=object)})

    names = list(dict.fromkeys([*cols, *column.split(",")]))
    return df.select(*names).groupBy(*keys).applyInPandas(run, shape)


def read_json(text: str | None):
    """SC-24: the JSON value in a model's answer: as it is, in a fence, the outermost array, with stray commas, else the
    objects that can be read one by one; None if there is none."""
    if not text:
        return None
    fence = re.search(r"```(?:json)?\s*(.*?)```", text, re.S)
    tries = [text.strip()] + ([fence.group(1).strip()] if fence else [])
    a, b = text.find("["), text.rfind("]")
    if 0 <= a < b:
        tries.append(text[a : b + 1])
        tries.append(re.sub(r",\s*([\]}])", r"\1", re.sub(r"}\s*{", "},{", text[a : b + 1])))
    for t in tries:
        try:
            return json.loads(t)
        except ValueError:
            pass
    out, depth, start, inside, esc = [], 0, None, False, False
    for i, ch in enumerate(text):
        if inside:
            esc = ch == "\\" and not esc
            inside = not (ch == '"' and not esc)
        elif ch == '"':
            inside = True
        elif ch == "{":
            start = i if depth == 0 else start
            depth += 1
        elif ch == "}" and depth:
            depth -= 1
            if depth == 0:
                try:
                    out.append(json.loads(text[start : i + 1]))
                except ValueError:
                    pass
    return out or None
