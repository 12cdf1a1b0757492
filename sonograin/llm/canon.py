"""One consistent written form for text that looks alike (problem 4).

Method: Unicode quick-check.  Only code points that can be unstable (that fail the quick check of the normal form, may compose with
a neighbour, are invisible, or imitate a Latin letter) are looked for; each run of them is widened to
its boundary context, normalised, and spliced into the text, which is otherwise not touched; words with imitating letters likewise.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Code points that draw nothing (default ignorables).
INVISIBLE_RANGES = (
    (0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F),
    (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF),
    (0xFFA0, 0xFFA0), (0xFFF9, 0xFFFB), (0xE0000, 0xE0FFF),
)
# Letters of other scripts drawn like a Latin letter, as "imitations>originals" of equal length.
LOOK_ALIKES = (
    # Cyrillic
    "аеорсухіјѕһԁԛԝӏү>aeopcyxijshdqwly",
    "АВЕКМНОРСТХІЈЅԚԜҮ>ABEKMHOPCTXIJSQWY",
    # Greek
    "ονιαρυγκϲϳ>oviapuykcj",
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹ>ABEZHIKMNOPTYXC",
    # Armenian
    "օսհոցզյՕՍ>ouhngqjOU",
    # Latin small capitals and variants drawn like plain small letters
    "ᴏᴄᴠᴡᴢꜱɑɡ>ocvwzsag",
    # Cherokee
    "ᎪᏴᏟᎠᎬᎻᎫᏦᏞᎷᏢᏒᏚᎢᏙᎳᏃ>ABCDEHJKLMPRSTVWZ",
)
# Kinds of compatibility decomposition that keep the look of the character.
SAME_LOOK = frozenset({"wide", "narrow", "noBreak", "compat", "font", "initial", "medial", "final", "isolated"})
# Compatibility characters whose decomposition looks different (ellipses, spacing accents, long s).
DIFFERENT_LOOK = frozenset("․‥…¨¯´¸˘˙˚˛˜˝ſͺ΄᾽᾿῀῾‗‾")
VIRAMA_CLASS = 9

_IMITATES = {a: b for pair in LOOK_ALIKES for a, b in zip(*pair.split(">"), strict=True)}


def _script(ch: str) -> str:
    """Name of a letter's script as the first word of its Unicode name; '' for what is no letter."""
    if not ch.isalpha():
        return ""
    try:
        return unicodedata.name(ch).split(" ", 1)[0]
    except ValueError:
        return ""


_script = lru_cache(maxsize=65536)(_script)


INVISIBLE = frozenset(cp for a, b in INVISIBLE_RANGES for cp in range(a, b + 1))
# Joiners that change the shape of an Indic cluster or join pictographs.
NON_JOINER, JOINER = 0x200C, 0x200D


def _plain(ch: str) -> str:
    """A character's decomposition as far as it keeps its look."""
    d = unicodedata.decomposition(ch)
    if not d or ch in DIFFERENT_LOOK:
        return ch
    parts = d.split()
    if parts[0].startswith("<"):
        if parts[0][1:-1] not in SAME_LOOK:
            return ch
        parts = parts[1:]
    return "".join(_plain(chr(int(x, 16))) for x in parts)


# Blocks whose characters neither decompose nor compose with what is before them: ideographs, Hangul syllables,
# surrogates and private use, and the planes behind the emoji.
STABLE_BLOCKS = ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3), (0xD800, 0xF8FF), (0x20000, 0x2F7FF), (0x2FA20, 0xDFFFF), (0xE1000, 0x10FFFF))


@lru_cache(maxsize=1)
def _tables() -> tuple[re.Pattern, dict[int, str | None]]:
    """The pattern of unstable runs, and what such a code point is replaced by before composing: its look-keeping
    decomposition, or nothing."""
    unstable, plain = [], {0x2010: "-", 0x2011: "-"}
    begin = 0x80
    for a, b in (*STABLE_BLOCKS, (0x110000, 0x110000)):
        for cp in range(begin, a):
            ch = chr(cp)
            p = _plain(ch)
            stable = unicodedata.is_normalized("NFC", ch)
            if p != ch and (not stable or unicodedata.decomposition(ch).startswith("<")):
                plain[cp] = p
            # combining marks, and what the quick check answers with "maybe": it composes with a letter before it
            if cp in plain or cp in INVISIBLE or ch in _IMITATES or not stable or unicodedata.combining(ch) or cp in _SECONDS:
                unstable.append(cp)
        begin = b + 1
    runs, start = [], None
    for x, y in zip(unstable, [*unstable[1:], None], strict=True):
        start = x if start is None else start
        if y != x + 1:
            runs.append(f"{re.escape(chr(start))}-{re.escape(chr(x))}")
            start = None
    return re.compile(f"[{''.join(runs)}]+"), plain | dict.fromkeys(INVISIBLE)


def _seconds() -> frozenset[int]:
    """Code points that are the second part of a canonical decomposition, and the jamo that complete a syllable."""
    out = {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}
    begin = 0
    for a, b in (*STABLE_BLOCKS, (0x110000, 0x110000)):
        for cp in range(begin, a):
            d = unicodedata.decomposition(chr(cp))
            if d and d[0] != "<" and " " in d:
                out.add(int(d.split()[1], 16))
        begin = b + 1
    return frozenset(out)


_SECONDS = _seconds()


_JOINERS = re.compile(f"[{chr(NON_JOINER)}{chr(JOINER)}]")


def _kept(seg: str, i: int, after: str) -> bool:
    """Whether the joiner at seg[i] does something to its neighbours; `after`: the character behind the segment."""
    nxt = seg[i + 1 : i + 2] or after
    if not i or not nxt:
        return False
    if unicodedata.combining(seg[i - 1]) == VIRAMA_CLASS:
        return True
    return ord(seg[i]) == JOINER and ord(nxt) > 0x2190 and unicodedata.category(nxt) == "So"


@lru_cache(maxsize=1 << 16)
def _spliced(seg: str) -> str:
    """Canonical form of one segment with its context: invisible characters out, plain forms in, composed."""
    return unicodedata.normalize("NFC", seg.translate(_tables()[1]))


def _with_joiners(seg: str, after: str) -> str:
    plain = _tables()[1]
    return unicodedata.normalize("NFC", "".join(ch if ord(ch) in (JOINER, NON_JOINER) and _kept(seg, i, after) else ch.translate(plain) for i, ch in enumerate(seg)))


_FOREIGN = re.compile("[" + "".join(sorted(_IMITATES)) + "]")
#: Scripts whose letters make one word with Latin ones; those of others (of spaceless scripts) end it.
_ALPHABETS = frozenset({"LATIN", *map(_script, _IMITATES)})


def _of_word(ch: str) -> bool:
    return ch.isascii() and ch.isalpha() or _script(ch) in _ALPHABETS or unicodedata.combining(ch) > 0


def _latinise(text: str) -> str:
    """Replace imitating letters where the writing is Latin: in a word that also has Latin letters, or in a
    word made up of imitations in a text with no letter that only the other script has."""
    genuine = {_script(ch) for ch in set(text) if not ch.isascii() and ch not in _IMITATES} & (_ALPHABETS - {"LATIN"})
    out, at = [], 0
    for m in _FOREIGN.finditer(text):
        if m.start() < at:
            continue
        a, b = m.start(), m.end()
        while a > at and _of_word(text[a - 1]):
            a -= 1
        while b < len(text) and _of_word(text[b]):
            b += 1
        w = text[a:b]
        scripts = {_script(c) for c in w if c in _IMITATES}
        own = {_script(c) for c in w if c not in _IMITATES} - {""}
        if own <= {"LATIN"} and ("LATIN" in own or not scripts & genuine):
            w = "".join(_IMITATES.get(c, c) for c in w)
        out += [text[at:a], w]
        at = b
    out.append(text[at:])
    return "".join(out)


def canonical(text: str | None) -> str | None:
    """The consistent form of a text. Null stays null; '' stays ''; ASCII text is returned as it is."""
    if text is None or text.isascii():
        return text
    joiners = _JOINERS.search(text)
    out, at = [], 0
    for m in _tables()[0].finditer(text):
        a, b = m.span()
        if a > at and not text[a - 1].isspace():
            a -= 1  # the starter that the run may compose with
        seg = text[a:b]
        out += text[at:a], _with_joiners(seg, text[b : b + 1]) if joiners and _JOINERS.search(seg) else _spliced(seg)
        at = b
    if not at:
        return text
    out.append(text[at:])
    done = "".join(out)
    return _latinise(done) if _FOREIGN.search(done) else done


_NOT_WORD = regex.compile(r"[^\p{L}\p{M}\p{N}]+")  # vowel signs and accents belong to their letters


def match_key(text: str | None) -> str | None:
    """Canonical form without case and everything but letters and digits; null if nothing is left."""
    if text is None:
        return None
    k = _NOT_WORD.sub("", canonical(text).casefold())
    return k if any(map(str.isalnum, k)) else None


@F.pandas_udf(T.StringType())
def _canonical_udf(s: pd.Series) -> pd.Series:
    known: dict[str, str] = {}
    return s.map(lambda t: None if t is None else known[t] if t in known else known.setdefault(t, canonical(t)))


@F.pandas_udf(T.StringType())
def _key_udf(s: pd.Series) -> pd.Series:
    known: dict[str, str | None] = {}
    return s.map(lambda t: None if t is None else known[t] if t in known else known.setdefault(t, match_key(t)))


def canonical_column(text: Column) -> Column:
    """canonical() as a column. Plain ASCII stays in the JVM; Python sees null for it."""
    plain = text.rlike(r"\A\p{ASCII}*\z")
    return F.when(plain, text).otherwise(_canonical_udf(F.when(~plain, text)))


def key_column(text: Column) -> Column:
    """match_key() as a column, with the same split."""
    plain = text.rlike(r"\A\p{ASCII}*\z")
    simple = F.regexp_replace(F.lower(text), "[^a-z0-9]+", "")
    return F.when(plain, F.nullif(simple, F.lit(""))).otherwise(_key_udf(F.when(~plain, text)))


def canonicalize(df: DataFrame, column: str, into: str) -> DataFrame:
    """df with the consistent form of `column` in `into` (which may be `column`).

    Nulls stay null, empty texts empty, rows that repeat are kept, other columns untouched."""
    return df.withColumn(into, canonical_column(F.col(column)))


def look_alike_classes(df: DataFrame, group: list[str], text: str, key: str | None = None) -> DataFrame:
    """(group, key, text, class BIGINT, spelling BIGINT, spellings, rows): every row whose text has a look-alike stored differently in
    its group, with its class (all that look the same), its spelling, and how many different spellings and rows the class has.

    `key`: column that names a row; None: the stored text itself. Rows with null or blank text, or null key, are in no class.
    Spellings are found before rows meet them, so a text that recurs is one row a task."""
    src = df.select(*group, F.col(text).alias("text"), F.col(key or text).cast("string").alias("key")).where("text IS NOT NULL AND key IS NOT NULL").distinct()
    per = src.groupBy(*group, "text").agg(F.count("*").alias("n")) if key else src.select(*group, "text", F.lit(1).cast("bigint").alias("n"))
    per = per.withColumn("__c", squash(canonical_column(F.col("text")))).where("__c <> ''")
    names = [f"__g{i}" for i in range(len(group))]
    classes = per.groupBy(*[F.col(g).alias(n) for g, n in zip(group, names, strict=True)], F.col("__c").alias("__cc")).agg(F.count("*").alias("spellings"), F.sum("n").alias("rows")).where("spellings > 1")
    hit = per.join(classes, _same(group, "__c", "__cc")).select(*group, "text", F.xxhash64(*group, "__c").alias("class"), F.xxhash64("text").alias("spelling"), "spellings", "rows")
    if not key:
        return hit.withColumn("key", F.col("text"))
    side = hit.select(*[F.col(g).alias(n) for g, n in zip(group, names, strict=True)], F.col("text").alias("__t"), "class", "spelling", "spellings", "rows")
    return src.join(side, _same(group, "text", "__t")).select(*group, "key", "text", "class", "spelling", "spellings", "rows")


def look_alike_pairs(df: DataFrame, group: list[str], text: str, key: str | None = None) -> DataFrame:
    """Pairs (key_1 < key_2 by code point) within a group that look the same but are stored differently.

    Every member of a class is paired with those of its other spellings, never with those of its own; where that is too much
    (one text stored many times in two ways), look_alike_classes() says the same in one row a member.  Rows
    with null or blank text, or null key, have no pair."""
    hit = look_alike_classes(df, group, text, key).select(*group, "key", "class", "spelling")
    names = [f"__g{i}" for i in range(len(group))]
    other = hit.select(*[F.col(g).alias(n) for g, n in zip(group, names, strict=True)], F.col("class").alias("__cc"), F.col("key").alias("__k2"), F.col("spelling").alias("__s2"))
    on = _same(group, "class", "__cc") & (F.col("key") < F.col("__k2")) & (F.col("spelling") != F.col("__s2"))
    return hit.join(other, on).select(*group, F.col("key").alias("key_1"), F.col("__k2").alias("key_2")).distinct()


def squash(c: Column) -> Column:
    """What a reader sees of white space: none at the ends, one blank inside."""
    return F.trim(F.regexp_replace(c, r"[\s\u0085\u2028\u2029]+", " "))


def _same(group: list[str], left: str, right: str) -> Column:
    cond = F.col(left) == F.col(right)
    for i, g in enumerate(group):
        cond = cond & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    return cond
