"""Sentence units of texts in many languages and scripts (problem 1).

Spaceless scripts: clauses are segmented by a dictionary word lattice (least cost path through words counted in the corpus, function
words and unknown characters); a gap, behind a terminator, at a blank or with no mark at all, is then classified by the final
particle before it and the opening word after it.  Spaced scripts: every terminator opens a fork in a lattice whose nodes are
the places where a unit can begin; its readings (end, abbreviation, initial, number, clock time, enumerator, aside,
speech with attribution) cost what they are worth in their context, and the cheapest path from the first node to the end of the text
gives the units.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Mapping
from bisect import bisect_left, bisect_right
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonograin.llm.canon import INVISIBLE_RANGES, canonical

UNITS = T.ArrayType(T.StructType([T.StructField("char_start", T.IntegerType()), T.StructField("char_end", T.IntegerType())]))

# Marks.
TERMINATORS = ".!?…。！？｡．؟۔।॥‼⁇⁈⁉។៕။།።։"
CLOSERS = "”’»›」』）】〉》)]}\"'＂＇］｝"
OPENERS = "“‘«‹「『（【〈《([{¿¡„‚—–-\"'＂［｛"
DASHES = "—–-"
CASELESS_LANGS = ("ar", "hi", "th", "zh", "ja", "ko", "fa", "ur", "he", "bn", "ta", "te", "km", "lo", "my", "bo", "am")
# Languages written without spaces between words: gaps behind terminators, gaps at blanks.
SPACELESS, BLANK_GAPS = ("zh", "ja", "km", "my", "bo"), ("th", "lo")
# Abbreviations by how what follows is read.  `title`: a name follows; `number`: a number
# follows; `inner`: never last in a sentence; `either`: last in a sentence if a capital follows.
ABBREVIATIONS = {
    "en": {
        "title": "mr mrs ms dr prof capt lt rev gen col sgt maj hon pres gov sen rep mt ft st cpl cmdr adm fr sr jr messrs mme mlle",
        "number": "no nos vol vols fig figs ch chap sec p pp pg art eq ed par app ex",
        "inner": "vs e.g i.e cf viz esp approx ca al resp incl eg ie",
        "either": "etc co inc ltd corp bros dept est ave blvd jan feb mar apr jun jul aug sept oct nov dec u.s u.k",
    },
    "de": {"title": "hr fr dr prof st frl ing dipl herr", "number": "nr s bd abb kap art", "inner": "z.b d.h u.a ca bzw vgl z b d h u a evtl ggf inkl sog o.ä usf", "either": "usw etc"},
    "fr": {"title": "m mm mme mlle dr pr st ste mgr me", "number": "p pp n vol fig chap art", "inner": "cf env c.-à-d ex p.ex", "either": "etc"},
    "es": {"title": "sr sra srta dr dra d dña da prof sto sta ud uds", "number": "pág págs p núm vol fig cap art", "inner": "p.ej ej aprox cf vs", "either": "etc"},
    "hi": {"title": "श्री डॉ श्रीमती प्रो सुश्री पं", "number": "सं पृ", "inner": "", "either": ""},
    "ar": {"title": "د أ م ص السيد ا", "number": "ص رقم", "inner": "", "either": ""},
}
# Months, after which a day number's point is an ordinal mark.
MONTHS_DE = frozenset("januar februar märz april mai juni juli august september oktober november dezember".split())
# Openings of a phrase that a clock time at the start of a sentence belongs to.
TIME_OPENINGS = frozenset("at by around about near until till before after from since toward towards um gegen à vers a hacia".split())
# Reporting verbs that close an attribution after quoted speech.
REPORTING = {
    "zh": "说道 问道 喊道 叫道 答道 说 问 喊 叫 答 回答 低声说 大声说 解释道 补充道 嚷道 說 說道 問 問道",
    "hi": "पूछा कहा बोला बोली बोले चिल्लाया चिल्लाई पुकारा बताया",
    "ja": "と って という とは",
    "ar": "قال قالت سأل سألت صاح صاحت أجاب أجابت هتف",
    "th": "ถาม พูด กล่าว ตอบ ตะโกน ว่า",
}
# Words that end like a reporting word and are none.
COMPOUNDS = {"zh": "隧道 街道 通道 轨道 频道 渠道 知道 味道 车道 河道 访问 疑问 学问 顾问 小说 传说 听说 据说 呼喊 呼叫 解答 报答"}
# Words that open a continuation in spaceless scripts.
CONTINUES = {
    "ja": "と って という とは が は を に の も から ので けど けれど けれども し のに ものの て で な なら ば そう よう ん ことが こと",
    "zh": "", "th": "และ แต่ หรือ ซึ่ง ที่ว่า เพราะ ว่า ก็ โดย จึง", "lo": "ແລະ ແຕ່ ຫຼື ເພາະ ວ່າ ກໍ ໂດຍ ຈຶ່ງ",
}
# Particles that close a sentence even where no mark follows; in Japanese behind one of the polite endings.
FINAL = {"zh": "吗 呢 吧 啊 呀 嘛 啦", "ja": "か ね よ よね かな", "th": "ครับ ค่ะ คะ นะ จ้ะ สิ ล่ะ", "lo": "ຄັບ ເດີ ບໍ ເນາະ"}
POLITE = "です でした ます ました ません でしょう ましょう"
# Words that open a sentence.
OPENS = {"zh": "我 你 您 他 她 它 我们 你们 他们 她们 它们 咱们 这 那 这个 那个 这里 那里 今天 明天 昨天 现在 但是 可是 不过 所以 因为 如果 然后 于是 谁 怎么 为什么 请 别"}
# Measure words that keep a number and what follows together.
MEASURES = {"th": "บาท น นาฬิกา โมง ปี วัน เดือน คน เล่ม หน้า กิโลกรัม เมตร"}

_INVISIBLE = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in INVISIBLE_RANGES) + "]")
_CANDIDATE = re.compile(f"[{re.escape(TERMINATORS)}]+")
_THAI_GAP = re.compile(r"(?<=\S)\s+(?=\S)")
# A speaker's name and a reporting verb right after quoted speech.
_NAMED_SPEAKER = re.compile(r"\s*[^\W\d_a-z][\w’'-]*(?:\s[^\W\d_a-z][\w’'-]*)?\s(?:said|asked|cried|replied|answered|shouted|exclaimed|demanded)\b")
_CJK_STOP = frozenset("。！？｡．‼⁇⁈⁉…")


#: Costs in the word lattice: a function word, a word counted in the corpus, an unknown character.
FUNCTION_COST, CORPUS_COST, UNKNOWN_COST = 1.0, 1.4, 2.5


class WordLattice:
    """Least-cost segmentation of a clause into words of a dictionary and unknown characters."""

    def __init__(self, words: Iterable[str], counted: Iterable[str] = ()) -> None:
        self.cost = dict.fromkeys(counted, CORPUS_COST) | dict.fromkeys(words, FUNCTION_COST)
        self.longest = max(map(len, self.cost), default=1)

    def segment(self, text: str) -> list[str]:
        best: list[tuple[float, int]] = [(0.0, 0)]
        for j in range(1, len(text) + 1):
            cost, at = best[j - 1][0] + UNKNOWN_COST, j - 1
            for i in range(max(0, j - self.longest), j):
                word = self.cost.get(text[i:j])
                if word is not None and best[i][0] + word < cost:
                    cost, at = best[i][0] + word, i
            best.append((cost, at))
        out, j = [], len(text)
        while j:
            i = best[j][1]
            out.append(text[i:j])
            j = i
        return out[::-1]


def _finals(lang: str) -> frozenset[str]:
    """Final particles as words of the lattice; in Japanese with the polite ending they need."""
    marks = FINAL.get(lang, "").split()
    return frozenset(p + m for p in POLITE.split() for m in ["", *marks]) if lang == "ja" else frozenset(marks)


def function_words(lang: str) -> frozenset[str]:
    """All words of the tables, and what they are made up to, that the lattice of a language knows by itself."""
    tables = (REPORTING, COMPOUNDS, CONTINUES, FINAL, MEASURES, OPENS)
    return frozenset(w for t in tables for w in t.get(lang, "").split()) | _finals(lang)


#: Longest word that is counted, least share of a language's stretches of one length that a word must have (so at most
#: 1 / SHARE words of a length are kept), and how much more often its parts meet than by chance.
LONGEST, SHARE, COHESION = 4, 1 / 10_000, 30.0
# Blocks of the scripts without spaces; the language that one stands for where none is given.
BLOCKS_OF = {"ja": "\\u3040-\\u30ff", "zh": "\\u3400-\\u9fff", "th": "\\u0e00-\\u0e7f", "lo": "\\u0e80-\\u0eff", "km": "\\u1780-\\u17ff", "my": "\\u1000-\\u109f", "bo": "\\u0f00-\\u0fff"}
_SCRIPTS = "".join(BLOCKS_OF.values())


def corpus_words(df: DataFrame, text: str) -> dict[str, list[str]]:
    """Words of the spaceless languages, counted over all rows (the language of a row by its script): stretches of 2 to LONGEST
    characters that are frequent and whose parts meet far more often than by chance.  What begins or ends with a function word is none.

    At most LONGEST / SHARE stretches a language come to the driver. No rows of such a language: no words."""
    t = F.col(text)
    code = reduce(lambda c, x: c.when(t.rlike(f"[{x[1]}]"), x[0]), BLOCKS_OF.items(), F)
    rows = df.where(t.rlike(f"[{_SCRIPTS}]")).select(code.alias("g"), t.alias("t"))
    runs = rows.select("g", F.explode(F.regexp_extract_all("t", F.lit(f"([{_SCRIPTS}]+)"))).alias("r")).select("g", F.split("r", "").alias("c"))

    def stretches(n: int) -> Column:
        cut = F.transform(F.slice("c", 1, F.size("c") - (n - 1)), lambda c, i: F.concat(c, *[F.col("c")[i + k] for k in range(1, n)]))
        return F.when(F.size("c") >= n, cut).otherwise(F.array().cast("array<string>"))

    grams = F.flatten(F.array(*[stretches(n) for n in range(1, LONGEST + 1)]))
    counts = runs.select("g", F.explode(grams).alias("w")).groupBy("g", "w").agg(F.count("*").alias("n"))
    sums = counts.groupBy("g", F.length("w").alias("l")).agg(F.sum("n").alias("total"))
    totals = sums.agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(":", "g", "l"), "total")))).scalar()
    often = counts.where(F.col("n") >= SHARE * F.try_element_at(totals, F.concat_ws(":", "g", F.length("w"))))
    seen: dict[str, dict[str, int]] = defaultdict(dict)
    for g, w, n in often.collect():
        seen[g][w] = n
    out: dict[str, list[str]] = {}
    for g, count in seen.items():
        own = function_words(g)
        every = sum(n for w, n in count.items() if len(w) == 1)
        edge = lambda w, own=own: any(w.startswith(x) or w.endswith(x) for x in own)
        bound = lambda w, n, c=count, e=every: all(n * e >= COHESION * c.get(w[:i], n) * c.get(w[i:], n) for i in range(1, len(w)))
        out[g] = sorted(w for w, n in count.items() if len(w) > 1 and bound(w, n) and not edge(w))
    return out


class Lattices:
    """A lattice a language, made when it is first asked for."""

    def __init__(self, counted: Mapping[str, Iterable[str]] | None = None) -> None:
        self.counted = counted or {}
        self.made: dict[str, WordLattice] = {}

    def __getitem__(self, lang: str) -> WordLattice:
        if lang not in self.made:
            self.made[lang] = WordLattice(function_words(lang), self.counted.get(lang, ()))
        return self.made[lang]


_PLAIN = Lattices()


def guess_lang(text: str) -> str:
    """Language by script, for texts whose language is not given."""
    for lo, hi, lang in (("ぁ", "ヿ", "ja"), ("\u0e00", "\u0e7f", "th"), ("\u0e80", "\u0eff", "lo"), ("\u1780", "\u17ff", "km"), ("\u1000", "\u109f", "my"), ("\u0f00", "\u0fff", "bo"), ("؀", "ۿ", "ar"), ("ऀ", "ॿ", "hi")):
        if any(lo <= c <= hi for c in text):
            return lang
    return "zh" if any("一" <= c <= "鿿" for c in text) else "en"


_CLAUSE = re.compile(r"\s*([^，。！？；：“”「」『』、,.!?;:\n]+)")
_HINDI_CLAUSE = re.compile(r"\s*([^।!?“”]+)")
_FIRST_WORD = re.compile(r"\s*(\S+)")
_LETTERS = re.compile(r"\w+")
_ROMAN = re.compile(r"[IVXLC]+\b")
_LETTER_POINT = re.compile(r"\w\.")


def _attributed_zh(text: str, at: int, lattices: Lattices) -> bool:
    """Whether what follows a closing quote is its attribution: a clause that ends in a reporting word."""
    m = _CLAUSE.match(text, at)
    return bool(m) and lattices["zh"].segment(m.group(1))[-1] in REPORTING["zh"].split()


def _attributed_hi(text: str, at: int) -> bool:
    m = _HINDI_CLAUSE.match(text, at)
    words = m.group(1).split() if m else []
    return bool(words) and words[-1] in REPORTING["hi"].split()


@lru_cache(maxsize=8)
def _places(text: str, mark: str) -> list[int]:
    """Where a quotation mark stands in the text; of ' only what is no apostrophe within a word."""
    return [m.start() for m in re.finditer(r"(?<!\w)'|'(?!\w)" if mark in "'＇" else re.escape(mark), text)]


def _before(text: str, upto: int, mark: str) -> int:
    return bisect_left(_places(text, mark), upto)


def _quoted(text: str, upto: int, mark: str) -> bool:
    """Whether a straight mark at `upto` closes: an odd number of such marks stands before it."""
    return _before(text, upto, mark) % 2 == 1


def _closing_run(text: str, at: int, lang: str) -> int:
    """End of the closing marks that belong to a terminator ending at `at`."""
    j = at
    while j < len(text):
        c = text[j]
        k = j
        if c in " \xa0\u202f\u2009" and lang == "fr":  # French sets a space before » and ! ?
            k = j + 1
            if k < len(text) and text[k] in "»!?":
                j = k + 1
                continue
            break
        if c in "\"'＂＇":
            if not _quoted(text, j, c):
                break
        elif c == "“":
            if lang != "de" and not (_before(text, j, "„") > _before(text, j, "“")):
                break
        elif c == "«":
            if lang == "fr" or _before(text, j, "»") <= _before(text, j, "«"):
                break
        elif c == "»":
            if lang == "de" and _before(text, j, "»") <= _before(text, j, "«"):
                break
        elif c not in CLOSERS and c not in TERMINATORS:
            break
        j += 1
    return j


_WORD_EDGE = re.compile(r"[\s“\"'‘(（\[«„—–!?…]")
_ACRONYM = re.compile(r"(?<![^\s“\"'‘(（\[«„—–!?…])(?:\w\.)+")


@lru_cache(maxsize=8)
def _edges(text: str) -> list[int]:
    return [m.end() for m in _WORD_EDGE.finditer(text)]


@lru_cache(maxsize=8)
def _acronyms(text: str) -> tuple[list[int], list[int]]:
    """Where letters that each have a point begin and end."""
    spans = [m.span() for m in _ACRONYM.finditer(text)]
    return [x for x, _ in spans], [y for _, y in spans]


def _in_acronym(text: str, begin: int, a: int, b: int) -> bool:
    """Whether the point text[a:b] is the second or a later one of an acronym that begins at `begin`."""
    starts, ends = _acronyms(text)
    k = bisect_right(starts, a) - 1
    return k >= 0 and begin <= starts[k] <= a - 3 and b <= ends[k]


def _word_start(text: str, at: int, unit: int) -> int:
    """Where the word that ends at `at` begins."""
    places = _edges(text)
    k = bisect_right(places, at)
    return max(unit, places[k - 1] if k else 0)


@lru_cache(maxsize=16)
def _abbreviations(lang: str) -> tuple[dict[str, str], int]:
    """Abbreviations of a language with how what follows is read, and the length of the longest."""
    table = ABBREVIATIONS.get(lang, {} if lang in CASELESS_LANGS else ABBREVIATIONS["en"])
    kinds = {w: kind for kind in ("either", "number", "title", "inner") for w in table.get(kind, "").split()}
    return kinds, max([len("a.m"), *map(len, kinds)])


def _costs(text: str, unit: int, a: int, b: int, c: int, lang: str) -> tuple[float, float, bool]:
    """Cost of the readings `end` and `no end` of the terminators text[a:b] whose closing marks end at c, in a unit that begins at
    `unit`; and whether that depends on where the unit begins."""
    run, nxt = text[a:b], c
    while nxt < len(text) and text[nxt].isspace():
        nxt += 1
    spaced = nxt > c
    first = nxt
    while first < len(text) and (text[first] in OPENERS or text[first].isspace()):
        first += 1
    if first >= len(text):
        return (0.0, 1.0, False) if nxt >= len(text) else (1.0, 0.0, False)
    ch = text[first]
    cased = lang not in CASELESS_LANGS
    # a letter without case opens a unit like a capital
    opens = not cased or ch.isupper() or ch.istitle() or ch.isdigit() or (ch.isalpha() and not ch.islower())
    if not opens or text[nxt] in ",;:，；：、،":
        return 3.0, 0.0, False
    closed = c > b
    if closed and cased and run[0] in "!?" and _NAMED_SPEAKER.match(text, c):
        return 3.0, 0.0, False
    if closed and lang == "hi" and _attributed_hi(text, c):
        return 3.0, 0.0, False
    if closed and lang == "ar" and (m := _FIRST_WORD.match(text, c)) and m.group(1) in REPORTING["ar"].split():
        return 3.0, 0.0, False
    depends = False
    if closed and text[c - 1] in ")]）】" and run != "." and not ch.isupper():
        depends = True
        if _before(text, c, text[c - 1]) - _before(text, unit, text[c - 1]) == 1 and text[unit] not in "([（【":
            return 2.0, 0.0, True  # an aside within the unit
    if run[0] in ".．" and len(run) == 1 and not closed:
        if not spaced and ((text[nxt].isdigit() and a and text[a - 1].isdigit()) or (not (ch.isupper() and cased) and text[first].isascii())):
            return 3.0, 0.0, depends
        kinds, longest = _abbreviations(lang)
        begin = _word_start(text, a, unit)
        # look-alike writing may take more characters than it stands for
        word = canonical(text[begin:a]).lower() if a - begin <= 4 * longest else ""
        if word in ("a.m", "p.m"):
            so_far = text[unit:a].lstrip(OPENERS + " \n").split(None, 3)
            leads = 0 < len(so_far) <= 3 and (canonical(so_far[0]).lower() in TIME_OPENINGS or so_far[0][0].isdigit())
            return (2.0, 0.0, True) if leads else (0.0, 2.0, True)
        if not spaced and word and _LETTER_POINT.match(text, b) and (_in_acronym(text, begin, a, b) if len(word) > 1 else word.isalpha()):
            return 3.0, 0.0, depends  # within an abbreviation of single letters
        kind = kinds.get(word)
        if kind in ("inner", "title"):
            return 3.0, 0.0, depends
        if kind == "number":
            return (3.0, 0.0, depends) if ch.isdigit() or _ROMAN.match(text, first) else (0.5, 1.0, depends)
        if kind == "either":
            return (0.0, 1.0, depends) if ch.isupper() else (2.0, 0.0, depends)
        if len(word) == 1 and word.isalpha() and text[a - 1].isupper() and word != "i":
            return 3.0, 0.0, depends  # an initial
        if (not spaced or not ch.isupper()) and _in_acronym(text, begin, a, b):
            return 3.0, 0.0, depends  # within or after an acronym
        if word.isdigit() and len(word) <= 2:
            month = _LETTERS.match(text, first) if lang == "de" else None
            if month and canonical(month.group()).lower() in MONTHS_DE:
                return 3.0, 0.0, depends
            if spaced and text[unit:begin].strip() == "" and a - begin <= 2:
                return 3.0, 0.0, True  # an enumerator opens the unit
            depends = True
        if lang == "hi" and word and not word.isdigit() and len(word) <= 2:
            return 3.0, 0.0, depends
    elif not spaced and not closed and text[nxt].isascii() and not ch.isupper() and cased:
        return 3.0, 0.0, depends
    if not spaced and ch.isdigit() and text[c - 1] in ".．":
        return 3.0, 0.0, depends
    return 0.0, 1.0, depends


#: What a path may cost more than the cheapest one and still be followed.
SLACK = 2.5


def _spaced_gaps(text: str, lang: str) -> list[int]:
    """Cheapest path through the lattice of terminators: a node is a place where a unit begins; a node's path is the chain of ends."""
    paths: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    last = -1
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        if b <= last:
            continue
        c = last = _closing_run(text, b, lang)
        if c >= len(text):
            break
        local, ended, on = None, None, {}
        for unit, (cost, path) in sorted(paths.items(), key=lambda x: x[1][0]):
            if local is None or local[2]:
                local = _costs(text, unit, a, b, c, lang)
            if ended is None or cost + local[0] < ended[0]:
                ended = (cost + local[0], (c, path))
            on[unit] = (cost + local[1], path)
        begin = c
        while begin < len(text) and text[begin].isspace():
            begin += 1
        least = min(ended[0], *(x[0] for x in on.values()))
        paths = {u: x for u, x in on.items() if x[0] <= least + SLACK}
        if ended[0] <= least + SLACK:
            paths[begin] = ended
    path = min(paths.values(), key=lambda x: x[0])[1]
    ends: list[int] = []
    while path:
        ends.append(path[0])
        path = path[1]
    return ends[::-1]


def _marked_gaps(text: str, lang: str, lattices: Lattices) -> list[int]:
    """Gaps behind terminators of a spaceless script."""
    ends, last = [], -1
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        if b <= last:
            continue
        run = text[a:b]
        if run[0] in ".!?" and not any(x in _CJK_STOP for x in run):
            before, after = text[a - 1 : a], text[b : b + 1]
            if (before.isascii() and before.isalnum() and after.isascii() and after.isalnum()) or (after and not after.isspace() and run[0] == "." and after.isascii()):
                continue
        if set(run) <= {"…", "."} and len(run) > 1 or run == "…":
            continue  # a pause, not an end
        c = b
        while c < len(text) and (text[c] in CLOSERS and (text[c] not in "\"'" or _quoted(text, c, text[c])) or text[c] in TERMINATORS):
            c += 1
        last = c
        nxt = c
        while nxt < len(text) and text[nxt].isspace():
            nxt += 1
        if nxt >= len(text):
            break
        if text[nxt] in "，、；：,;:":
            continue
        inside = text[b:c]
        if inside and inside[-1] in ")）】]" and nxt == c and text[nxt] not in OPENERS:
            # a bracketed aside within a sentence, unless the bracket opened the unit
            opened = max(text.rfind("（", 0, a), text.rfind("(", 0, a))
            if opened > 0 and text[opened - 1] not in TERMINATORS and not text[opened - 1].isspace():
                continue
        if inside and any(x in "”’」』\"" for x in inside):
            if lang == "zh" and _attributed_zh(text, c, lattices):
                continue
            clause = _CLAUSE.match(text, c) if lang == "ja" else None
            if clause and lattices["ja"].segment(clause.group(1))[0] in REPORTING["ja"].split():
                continue
        ends.append(c)
    return ends


@lru_cache(maxsize=8)
def _final_pattern(lang: str) -> re.Pattern:
    return re.compile("(?:" + "|".join(sorted(map(re.escape, _finals(lang)), key=len, reverse=True)) + r")(?=\w)")


_RUN = re.compile(r"\w+")


def _unmarked_gaps(text: str, lang: str, lattices: Lattices) -> list[int]:
    """Gaps without a mark: behind a final particle that is a word of its own, where what follows opens a sentence."""
    finals, opens, goes_on = _finals(lang), OPENS.get(lang, "").split(), CONTINUES.get(lang, "").split()
    ends = []
    for m in _RUN.finditer(text) if finals and _final_pattern(lang).search(text) else ():
        if not _final_pattern(lang).search(m.group()):
            continue
        at, words = m.start(), lattices[lang].segment(m.group())
        for word, after in zip(words, words[1:], strict=False):
            at += len(word)
            if word in finals and (after in opens if opens else not any(after.startswith(x) for x in goes_on)):
                ends.append(at)
    return ends


def _blank_gaps(text: str, lang: str, lattices: Lattices) -> list[int]:
    """Gaps at blanks, where a script sets its sentences apart by them."""
    measures, goes_on, finals = (t.get(lang, "").split() for t in (MEASURES, CONTINUES, FINAL))
    parts = [(m.start(), m.end(), lattices[lang].segment(m.group())) for m in re.finditer(r"\S+", text)]
    ends = []
    for (_, end, words), (start, _, following) in zip(parts, parts[1:], strict=False):
        before, after = text[end - 1], text[start]
        if before.isdigit() and not after.isdigit():
            held = following[0] in measures
        else:
            held = after.isdigit() or (after in CLOSERS and after not in "\"'") or (before in OPENERS and before not in "\"'")
        if not held and not (following[0] in goes_on and words[-1] not in finals):
            ends.append(end)
    return ends


def sentence_spans(text: str | None, lang: str | None = None, heading: bool = False, lattices: Lattices = _PLAIN) -> list[tuple[int, int]]:
    """Spans of the sentence units in code points of `text`, end exclusive, without outer blanks.

    Null and blank texts have none. A heading is one unit. `lang` unknown: judged by script. `lattices`: with the words
    counted in the corpus; else they know function words only."""
    if not text:
        return []
    if _INVISIBLE.search(text):
        place = [i for i, ch in enumerate(text) if not _INVISIBLE.match(ch)]
        clean = "".join(text[i] for i in place)
    else:
        place, clean = None, text
    if not clean.strip():
        return []
    lang = (lang or "").lower()[:2] or guess_lang(clean)
    if heading:
        ends = []
    elif lang in SPACELESS:
        ends = sorted({*_marked_gaps(clean, lang, lattices), *_unmarked_gaps(clean, lang, lattices)})
    elif lang in BLANK_GAPS:
        ends = _blank_gaps(clean, lang, lattices)
    else:
        ends = _spaced_gaps(clean, lang)
    out, at = [], 0
    for e in [*ends, len(clean)]:
        a, b = at, e
        while a < b and clean[a].isspace():
            a += 1
        while b > a and clean[b - 1].isspace():
            b -= 1
        if b > a:
            out.append((place[a], place[b - 1] + 1) if place else (a, b))
        at = e
    return out


def sentence_units(text: Column, lang: Column, heading: Column, words: dict[str, list[str]] | None = None) -> Column:
    """Column of the units' spans; empty for null and blank texts. `words`: of corpus_words(), bounded by it."""
    made: list[Lattices] = []

    @F.pandas_udf(UNITS)
    def units(text: pd.Series, lang: pd.Series, heading: pd.Series) -> pd.Series:
        if not made:
            made.append(Lattices(words))
        return pd.Series([
            [{"char_start": a, "char_end": b} for a, b in sentence_spans(t, g, bool(h), made[0])]
            for t, g, h in zip(text, lang, heading, strict=True)
        ])

    return units(text, lang, F.coalesce(heading, F.lit(False)))


def split_sentences(df: DataFrame, text: str, lang: str | None = None, heading: str | None = None, words: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per sentence unit: df's columns with char_start, char_end (these replace columns of that name).

    Repeated rows are split each; rows without units vanish. `words`: of corpus_words()."""
    none = F.lit(None).cast("string")
    spans = sentence_units(F.col(text), F.col(lang) if lang else none, F.col(heading) if heading else F.lit(False), words)
    return (
        df.drop("char_start", "char_end")
        .withColumn("__u", F.explode(spans))
        .select("*", F.col("__u.char_start").alias("char_start"), F.col("__u.char_end").alias("char_end"))
        .drop("__u")
    )
