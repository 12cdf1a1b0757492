"""Defects of prompt and response pairs, here a text and its Chinese rendering (problem 7).

Copies: the response is compressed with the prompt as zstandard dictionary; what costs far fewer bytes than
on its own repeats the prompt.  Refusals and stand-ins: dictionaries.  Language: scripts, and for what is written in Han alone a
dictionary of the pairs of characters that Chinese renderings hold, and function words.  Truncation: a terminal-context model says how
often two characters end a rendering when they occur; and the sentence units of both sides say whether later sentences are missing.
Dictionary and model are counted over all pairs.
"""

from __future__ import annotations

import re

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonograin.llm.canon import canonical
from sonograin.llm.sentences import sentence_spans
from sonograin.tables import rebalance

# What stands in for a missing value (letters and digits only, lower case).
STAND_INS = frozenset("na nan none null nil todo tbd tba undefined empty missing blank untranslated fixme xxx unknown 无 暂无 空 缺 略 待译 待翻译 未翻译 待补 没有 翻译 译文".split())
# How a task is declined, by language: (what is said of oneself, what the task is about).
REFUSALS = tuple(
    (re.compile(a, re.I), re.compile(b, re.I)) for a, b in (
        (r"(?:抱歉|对不起|對不起|遗憾|您好|作为.{0,6}(?:人工智能|AI|语言模型|助手)|恕我|不好意思|我).{0,24}?(?:无法|無法|不能|不便|拒绝|拒絕|难以|不可以)", r"翻译|翻譯|协助|提供|处理|内容|材料|请求|文本|文字"),
        (r"\b(?:can(?:no|')t|cannot|can not|unable to|won't|will not|must decline|have to decline|decline to|not able to|refuse to|not comfortable)\b", r"\b(?:translat\w*|render|assist|content|passage|material|request\w*|provide)\b"),
        (r"\bas an? (?:ai|language model|assistant)\b", r"."),
        (r"\b(?:kann|können|darf|möchte)\b.{0,60}\bnicht\b|\bleider\b", r"übersetz|Anfrage|Inhalt|helfen|Text"),
        (r"\b(?:désolé|je ne (?:peux|suis)|impossible)\b", r"tradui|demande|contenu|aider|texte"),
        (r"\b(?:lo siento|no puedo|lamento)\b", r"traduc|solicitud|contenido|ayudar|texto"),
        (r"申し訳|できません|お手伝い", r"翻訳|内容|リクエスト|提供|お応え"),
        (r"죄송|할 수 없", r"번역|요청|내용|제공"),
        (r"извините|к сожалению|не могу", r"перев|запрос|содерж|помочь|текст"),
    )
)
_CLOSING = "。！？!?.．｡”’」』）)】》\"'"
# Marks that leave a sentence open.
_LEFT_OPEN = "—–-―…·~～，、；：,;:“‘「『（(《〈【["
_HAN = re.compile(r"[\u3400-\u9fff\uf900-\ufaff々〇]")
_HAN_RUN = re.compile(r"[\u3400-\u9fff\uf900-\ufaff々〇]+")
_KANA = re.compile(r"[\u3040-\u30ff]")
_FILES = re.compile(r"[!-~]*\w[_.]\w*\d\w*\.\w+[!-~]*|\b(?:[A-Z]\.){1,6}|\b\w*\d\w*\b", re.ASCII)
_PLAIN = re.compile(r"[\W_]+")

#: Share of the bytes on its own up to which a response counts as copied out of the prompt.
COPIED = 0.6
#: Least share of Han among the letters of a Chinese rendering.
CHINESE = 0.35
#: Share of its occurrences from which a pair of characters closes a rendering by standing last, beside the known marks.
CLOSES = 0.5
#: Least share of all pairs of characters that one in the dictionary has: at most 1 / KNOWN of them come to the driver.  Share of known
#: ones under which a response in Han alone, without a function word, is no Chinese, and least pairs to say so.
KNOWN, COVERED, LEAST_PAIRS = 1e-5, 0.3, 6
# Function words of one character in Chinese.
FUNCTION = frozenset("的了是在不他她我你们这那有和着就也都没把被让从对吗呢吧")
#: Rendered length per source character, as a share of the usual one, under which fewer sentences mean missing ones.
SHORT = 1.15


def _packed(data: bytes, prompt: bytes | None, size: int) -> int:
    """Bytes of `data` behind the prompt; window and tables hold all of the `size` bytes of prompt and response."""
    bits = max(11, size.bit_length())
    logs = {"window_log": min(max(17, bits), zstandard.WINDOWLOG_MAX), "hash_log": min(bits + 1, zstandard.HASHLOG_MAX), "chain_log": min(bits + 1, zstandard.CHAINLOG_MAX)}
    params = zstandard.ZstdCompressionParameters(format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False, strategy=zstandard.STRATEGY_BTULTRA, search_log=5, min_match=3, target_length=64, **logs)
    d = zstandard.ZstdCompressionDict(prompt, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if prompt else None
    return len(zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress(data))


def copied_share(prompt: str, response: str) -> float:
    """Bytes of the response compressed with the prompt as dictionary, as a share of its own; 1.0 is none."""
    return _copied(canonical(prompt), canonical(response))


def _copied(prompt: str, response: str) -> float:
    a = _PLAIN.sub(" ", prompt.casefold()).strip().encode()
    b = _PLAIN.sub(" ", response.casefold()).strip().encode()
    if not _HAN.search(prompt):  # a heading put before the copy is no part of it
        b = re.sub(rb" +", b" ", _HAN.sub(" ", b.decode()).strip().encode())
    if len(b) < 4 or len(a) < 8:
        return 0.0 if a == b and b else 1.0
    if len(set(b) & set(a)) < 0.3 * len(set(b)):
        return 1.0
    size = len(a) + len(b)
    alone, fixed = _packed(b, None, size), _packed(b"", None, size)
    return max(0, _packed(b, a, size) - fixed) / max(1, alone - fixed)


def is_refusal(response: str) -> bool:
    """Whether a response (in canonical form) declines the task."""
    r = response.replace("’", "'")
    return any(a.search(r) and b.search(r) for a, b in REFUSALS)


def scripts(response: str) -> tuple[int, int, int]:
    """Letters of a response (in canonical form): Han, kana, all. File names, initials and numbers are left out."""
    r = _FILES.sub(" ", response)
    return len(_HAN.findall(r)), len(_KANA.findall(r)), sum(map(str.isalpha, r))


def is_foreign(response: str, chinese: frozenset[str]) -> bool:
    """Whether a response (in canonical form) is in another language than Chinese, by its scripts and the dictionary."""
    han, kana, letters = scripts(response)
    if kana and kana >= 0.1 * letters or letters and han < CHINESE * letters:
        return True
    pairs = [p for run in _HAN_RUN.findall(response) for p in map("".join, zip(run, run[1:], strict=False))]
    return len(pairs) >= LEAST_PAIRS and FUNCTION.isdisjoint(response) and sum(p in chinese for p in pairs) < COVERED * len(pairs)


def defect(text: str | None, trans: str | None, lang: str | None, closes: frozenset, usual: float | None, chinese: frozenset = frozenset()) -> str | None:
    """The defect of one pair, or None. `usual`: rendered characters per source character in this language; `closes`, `chinese`: of
    rendering_model()."""
    out = canonical(trans).strip() if trans else ""
    plain = _PLAIN.sub("", out).lower()
    if not plain or plain in STAND_INS:
        return "empty"
    src = canonical(text or "").strip()
    han, _, letters = scripts(out)
    if src and han < 0.6 * max(letters, 1) and _copied(src, out) <= COPIED:
        return "copy"
    if is_refusal(out):
        return "refusal"
    if is_foreign(out, chinese):
        return "wrong_language"
    ends = src[-1:]
    finished = ends != "" and ends in "。！？!?.…”’\"»“›)」"
    if not finished:
        return None
    final = out[-1:]
    if final in ".．" and out[-2:-1].isdigit():
        final = out[-2]  # a number that breaks off, no end mark
    elif final not in _LEFT_OPEN and out[-2:] in closes:
        final = "。"
    if final not in _CLOSING and not (final == "…" and ends == "…"):
        return "truncated"
    if usual and len(out) < SHORT * usual * len(src) and len(sentence_spans(out, "zh")) < len(sentence_spans(text, lang)):
        return "truncated"
    return None


def rendering_model(df: DataFrame, trans: str) -> tuple[frozenset[str], frozenset[str]]:
    """(pairs of characters that close a rendering, pairs of Han that Chinese renderings hold), both counted over all renderings.

    A pair closes if it stands last in more than CLOSES of its occurrences, two of them taken off for chance."""
    t = F.rtrim(F.col(trans))
    rows = df.where(F.length(t) >= 2).select(F.split(t, "").alias("c"))  # characters first: a substring would count from the start each time
    cut = F.transform(F.slice("c", 1, F.size("c") - 1), lambda c, i: F.struct(F.concat(c, F.col("c")[i + 1]).alias("g"), (i == F.size("c") - 2).alias("last")))
    grams = rows.select(F.explode(cut).alias("x")).groupBy("x.g").agg(F.count("*").alias("n"), F.count_if("x.last").alias("last"))
    total = grams.agg(F.sum("n")).scalar()
    closes, chinese = set(), set()
    for g, n, last in grams.where(F.col("n") >= KNOWN * total).collect():
        if last > CLOSES * (n + 2):
            closes.add(g)
        if len(_HAN.findall(g)) == 2:
            chinese.add(g)
    return frozenset(closes), frozenset(chinese)


def usual_lengths(df: DataFrame, text: str, trans: str, lang: str) -> DataFrame:
    """(lang, usual DOUBLE): median length of a rendering per source character, over the pairs in Chinese."""
    han = F.length(F.regexp_replace(F.col(trans), r"[^\u3400-\u9fff\uf900-\ufaff]", ""))
    ok = (han > 0.4 * F.length(F.col(trans))) & (F.length(F.col(text)) >= 20)
    return df.where(ok).groupBy(lang).agg(F.percentile_approx(F.length(F.trim(F.col(trans))) / F.length(F.trim(F.col(text))), 0.5, 1000).alias("usual"))


def broken_pairs(df: DataFrame, key: list[str], text: str, trans: str, lang: str, renderings: DataFrame | None = None) -> DataFrame:
    """(key, defect): one row per defective pair, 'empty', 'copy', 'refusal', 'wrong_language' or 'truncated'.

    The first that holds in this order counts.  A null or blank text with a response can only be refused or in
    another language.  Null language: judged by script, its usual length is that of all null ones.
    Repeated rows give repeated results; an empty table gives none.  `renderings`: rows with `trans` to count dictionary and model over;
    default: df (a plain scan of the same rows is cheaper than df behind joins)."""
    closes, chinese = rendering_model(df if renderings is None else renderings, trans)
    usual = usual_lengths(df, text, trans, lang).select(F.col(lang).alias("__l"), "usual")
    src = df.select(*key, F.col(text).alias("__text"), F.col(trans).alias("__trans"), F.col(lang).alias("__lang"))
    src = src.join(usual, F.col("__lang").eqNullSafe(F.col("__l")), "left").select(*key, "__text", "__trans", "__lang", "usual")
    kinds = dict(df.dtypes)
    # the work per byte is high, and the join above leaves few partitions
    src = rebalance(src, *key)

    def run(batches):
        for pdf in batches:
            found = [
                defect(t, x, g, closes, u if u == u else None, chinese)
                for t, x, g, u in zip(pdf["__text"], pdf["__trans"], pdf["__lang"], pdf["usual"], strict=True)
            ]
            out = pdf[key].assign(defect=pd.Series(found, index=pdf.index, dtype=object))
            yield out[out["defect"].notna()]

    return src.mapInPandas(run, ", ".join(f"{k} {kinds[k]}" for k in key) + ", defect string")
