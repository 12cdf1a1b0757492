"""Training-data operators against brute force, exact round trips and pinned cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonograin.llm import canon, leaks, pairs, quality, quantiles, reading, runs, sentences

CASES = [
    ("en", "Dr. Smith arrived. He spoke.", ["Dr. Smith arrived.", "He spoke."]),
    ("en", "At 8.20 a.m. Peltor came. She left before 2 a.m. The door shut.", ["At 8.20 a.m. Peltor came.", "She left before 2 a.m.", "The door shut."]),
    ("en", "“Stop the dog!” cried Ann. “We fed it. They hid,” said Bob.", ["“Stop the dog!” cried Ann.", "“We fed it.", "They hid,” said Bob."]),
    ("en", "“Where is it?” Ann Hill asked. “Here!” They ran.", ["“Where is it?” Ann Hill asked.", "“Here!”", "They ran."]),
    ("en", "One bell rang.The cost was $3.50.Mrs. Hill saw track_3.mp3.", ["One bell rang.", "The cost was $3.50.", "Mrs. Hill saw track_3.mp3."]),
    ("en", "M. C. Osb (what a fool!) waited ... and left Mt. Vel, cf. pp. 6–9. The O.R.T. office shut, ropes, etc. Fig. 8 showed it.", ["M. C. Osb (what a fool!) waited ... and left Mt. Vel, cf. pp. 6–9.", "The O.R.T. office shut, ropes, etc.", "Fig. 8 showed it."]),
    ("de", "„Wo ist die Laterne?“, fragte Wen. Er kam am 4. Mai z. B. für ca. 3,5 Taler.", ["„Wo ist die Laterne?“, fragte Wen.", "Er kam am 4. Mai z. B. für ca. 3,5 Taler."]),
    ("fr", "« Où est la clé ? » demanda Ann. Le port perdit M. Vél, cf. p. 12. Fin.", ["« Où est la clé ? » demanda Ann.", "Le port perdit M. Vél, cf. p. 12.", "Fin."]),
    ("es", "La Sra. Anña vendió el puerto a las 6.30. —¿Dónde está? —preguntó Quin.", ["La Sra. Anña vendió el puerto a las 6.30.", "—¿Dónde está? —preguntó Quin."]),
    ("zh", "“拦住果园！”库瓦莫说道。第10.0.1节描述了它。他（还能是谁？）等了等……然后走了。“门在这里。”他笑了。", ["“拦住果园！”库瓦莫说道。", "第10.0.1节描述了它。", "他（还能是谁？）等了等……然后走了。", "“门在这里。”", "他笑了。"]),
    ("zh", "“门在这里。”他看见了隧道。“走吧。”她听见了低语。", ["“门在这里。”", "他看见了隧道。", "“走吧。”", "她听见了低语。"]),
    ("ja", "「赤い箱はどこですか。」と隣人が言った。先生は午後3.5時間かけて描いた！", ["「赤い箱はどこですか。」と隣人が言った。", "先生は午後3.5時間かけて描いた！"]),
    ("hi", "“नक्शा कहाँ है?” लड़की ने पूछा। डॉ. मेलोरा ने 6.30 बजे बेचा।", ["“नक्शा कहाँ है?” लड़की ने पूछा।", "डॉ. मेलोरा ने 6.30 बजे बेचा।"]),
    ("ar", "وجد د. مالورا المفتاح في الساعة 6.30. أين الصندوق؟ غادر!", ["وجد د. مالورا المفتاح في الساعة 6.30.", "أين الصندوق؟", "غادر!"]),
    ("th", "กัปตันขายกุญแจ ช่างไม้ซ่อนแผนที่\nครูใหญ่ลืมตะเกียง", ["กัปตันขายกุญแจ", "ช่างไม้ซ่อนแผนที่", "ครูใหญ่ลืมตะเกียง"]),
    ("en", " \n　 ", []), ("en", None, []), ("en", "", []),
    ("ja", "今日は雨ですか明日は晴れますね出かけましょう", ["今日は雨ですか", "明日は晴れますね", "出かけましょう"]), ("ja", "雨ですから出かけません", ["雨ですから出かけません"]),
    ("zh", "你去吗我不去了", ["你去吗", "我不去了"]), ("km", "ខ្ញុំទៅផ្ទះ។គាត់នៅទីនេះ។", ["ខ្ញុំទៅផ្ទះ។", "គាត់នៅទីនេះ។"]), (None, "သူလာသည်။ ကျွန်တော်သွားသည်။", ["သူလာသည်။", "ကျွန်တော်သွားသည်။"]),
    ("lo", "ຂ້ອຍໄປ ລາວມາ ແຕ່ບໍ່ຢູ່", ["ຂ້ອຍໄປ", "ລາວມາ ແຕ່ບໍ່ຢູ່"]), ("en", "The U.S.A. won. " + "A.b." * 50_000 + " Then it ended.", ["The U.S.A. won.", "A.b." * 50_000, "Then it ended."]),
]


@pytest.mark.parametrize(("lang", "text", "units"), CASES)
def test_sentences(lang, text, units):
    assert [text[a:b] for a, b in sentences.sentence_spans(text, lang)] == units


def test_sentences_spark(spark):
    df = spark.createDataFrame([("a", "One. Two.", "en", False, 1), ("b", "The One. Two", "en", True, 2), ("c", None, None, None, 3), ("a", "One. Two.", "en", False, 1)], "id string, text string, lang string, h boolean, char_start int")
    rows = sentences.split_sentences(df, "text", "lang", "h").select("id", "char_start", "char_end").collect()
    assert sorted(map(tuple, rows)) == [("a", 0, 4), ("a", 0, 4), ("a", 5, 9), ("a", 5, 9), ("b", 0, 12)]
    assert sentences.split_sentences(df.where("1 = 0"), "text").count() == 0
    long = "A word here. " * 20000
    assert len(sentences.sentence_spans(long, "en")) == 20000


def test_word_lattice(spark):
    lat = sentences.WordLattice(["说道", "道", "说"])
    assert lat.segment("某人说道") == ["某", "人", "说道"] and lat.segment("") == []
    rng = random.Random(1)
    stock = ["酒吧", "果园", "望远镜", "灯塔", "手稿", "水壶", "地图", "港口", *(chr(0x8C00 + 2 * i) + chr(0x8C01 + 2 * i) for i in range(40))]
    rows = [("".join(rng.choice([*stock, "我", "他", "在", "看", "去"]) for _ in range(40)), "zh") for _ in range(200)] + [(None, "zh"), ("", "ja"), ("x", None)]
    words = sentences.corpus_words(spark.createDataFrame(rows, "text string, lang string"), "text")["zh"]
    assert {"果园", "望远镜", "灯塔", "手稿", "水壶", "地图", "港口"} <= set(words) and not {w for w in words if w.startswith("我") or w.endswith("吧")}
    assert sentences.corpus_words(spark.createDataFrame(rows, "text string, lang string").where("1 = 0"), "text") == {}


def test_cheapest_path_of_the_terminator_lattice():
    """The path that is found costs no more than any choice of ends."""
    import itertools

    def cost(text, lang, ends):
        total, unit, last = 0.0, 0, -1
        for m in sentences._CANDIDATE.finditer(text):
            a, b = m.span()
            if b <= last:
                continue
            c = last = sentences._closing_run(text, b, lang)
            if c >= len(text):
                break
            end, on, _ = sentences._costs(text, unit, a, b, c, lang)
            total += end if c in ends else on
            if c in ends:
                unit = c
                while unit < len(text) and text[unit].isspace():
                    unit += 1
        return total

    rng = random.Random(2)
    bits = ["At 5 p.m. ", "(What a day!) ", "He (no!) ran. ", "1. ", "Fig. A ", "No. ", "Mr. Hill ", "etc. Then ", "So. ", "“Go!” he said. ", "I. B. "]
    for _ in range(150):
        text = "".join(rng.choice(bits) for _ in range(5)).strip()
        gaps = sentences._spaced_gaps(text, "en")
        places = [m.end() for m in sentences._CANDIDATE.finditer(text)]
        every = {sentences._closing_run(text, p, "en") for p in places}
        best = min(cost(text, "en", set(x)) for k in range(len(every) + 1) for x in itertools.combinations(sorted(every), k)) if len(every) <= 9 else None
        assert best is None or cost(text, "en", set(gaps)) <= best + 1e-9


@pytest.mark.parametrize(("text", "want"), [
    ("Τheir lοnely sһօok", "Their lonely shook"), ("ﬁne Ｔｈｅ", "fine The"), ("ét​e\xadx y", "étex y"), ("он был тут", "он был тут"), ("⽊", "木"), ("文件trасk_84.mр3里", "文件track_84.mp3里"), ("waited…", "waited…"),
    ("क्‍ष", "क्‍ष"), ("x² ½", "x² ½"), ("plain", "plain"), ("", ""), (None, None),
])
def test_canonical(text, want):
    assert canon.canonical(text) == want
    assert canon.canonical(canon.canonical(text)) == want


def whole(text):
    """The canonical form of a text without imitations or joiners, made of the whole text at once."""
    import unicodedata

    _, plain = canon._tables()
    return unicodedata.normalize("NFC", text.translate(plain))


def test_canonical_splices_like_whole():
    """Splicing canonical segments gives what normalising the whole text gives, for characters of every block."""
    import unicodedata

    rng = random.Random(5)
    some = [chr(cp) for cp in range(0x20, 0x30000) if chr(cp) not in canon._IMITATES and cp not in (0x200C, 0x200D) and unicodedata.category(chr(cp)) not in ("Cs", "Cn", "Co")]
    some = [c for c in some if not canon._FOREIGN.search(whole(c))]
    unstable = [c for c in some if canon._tables()[0].fullmatch(c)]
    assert len(unstable) > 4000
    for k in range(6000):
        alphabet = unstable if k % 2 else ["a", "e", "b ", "\u0301", "\u0308", "\u0323", "é", "ü", "ﬁ", "Ａ", "\u1100", "\u1161", "\u11a8", "가", "각", "ｶ", "ﾞ", "\u200b", "\u09c7", "\u09be", "\U00011099", "\U000110ba", "\U0001d15e", "\U0001f201", "\U00012000", " "]
        t = "".join(rng.choice(alphabet if rng.random() < 0.7 else some) for _ in range(8))
        assert canon.canonical(t) == whole(t), [hex(ord(c)) for c in t]


def test_look_alike_pairs(spark):
    rows = [("b", 1, "s1", "The bell"), ("b", 1, "s2", "Тhe bell"), ("b", 1, "s3", "The bell"), ("b", 1, "s4", "the bell"), ("b", 2, "s5", "Тhe bell"), ("b", 1, "s6", None), ("b", 1, "s7", " "), (None, 1, "x", "a​b"), (None, 1, "y", "ab")]
    df = spark.createDataFrame(rows + rows[:2], "book string, chapter int, id string, text string").withColumn("key_1", F.lit(0))
    got = sorted(tuple(r) for r in canon.look_alike_pairs(df, ["book", "chapter"], "text", "id").collect() if r["book"])
    assert got == [("b", 1, "s1", "s2"), ("b", 1, "s2", "s3")]
    assert canon.look_alike_pairs(df, ["book", "chapter"], "text", "id").where("book IS NULL").count() == 1
    assert canon.look_alike_pairs(df.where("1 = 0"), ["book", "chapter"], "text").count() == 0
    classes = canon.look_alike_classes(df, ["book", "chapter"], "text", "id").where("book = 'b'").collect()
    assert sorted((r["key"], r["spellings"], r["rows"]) for r in classes) == [(f"s{i}", 2, 3) for i in (1, 2, 3)] and len({r["class"] for r in classes}) == 1


def brute_runs(events):
    out, cur, seen = [], None, set()
    for p, k in sorted((p, k) for p, k in events if p is not None and k is not None):
        if p in seen:
            continue
        seen.add(p)
        if cur and runs.alike(cur[2], k):
            cur[1:] = [p, k, cur[3] + 1]
        else:
            cur = [p, p, k, 1]
            out.append(cur)
    return {(a, b, n) for a, b, _, n in out}


@pytest.mark.parametrize("chunk", [1, 3, 4096])
def test_runs(spark, chunk):
    rng = random.Random(chunk)
    rows = []
    for b in ("x", "y", None):
        p = 0
        for _ in range(60):
            p += rng.choice([1, 1, 1, 4])
            w = rng.choice(["aa", "aa", "bb", "planet", "plane", "planets", None, "planes"])
            rows += [(b, p, w)] * rng.choice([1, 1, 2])
    rows.append(("z", None, "aa"))
    df = spark.createDataFrame(rows, "book string, i int, k string").withColumns({"s": F.col("i") * 1.0, "e": F.col("i") + 0.5, "n": F.lit(1), "chunk_head": F.lit(1)})
    got = runs.collapse_runs(df, ["book"], "i", F.col("k"), "s", "e", chunk).collect()
    for b in ("x", "y", None):
        assert {(r["first_index"], r["last_index"], r["count"]) for r in got if r["book"] == b} == brute_runs([(p, k) for x, p, k in rows if x == b])
    assert all(r["duration"] == r["last_index"] - r["first_index"] + 0.5 for r in got)
    assert runs.collapse_runs(df.where("1 = 0"), ["book"], "i", F.col("k"), "s", "e").count() == 0


def test_one_edit():
    def dist(a, b):
        d = np.arange(len(b) + 1)
        for i, x in enumerate(a, 1):
            e = [i]
            for j, y in enumerate(b, 1):
                e.append(min(d[j] + 1, e[j - 1] + 1, d[j - 1] + (x != y)))
            d = np.array(e)
        return d[-1]

    rng = random.Random(2)
    for _ in range(2000):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randrange(6))) for _ in range(2))
        assert runs.within_one_edit(a, b) == (dist(a, b) <= 1)


def test_reading(spark):
    rng = random.Random(4)
    vocab = {1: "cat dog run".split(), 2: "village market carry".split(), 3: "discrepancy chronology infer".split(), 4: "epistemology sedimentation whence".split()}
    rows, labels = [], []
    for d in range(80):
        lv = d % 4 + 1
        text = " ".join(rng.choice([w for x in range(1, lv + 1) for w in vocab[x]] + vocab[lv] * 2) for _ in range(60))
        rows.append((f"b{d}", 1, text))
        if d < 40:
            labels.append((f"b{d}", 1, lv))
    rows += [("null", 1, None), ("empty", 1, ""), ("unknown", 1, "zzz qqq")]
    df, lab = spark.createDataFrame(rows, "book string, chapter int, text string"), spark.createDataFrame(labels, "book string, chapter int, reading_level int")
    got = {r["book"]: r["reading_level"] for r in reading.reading_levels(df, lab, ["book", "chapter"], "text").collect()}
    assert sum(got[f"b{d}"] == d % 4 + 1 for d in range(40, 80)) >= 38
    assert len(got) == 83 and got["null"] == got["empty"] == got["unknown"] == 1
    none = reading.reading_levels(df, lab.where("1 = 0"), ["book", "chapter"], "text")
    assert none.where("reading_level IS NULL").count() == 83


def test_quantiles(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=30000)
    df = spark.createDataFrame([("a", i % 7, float(v)) for i, v in enumerate(x)] + [("b", 0, None), ("b", 0, float("nan")), (None, 0, 1.0)], "g string, day int, x double")
    days = quantiles.sketch(df, ["g", "day"], "x")
    merged = quantiles.merge_sketches(days, ["g"])
    rows = [r for r in quantiles.percentiles(merged, ["g"]).collect() if r["g"] == "a"]
    for r in rows:
        assert abs((x <= r["value"]).mean() - r["p"]) <= 2 * quantiles.rank_error()
        assert r["n"] == 30000 and r["lo"] == x.min() and r["hi"] == x.max()
    assert len(rows) == len(quantiles.PERCENTILES) and quantiles.percentiles(merged, ["g"]).where("g = 'b'").count() == 0
    assert quantiles.percentiles(merged, ["g"]).where("g IS NULL AND value = 1.0").count() == len(quantiles.PERCENTILES)
    assert quantiles.sketch(df.where("1 = 0"), ["g"], "x").count() == 0


PAIRS = [
    ("The cat sat on the red mat today.", "猫今天坐在红色的垫子上。", None), ("The cat sat. The dog ran off.", "猫坐下了。狗跑掉了。", None), ("The cat sat. The dog ran off.", "猫坐下了。", "truncated"),
    ("The cat sat on the red mat today.", "猫今天坐在红色的", "truncated"), ("The Happy Widow", "快乐的寡妇", None), ("It cost $14.51.", "售价14.", "truncated"), ("It weighed 67.28 kg.", "它重67.28公斤。", None), ("The file track_49.mp3 held it.", "文件track_49.mp3里有它。", None),
    ("Any text.", None, "empty"), ("Any text.", " 　", "empty"), ("Any text.", "（无）", "empty"), ("Any text.", "[]", "empty"), ("Any text.", "N/A", "empty"), ("Any text.", "TODO", "empty"),
    ("The cat sat on the red mat today.", "THE CAT SAT ON THE RED MAT TODAY.", "copy"), ("The cat sat on the red mat today.", "译文：The cat sat on the mat today。", "copy"), ("He made that kite.", "He made that kite.", "copy"),
    ("The cat sat on the red mat today.", "抱歉，我无法翻译这段内容。", "refusal"), ("The cat sat on the red mat today.", "I'm sorry, but I can't translate this passage.", "refusal"), ("I cannot help you with the engine.", "这个引擎我帮不了你。", None),
    ("The cat sat on the red mat today.", "Die Brücke bewachte den Hafen um Mitternacht.", "wrong_language"), ("The cat sat on the red mat today.", "少女は地図を探した。", "wrong_language"), ("Der Brief vergaß den Hafen.", "Die Witwe suchte das Schloss.", "wrong_language"),
    ("The cat sat on the red mat today.", "소녀는 다리 아래에서 등불을 그렸다.", "wrong_language"), ("The file track_26.mp3 held the mat. He ran.", "文件track_26.mp3里有垫子。他跑了。", None),
]


@pytest.mark.parametrize(("text", "trans", "want"), PAIRS)
def test_pair_defect(text, trans, want):
    assert pairs.defect(text, trans, "en", frozenset(), 0.34) == want


def test_language_and_endings_are_counted(spark):
    good = ["猫今天坐在红色的垫子上", "快乐的寡妇在港口看见了船只", "大学今天决定延期开学"]
    rows = [(g + "。",) for g in good for _ in range(5)] + [("他在图书馆里读书呢",)] * 5 + [(None,), ("x",)]
    closes, chinese = pairs.rendering_model(spark.createDataFrame(rows, "trans string"), "trans")
    assert {"上。", "书呢"} <= closes and "红色" not in closes and {"大学", "红色"} <= chinese and "上。" not in chinese
    assert pairs.is_foreign("東京大学入学式延期決定。", chinese) and not pairs.is_foreign("大学今天决定延期开学。", chinese) and not pairs.is_foreign("乔治的新船", chinese)
    assert pairs.defect("He sat on the red mat.", "猫今天坐在红色", "en", closes, None, chinese) == "truncated" and pairs.defect("He studies in the library.", "他在图书馆里读书呢", "en", closes, None, chinese) is None


def test_pairs_spark(spark):
    df = spark.createDataFrame([("b", i, "en", t, x) for i, (t, x, _) in enumerate(PAIRS)] + [("b", 99, None, None, None)], "book string, id int, lang string, text string, trans string").withColumn("usual", F.lit("x"))
    got = {r["id"]: r["defect"] for r in pairs.broken_pairs(df, ["book", "id"], "text", "trans", "lang").collect()}
    assert got == {i: d for i, (_, _, d) in enumerate(PAIRS) if d} | {99: "empty"}
    assert pairs.broken_pairs(df.where("1 = 0"), ["book", "id"], "text", "trans", "lang").count() == 0


PROSE = "One baker walked home. He sang a song by the river, and the wind was cold that night."
DOCS = {
    1: (PROSE, None), 2: ("\n".join(f"- {a} and {b}" for a, b in zip("bell cup door egg fox".split(), "goat hat ink jar key".split(), strict=True)), "list"), 3: ("id\tstart\tword\ns-1\t0.5\tbell\ns-2\t1.5\tcup\ns-3\t2.5\tdoor", "table"),
    4: ("| id | word |\n|---|---|\n| 1 | bell |\n| 2 | cup |\n| 3 | door |", "table"), 5: ("kzxh pj ccpwk fnr nlcmprk tsfcsc mm wvdqj", "junk"), 6: ("whisper valley chimney " * 30, "junk"), 7: ("", None), 8: (None, None), 9: (" \n ", None),
    10: ("{var _a=1;if(_b>2){f3(_c[4]||0);}}\n" * 6, "junk"), 11: (PROSE + "\n\n- bell\n- cup\n- door\n\n" + PROSE, None), 12: ("an old hat lost its way\na bird sang by the hill\nthe moon went over the sea", None), 13: ("å\x8f¥å Â£å ï»¿ â€™Ã Ã©Ã ã€‚ Â£Ã Ð°Ñâ€œ ÃƒÂ¼å", "junk"),
    14: ("Ann: Where is it?\nBob: By the door.\nAnn: I see it now.", None), 15: ("=====\n*****\n-----\n~~~~~~", "junk"), 16: ('"id";"start";"end";"word";"score"\n"s-1";"3.91";"7.81";"baker";"0.914"\n"s-2";"8.60";"12.05";"valley";"0.529"', "table"),
}


def test_kinds(spark):
    df = spark.createDataFrame([(i, t, 0) for i, (t, _) in DOCS.items()], "doc_id long, text string, words int")
    out = quality.with_ratios(quality.text_counts(df, "doc_id", "text", ["the", "by"])).withColumn("kind", quality.kind_rules())
    rows = {r["doc_id"]: r for r in out.collect()}
    assert {i: r["kind"] for i, r in rows.items()} == {i: k for i, (_, k) in DOCS.items()}
    assert rows[1]["words"] == len(PROSE.split()) and rows[1]["ended_line_share"] == 1.0 and rows[7]["words"] == 0 and rows[8]["symbol_ratio"] is None
    assert quality.text_counts(df.where("1 = 0"), "doc_id", "text", []).count() == 0


def plain_counts(line, common):
    """The sums of one line, said plainly."""
    s, words = line.strip(), quality._WORD.findall(line)
    low = [w.lower() for w in words]
    latin = [w for w in low if all(quality._LATIN.match(ch) and ch.isalpha() for ch in w)]
    visible = len(line) - sum(map(str.isspace, line))
    letters, digits = sum(map(str.isalpha, s)), sum(map(str.isdigit, s))
    pairs = sum(bool(quality._CJK.match(x)) and not y.isspace() for x, y in zip(s, s[1:], strict=False))
    return {
        "chars": len(line), "words": len(words), "word_chars": sum(map(len, words)), "letters": letters, "digits": digits, "spaces": len(line) - visible, "symbols": visible - letters - digits, "visible": visible,
        "common": sum(w in common for w in low) + sum(s.count(w) for w in common if quality._CJK.match(w)), "vowelless": sum(len(w) > 1 and not quality._VOWELS & set(w) for w in latin), "latin_words": len(latin),
        "markup_chars": sum(map(len, quality._MARKUP.findall(s))), "code_chars": sum(ch in quality._CODE for ch in s) + s.count("()"), "mojibake_chars": 0 if s.isascii() else sum(map(len, quality._MOJIBAKE.findall(s))),
        "long_token_chars": sum(len(t) for t in s.split() if len(t) > 40 and t.isascii()), "odd_words": sum(w.isascii() and any(map(str.isdigit, w)) and any(map(str.isalpha, w)) for w in words), "grams": len(words) + pairs,
    }


def test_lines_are_counted_as_said_plainly():
    rng = random.Random(3)
    bits = ["bell ", "It's ", "x-ray ", "Émile ", "3.5 ", "b4d ", "f() ", "<p class='a'>", "&amp;", "的书", "書 ", "ไทย ", "Ã©", "_a_ ", "?!” ", "\t", "|", "  ", "; ", ",", "k" * 50, "", "kzx ", "--", "’", "😀"]
    lines = ["".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(400)]
    common = {"bell", "it's", "的"}
    got = quality.evaluate(lines, quality.Common(common))
    for line, row in zip(lines, got.sums.tolist(), strict=True):
        assert dict(zip(quality.TOKENS, row, strict=True)) == plain_counts(line, common), line


def vector(parts, common):
    quality.settle(parts, common)
    return [(*p.counts.tolist(), int(p.bits.sum())) for p in parts]


def in_any_tree(rng, parts, common):
    while len(parts) > 1:
        i = rng.randrange(len(parts) - 1)
        parts[i : i + 2] = [quality.merge(parts[i], parts[i + 1], common)]
        assert all(len(e.text) <= 2 * quality.CHUNK for e in (parts[i].left, parts[i].right))
    return parts


KINDS_OF_LINES = [["bell ", "cup, ", "door.\n", "- x\n", "42\t", "\n", "  "], ["name", "7", "\t", "abc\t", "19.5\t"], ["wordrun", "x" * 9], ["He went home; ", "it rained. ", "的书，", "“So?” "], ["a,", "b c,", "1,", "\n" * 2]]


@pytest.mark.parametrize("kind", range(len(KINDS_OF_LINES)))
@pytest.mark.parametrize("size", [8, 64, 512])
def test_partials_merge_associatively(monkeypatch, kind, size):
    monkeypatch.setattr(quality, "CHUNK", size)
    monkeypatch.setattr(quality, "NEAR_BORDER", size // 2)
    rng = random.Random(kind * 1000 + size)
    common = quality.Common({"bell", "it"})
    for n in (1, 5, 60, 400):
        text = "".join(rng.choice(KINDS_OF_LINES[kind]) for _ in range(n))
        cut = lambda: [quality.partial(text[i : i + size], i == 0, i + size >= len(text), common) for i in range(0, max(1, len(text)), size)]  # noqa: B023, E731
        results = {vector(in_any_tree(rng, cut(), common), common)[0] for _ in range(6)} | {vector([quality.fold(text, True, True, common)], common)[0]}
        assert len(results) == 1
        whole = quality.evaluate(text.split("\n"), common)
        exact = [quality.TOKENS.index(c) for c in ("chars", "letters", "digits", "spaces", "symbols", "visible")]
        got = results.pop()
        assert all(got[i] == whole.sums[:, i].sum() for i in exact)
        if kind == 3:  # places to cut wherever a word ends: nothing of a long line's words is lost or counted twice
            assert got[quality.TOKENS.index("words")] == whole.sums[:, quality.TOKENS.index("words")].sum()
            assert got[len(quality.TOKENS)] == sum(bool(x.strip()) for x in text.split("\n"))


def test_a_text_of_one_huge_line():
    text = ("The rain went on, and nobody was there to open the door. " * 90_000)[:5_000_000]
    common = quality.Common({"the"})
    p = quality.fold(text, False, False, common)
    assert p.solid and len(p.left.text) + len(p.right.text) < 200 and not p.lines
    done = quality.fold(text, True, True, common)
    got = dict(zip(quality.COUNTS, vector([done], common)[0], strict=False))
    assert got["words"] == len(quality._WORD.findall(text)) and got["lines"] == 1 and got["prose_chars"] == got["visible"] and got["common"] == text.lower().split().count("the")


def test_blocks_of_a_document_meet(spark, monkeypatch):
    rng = random.Random(9)
    text = "".join(rng.choice(KINDS_OF_LINES[0]) for _ in range(60_000)) + "bell cup " * 20_000
    df = spark.createDataFrame([(1, text), (2, "x"), (1, text), (None, text), (3, None)], "doc_id long, text string")
    whole = {tuple(r) for r in quality.text_counts(df, "doc_id", "text", ["bell"]).collect()}
    monkeypatch.setattr(quality, "FAN", 1)
    assert len(whole) == 4 and len(text) > 4 * quality.CHUNK
    rows = quality.text_counts(df, "doc_id", "text", ["bell"]).collect()
    assert len(rows) == 5 and {tuple(r) for r in rows} == whole


def test_leaks(spark):
    rng = random.Random(6)
    vocab = [a + b for a in "bri cor dor fel gax hes ish jor kel lum".split() for b in "an bel cor dish em fin gas hul ik jo".split()]
    def say(n):
        return [rng.choice(vocab) for _ in range(n)]
    stock = "Read the passage below and choose the answer."
    items = [(i, f"{stock if i % 2 else ''} " + " ".join(say(80)) + ".") for i in range(12)]
    body = {i: t.removeprefix(stock).split() for i, t in items}
    docs, want = [], set()
    def add(ws, hit=None):
        docs.append((len(docs), " ".join(ws)))
        if hit is not None:
            want.add((len(docs) - 1, hit))
    add(say(200))
    add(say(50) + body[0][5:45] + say(50), 0)
    add(say(9) + [w.upper() + "," for w in body[1][10:32]], 1)
    add(say(20) + body[2][3:14] + say(25) + body[2][40:53] + say(20), 2)
    edited = body[3][10:38]
    edited[7], edited[15] = "zzz", "qqq www"
    add(say(30) + edited + say(30), 3)
    add(say(30) + body[4][20:30] + say(30))
    mixed = body[5][:40]
    rng.shuffle(mixed)
    add(say(10) + mixed)
    add(stock.split() * 4)
    add(body[0][5:45], 0)
    docs += [(100, None), (101, "")]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items + [(50, None), (51, "short one")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in leaks.find_leaks(d, "doc_id", "text", i, "item_id", "text").collect()}
    assert got == want
    assert leaks.find_leaks(d.where("1 = 0"), "doc_id", "text", i, "item_id", "text").count() == 0
    assert leaks.find_leaks(d, "doc_id", "text", i.where("1 = 0"), "item_id", "text").count() == 0


def test_leaks_in_pieces(monkeypatch):
    rng = random.Random(7)
    vocab = [a + b for a in "bri cor dor fel gax hes ish jor kel lum".split() for b in "an bel cor dish em fin gas hul ik jo".split()]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(80))) for i in range(6)]
    index = leaks.Index(items)
    body = [t.split() for _, t in items]
    say = lambda n: [rng.choice(vocab) for _ in range(n)]
    texts = [" ".join(say(900) + body[0][5:45] + say(700)), " ".join(say(300) + body[1][3:15] + say(1500) + body[1][40:54] + say(100)), " ".join(say(2000)), " ".join(body[2][10:40])]
    want = {(d, k): n for d, k, n in leaks.leaks_of(index, texts) if n >= leaks.WORDS}
    assert set(want) == {(0, 0), (1, 1), (3, 2)}
    monkeypatch.setattr(leaks, "PIECE", 2000)
    monkeypatch.setattr(leaks, "OVERLAP", 600)
    assert len(leaks.pieces(texts[1])) > 2 and all(texts[1][c:].startswith(t) and texts[1][:c].count(" ") == w for c, w, t in leaks.pieces(texts[1]))
    assert {(d, k): n for d, k, n in leaks.leaks_of(index, texts) if n >= leaks.WORDS} == want


@pytest.mark.parametrize(("n", "changed", "recall"), [(20, 2, 0.97), (20, 3, 0.95), (20, 4, 0.9), (22, 4, 0.9), (26, 5, 0.9), (32, 6, 0.9)])
def test_edited_quotations_are_found(n, changed, recall):
    """Planted edits: words of a stretch of exact length changed, added or left out, in foreign context."""
    rng = random.Random(n * 10 + changed)
    vocab = [a + b for a in "bri cor dor fel gax hes ish jor kel lum".split() for b in "an bel cor dish em fin gas hul ik jo neb oster pim quan rit sul tov ux vam wen".split()]
    phrases = ["in the absence of", "by means of every", "not least because of", "with regard to the"]
    say = lambda k: " ".join(rng.choice(phrases) if rng.random() < 0.05 else rng.choice(vocab) for _ in range(k))
    items = [(i, say(70)) for i in range(60)]
    index = leaks.Index(items)
    texts, want = [], []
    for _ in range(150):
        k = rng.randrange(60)
        ws = items[k][1].split()
        at = rng.randrange(len(ws) - n)
        part = ws[at : at + n]
        for x in rng.sample(range(1, n - 1), changed):
            part[x] = "zzz"
        texts.append(f"{say(30)} {' '.join(part)} {say(30)}")
        want.append(k)
    got = {(d, k) for d, k, held in leaks.leaks_of(index, texts) if held >= leaks.WORDS}
    assert sum((d, k) in got for d, k in enumerate(want)) >= recall * len(want)
    assert len(got - set(enumerate(want))) == 0


def test_rare_is_counted_without_copies():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    one = " ".join(rng.choice(words) for _ in range(60))
    items = [one] * 5 + [one.replace(words[0], "other") + " end" for _ in range(5)] + [" ".join(rng.choice(words) for _ in range(60)) for _ in range(20)]
    grams, triples = leaks.common_keys(items)
    assert len(grams) == len(triples) == 0
    index = leaks.Index(list(enumerate(items)))
    assert {k for _, k, n in leaks.leaks_of(index, [" ".join(one.split()[10:40])]) if n >= 20} == set(range(10))


def test_align_equals_plain_alignment():
    """The banded, batched alignment finds the score of an unbanded one when the band holds it."""
    rng = np.random.default_rng(1)
    a = rng.integers(0, 4, (20, 12)).astype(np.int32)
    b = rng.integers(0, 4, (20, 12 + 2 * leaks.HALF)).astype(np.int32)
    m, a0, a1, b0, b1 = leaks.align(a, b)
    for r in range(20):
        s = np.zeros((13, b.shape[1] + 1))
        for i in range(12):
            for j in range(b.shape[1]):
                if 0 <= j - i <= 2 * leaks.HALF:
                    s[i + 1, j + 1] = max(0, s[i, j] + (1 if a[r, i] == b[r, j] else -leaks.EDIT), s[i, j + 1] - leaks.EDIT, s[i + 1, j] - leaks.EDIT)
        best = s.max()
        got = 0.0
        sub = np.zeros((a1[r] - a0[r] + 1, b1[r] - b0[r] + 1))
        for i in range(sub.shape[0] - 1):
            for j in range(sub.shape[1] - 1):
                sub[i + 1, j + 1] = max(0, sub[i, j] + (1 if a[r, a0[r] + i] == b[r, b0[r] + j] else -leaks.EDIT), sub[i, j + 1] - leaks.EDIT, sub[i + 1, j] - leaks.EDIT)
        got = sub.max()
        assert got == pytest.approx(best, abs=1e-5) and m[r] >= best - 1e-6


def test_tokens(spark, monkeypatch):
    pytest.importorskip("public_tokenizers")
    import base64

    import tiktoken

    from sonograin.llm import tokens

    path, pattern = tokens.default_files()
    with open(path, "rb") as f:
        ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, f)}
    ref = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(8)
    texts = ["", None, "Hello  world, it's 3.5!\n\n", "=" * 3000, "ab" * 500, "é" * 300, "日本語と中文和ไทย हिन्दी العربية", "🚢📚‍", " " * 500, "<|endoftext|>", "\x00\x01"]
    texts += ["".join(rng.choice("abcdefgh ()[]{}<>=+-'`é語\n\t") for _ in range(rng.randrange(400))) for _ in range(60)]
    bpe = tokens.Bpe(path, pattern)
    assert bpe.encode(texts) == [ref.encode_ordinary(t) if t else [] for t in texts]
    monkeypatch.setattr(tokens, "LONG", 100)
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    assert [list(x) for x in tokens.Bpe(path, pattern).encode(texts)] == [ref.encode_ordinary(t) if t else [] for t in texts]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(0, "", "x")], "doc_id long, text string, ids string")
    got = tokens.encode_texts(df, "doc_id", "text", path, pattern).collect()
    assert len(got) == len(texts) + 1 and all(r["ids"] == (ref.encode_ordinary(texts[r["doc_id"]]) if texts[r["doc_id"]] else []) for r in got)
    assert ref.decode(got[2]["ids"]) == texts[2]
