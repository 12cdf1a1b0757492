"""

A verdict is one aggregation of findings; no finding is capped. Thresholds are parameters: the gates of a reader,
a release and a library differ and stay apart."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonograin.operators import blocks
from sonograin.operators.relate import covered
from sonograin.operators.sequence import run_ids

CH = ["book", "chapter"]
REC = ["book", "chapter", "id"]


def _find(df: DataFrame, rule: str, when: Column, severity: str = "error", detail: Column | None = None, ident: bool = True) -> DataFrame:
    d = F.lit(None).cast("string") if detail is None else detail.cast("string")
    i = F.col("id") if ident else F.lit(None).cast("string")
    return df.where(F.coalesce(when, F.lit(False))).select(*CH, i.alias("id"), F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), d.alias("detail"))


def union(parts: list[DataFrame]) -> DataFrame:
    """Findings of several audits."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def _rules(df: DataFrame, rules: list[tuple[str, Column, str]]) -> DataFrame:
    """Findings of row rules in one pass: each row explodes to the rules that hold."""
    found = F.filter(F.array(*[F.when(F.coalesce(w, F.lit(False)), F.struct(F.lit(r).alias("rule"), F.lit(s).alias("severity"))) for r, w, s in rules]), lambda x: x.isNotNull())
    ex = df.select(*REC, F.explode(found).alias("f"), F.col("text").alias("detail"))
    return ex.select(*REC, "f.rule", "f.severity", "detail")


def unclosed_quote(c: Column) -> Column:
    """Whether curly quotations are opened more often than closed, or straight marks are odd in number."""
    opens, closes, straight = (F.length(c) - F.length(F.replace(c, F.lit(m), F.lit(""))) for m in "“”\"")
    return (opens > closes) | (straight % 2 == 1)


def orthography(c: DataFrame, quotes: bool = False) -> DataFrame:
    """AU-01: empty texts, words chopped at a line end, lower-case starts, orphan words, and (`quotes`) quotations left open. URLs follow
    no grammar."""
    t = F.trim("text")
    url = t.rlike("^https?://")
    bullet = t.rlike(r"^(\(([a-zA-Z]{1,2}|\d{1,3}|[ivxLCDM]+)\)|[a-zA-Z]{1,2}\.|\d{1,3}\.|[ivxLCDM]+\.)")
    fragment = t.rlike(r"^[\"“‘'(\[]*[a-z]") & ~bullet & ~t.rlike(r"^by\s+[A-Z]") & ~t.rlike(r"^[a-zA-Z]\s*=\s*")
    word = F.regexp_replace(t, r"(?<=[a-zA-Z])\d{1,3}$", "")
    orphan = (F.size(F.split(word, r"\s+")) == 1) & ~word.rlike("^[—–-]") & ~word.rlike(r"^[*\s—–\-•#+]+$") & ~word.rlike(r"[.!?…”\")\]:,\-—–。！？]$")
    head = F.coalesce("is_heading", F.lit(False))
    return _rules(c, [
        ("empty_text", F.coalesce(t, F.lit("")) == "", "error"), ("trailing_hyphen", t.rlike("[a-zA-Z]-$") & ~url, "error"),
        ("lowercase_start", ~head & fragment & ~url, "warning"), ("orphan_word", ~head & orphan & ~url & (t != "") & ~F.coalesce("is_tabular", F.lit(False)), "warning"),
        *([("unclosed_quote", unclosed_quote(t) & ~url, "error")] if quotes else []),
    ])


# What stands before a point that ends no sentence, as it ends the text before it.
ABBREVIATED = (
    "Mrs Mr Ms Dr Prof Sr Jr Rev Hon Gen Col Maj Capt Lt Sgt Cpl Pvt Gov Sen Rep Pres Sec Amb Insp Det St Mt Ft Mme Mlle Esq Ph.D M.D B.A M.A U.S U.K U.S.A e.g i.e vs etc al fig pp vol no "
    "Jan Feb Mar Apr Aug Sept Oct Nov Dec"
).split()


def boundaries(c: DataFrame) -> DataFrame:
    """AU-02: a sentence boundary inside a record (diagnostic only).

    Set aside: points of abbreviations and initials, the interjections 'No.', 'Oh no.' and 'Hell no.', and records that open with speech and
    leave it open, close it out of turn, or end it before further words."""
    abbreviated = "|".join(a.replace(".", r"\.") for a in ABBREVIATED)
    interjection = r"(?i:(?:^|[.!?]\s{1,20})[\"“‘']?(?:(?:oh|hell)\s{1,20})?no\s{0,20})"
    inside = F.col("text").rlike(rf"(?<!{abbreviated}|\b[A-Z])(?<!{interjection})(?:[.!?][\"'”’)]*|\*)\s+[A-Z]")
    speech = F.col("text").rlike(r"^\s*[“\"]") & (unclosed_quote(F.col("text")) | F.col("text").rlike(r"^\s*[“\"][^\n]*[.!?][”\"]\s+[A-Z][a-z]+"))
    return _rules(c, [("several_sentences", inside & ~speech, "diagnostic")])


def typography(c: DataFrame) -> DataFrame:
    """AU-03: missing element numbers, repeated quotation marks, chapters in which over 70 % of at least 15 prose
    paragraphs are one sentence, runs of such paragraphs."""
    per_row = _rules(c, [("no_element", F.col("elem_idx").isNull(), "error"), ("repeated_quotes", F.col("text").rlike("[“\"”]{2,}"), "error")])
    runs = run_ids(c, CH, ["seq", "id"], F.col("elem_idx")).groupBy(*CH, "run").agg(F.count("*").alias("n"), F.min_by("is_heading", "seq").alias("h"), F.min_by("text", "seq").alias("t"))
    prose = runs.where(~F.coalesce("h", F.lit(False)))
    single = (F.col("n") == 1) & ~F.coalesce(F.trim("t").rlike("^[“\"‘']"), F.lit(False))
    dense = prose.groupBy(*CH).agg(F.count("*").alias("p"), F.count_if(single).alias("s"))
    over = _find(dense, "one_sentence_paragraphs", (F.col("p") >= 15) & (F.col("s") > 0.7 * F.col("p")), "error", F.concat_ws("/", F.col("s"), F.col("p")), ident=False)
    return per_row.unionByName(over).unionByName(single_sentence_runs(c))


def single_sentence_runs(c: DataFrame, least: int = 8) -> DataFrame:
    """AU-03, WN-06: runs of at least `least` paragraphs of one sentence each that are plain prose (no heading, dialogue, list item,
    number, short line or line with a final colon).

    Exempt: after a colon, under a heading of terms (as in the reference not for a run that ends the chapter), acknowledgments,
    and runs with enough semicolons, questions, structured lines or opening coordinators."""
    w, by = Window.partitionBy(*CH).orderBy("g"), Window.partitionBy(*CH).orderBy("seq", "id", "elem_idx", "text")
    t = F.coalesce("text", F.lit(""))
    c = c.withColumn("__y", (F.row_number().over(by) <= 5) & F.lower(t).contains("acknowledgment"))
    groups = run_ids(c, CH, ["seq", "id", "elem_idx", "text"], F.col("elem_idx")).groupBy(*CH, F.col("run").alias("g")).agg((F.count("*") == 1).alias("one"), F.min_by(F.struct("id", t.alias("text"), F.coalesce("is_heading", F.lit(False)).alias("h")), "seq").alias("x"), F.max("__y").alias("thanks"))
    x, one = F.regexp_replace(F.col("x.text"), r"^\s+|\s+$", ""), F.col("one")
    head = one & F.col("x.h")
    aside = F.col("x.h") | x.rlike("^[“\"‘']|[”\"’]$") | x.rlike(r"^(\d+[.)]|[a-zA-Z][.)]|[-•*])\s+") | x.rlike(r"^[\d,.]+\s+") | (F.size(F.split(x, r"\s+")) < 6) | x.endswith(":")
    groups = groups.withColumns({
        "ok": one & ~aside, "colon": F.coalesce(F.lag(one & x.endswith(":")).over(w), F.lit(False)), "final": F.max("g").over(Window.partitionBy(*CH)), "thanks": F.max("thanks").over(Window.partitionBy(*CH)),
        "terms": F.coalesce(F.last(F.when(head, F.lower(x).rlike("terminology|glossary|definitions|key terms")), ignorenulls=True).over(w), F.lit(False)),
    })
    raw = F.col("x.text")
    runs = run_ids(groups, CH, ["g"], F.col("ok")).where("ok").groupBy(*CH, "run").agg(
        F.count("*").alias("n"), F.min_by("colon", "g").alias("colon"), F.max("thanks").alias("thanks"), (F.min_by("terms", "g") & (F.max("g") < F.first("final"))).alias("terms"),
        F.count_if(raw.contains(";")).alias("semicolons"), F.count_if(x.endswith("?")).alias("questions"), F.count_if(raw.rlike("[:=×]")).alias("structured"),
        F.count_if(x.rlike("^(And|So|But|Or|Yet|For) ")).alias("coordinated"), F.sort_array(F.collect_list(F.struct("g", F.coalesce("x.id", F.lit("?")).alias("id")))).alias("ids"),
    )
    n = F.col("n")
    exempt = F.col("thanks") | F.col("colon") | F.col("terms") | (F.col("semicolons") / n >= 0.7) | (F.col("questions") / n >= 0.5) | (F.col("structured") / n >= 0.4) | (F.col("coordinated") / n >= 0.35)
    first = F.concat(n.cast("string"), F.lit(": "), F.array_join(F.transform(F.slice("ids", 1, 4), lambda r: r["id"]), ", "))
    return _find(runs.where(n >= least), "one_sentence_run", ~exempt, "error", first, ident=False)


def analysis_contract(c: DataFrame, f: DataFrame) -> DataFrame:
    """AU-05: records without analysis, other text, no rendering, vocabulary over 10 entries or ill-formed."""
    a = f.select(*REC, F.col("text").alias("ft"), "trans", "vocab", F.lit(True).alias("there"))
    j = c.select(*REC, "text").join(a, REC, "left")
    ill = F.exists(F.col("vocab"), lambda v: v["word"].isNull() | (F.trim(v["word"]) == "") | v["def"].isNull())
    return _rules(j, [
        ("no_analysis", F.col("there").isNull(), "error"), ("other_text", F.col("there") & ~F.col("text").eqNullSafe(F.col("ft")), "error"),
        ("no_rendering", F.col("there") & (F.trim(F.coalesce("trans", F.lit(""))) == ""), "error"), ("long_vocabulary", F.size("vocab") > 10, "error"), ("ill_vocabulary", ill, "error"),
    ])


def interior_voids(c: DataFrame, a: DataFrame) -> DataFrame:
    """AU-09: body records (p, blockquote) between matched ones that have no audio."""
    w = Window.partitionBy(*CH).orderBy("seq", "id")
    m = F.when(F.col("has_audio_match"), F.lit(1))
    j = a.select(*REC, "seq", "has_audio_match", "source_text").withColumn("b", F.max(m).over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn("n", F.max(m).over(w.rowsBetween(1, Window.unboundedFollowing)))
    void = j.where("NOT has_audio_match AND b = 1 AND n = 1").select(*REC, F.col("source_text").alias("text"))
    body = c.where(F.col("tag").isin("p", "blockquote") & ~F.coalesce("is_heading", F.lit(False))).select(*REC).distinct()
    return _rules(void.join(body, REC, "left_semi"), [("interior_void", F.lit(True), "error")])


def metadata(m: DataFrame) -> DataFrame:
    """AU-16: role, number, uniqueness and title of chapters."""
    base = m.withColumn("id", F.lit(None).cast("string"))
    many = m.groupBy(*CH).agg(F.count("*").alias("n")).where("n > 1").withColumn("id", F.lit(None).cast("string"))
    return union([
        _find(base, "bad_role", F.col("role").isNull() | (F.col("role") == "")), _find(base, "number_of_no_chapter", (F.col("role") != "chapter") & F.col("display_number").isNotNull()),
        _find(base, "bad_number", F.col("display_number") < 1), _find(many, "repeated_chapter", F.lit(True)), _find(base, "no_title", F.trim(F.coalesce("title", F.lit(""))) == "", "warning"),
    ])


def continuity(a: DataFrame, lead: int = 4_500, first_lead: int = 30_000, gap: int = 8_000, critical_lead: int = 10_000, critical: int = 15_000) -> DataFrame:
    """AU-14: (book, chapter, rule, severity) of every sentence of a timeline in milliseconds (columns seq, a, b): rule
    'LEADING_VOID' for a late first sentence, 'INTER_SENTENCE_VOID' for a long hole, else null."""
    w = Window.partitionBy(*CH).orderBy("seq", "a", "b")
    g = a.withColumn("gap", F.col("a") - F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn("r", F.row_number().over(w))
    late = (F.col("r") == 1) & (F.col("a") > F.when(F.col("chapter") == 1, first_lead).otherwise(lead))
    rule = F.when(late, "LEADING_VOID").when(F.col("gap") > gap, "INTER_SENTENCE_VOID")
    size = F.coalesce("gap", "a")
    return g.select(*CH, rule.alias("rule"), F.when(size > F.when(F.col("r") == 1, critical_lead).otherwise(critical), "critical").otherwise("warning").alias("severity"))


def voids(a: DataFrame, least: int = 6_000) -> DataFrame:
    """Holes of over `least` milliseconds in a timeline (columns book, chapter, seq, a, b): (book, chapter, start, end)."""
    rows = a.where("a IS NOT NULL AND b IS NOT NULL")
    out = blocks.before(rows, CH, ["seq", "a"], blocks.positions("seq"), __pe=("max", F.col("b")))
    return out.where(F.col("a") - F.col("__pe") > least).select(*CH, F.col("__pe").alias("start"), F.col("a").alias("end"))


def page_integrity(units: DataFrame, skips: DataFrame, lead: int = 4_000, first_lead: int = 30_000, gap: int = 6_000, tolerance: int = 2_000) -> DataFrame:
    """AU-11, JN-11: (book, chapter, rule, start, end) of a compiled page's units (columns book, chapter, unit, s, e in seconds): a late
    first unit, or a hole, that no skip range (book, chapter, start, end in milliseconds) covers."""
    t = units.select(*CH, F.col("unit").alias("seq"), F.round(F.col("s") * 1000).cast("bigint").alias("a"), F.round(F.col("e") * 1000).cast("bigint").alias("b"))
    first = t.groupBy(*CH).agg(F.min("a").alias("end")).where(F.col("end") > F.when(F.col("chapter") == 1, first_lead).otherwise(lead))
    late = first.select(*CH, F.lit("LEADING_VOID").alias("rule"), F.lit(0).cast("bigint").alias("start"), "end")
    found = late.unionByName(voids(t, gap).withColumn("rule", F.lit("INTER_SENTENCE_VOID")))
    return covered(found, skips, CH, "start", "end", tolerance, 60_000, "left_anti")


def book_verdict(findings: DataFrame) -> DataFrame:
    """AG-14: critical findings, warnings and state of each book; rows with a null rule stand for what was examined."""
    has = F.col("rule").isNotNull()
    g = findings.groupBy("book").agg(F.count_if(has & (F.col("severity") == "critical")).alias("critical"), F.count_if(has & (F.col("severity") == "warning")).alias("warnings"))
    return g.withColumn("state", F.when(F.col("critical") > 0, "DEFECTIVE").otherwise("CLEAN"))


# Reasons of what is not narrated, methods that may stand out of order.
NOT_NARRATED = ("non_narrated_content", "non_narrated_text", "duplicate_source_fragment", "out_of_scope_reference", "structural_tabular_omitted_by_narrator")
REORDERED = ("leading_epigraph_attribution", "chapter_heading_numeric_variant", "opening_speaker_attribution", "dialogue_attribution_reorder", "dialogue_attribution_actor_omitted")


def release_gate(a: DataFrame, void: int = 15_000, tolerance: int = 50) -> DataFrame:
    """AU-06, FL-08: findings of the aligned rows of a timeline in milliseconds (columns book, chapter, seq, id, a, b, source_text,
    is_heading, has_audio_match, fallback_used, alignment_status, alignment_reason, alignment_method, matched_token_count, match_ratio).

    Rows that are not narrated or may stand out of order take no part in the timeline."""
    c = F.col
    silent = F.coalesce((c("alignment_status") == "not-applicable") & c("alignment_reason").isin(*NOT_NARRATED), F.lit(False))
    moved = F.coalesce((c("alignment_status") == "validated") & c("alignment_method").isin(*REORDERED) & c("has_audio_match") & ~c("fallback_used"), F.lit(False))
    rows = a.withColumn("__in", ~silent & ~moved).withColumn("__silent", silent)
    rows = blocks.before(rows, CH, ["seq", "id"], blocks.positions("seq"), __ps=("last", F.when(c("__in"), c("a"))), __pe=("max", F.when(c("__in"), c("b"))))
    body = ~F.coalesce("is_heading", F.lit(False)) & ~c("__silent")
    match = F.coalesce("has_audio_match", F.lit(False))
    weak = ~match | F.coalesce("fallback_used", F.lit(False)) | ~F.coalesce(c("alignment_status").isin("validated", "reviewed"), F.lit(False)) | (F.coalesce("matched_token_count", F.lit(0)) < 1) | (F.coalesce("match_ratio", F.lit(0.0)) < 0.5)
    return _rules(rows.withColumnRenamed("source_text", "text"), [
        ("non_monotonic", c("__in") & (c("a") < c("__ps")), "error"), ("overlap", c("__in") & (c("a") < c("__pe") - tolerance), "error"), ("end_before_start", c("b") < c("a"), "error"),
        ("void", c("__in") & (c("__pe") > 0) & (c("a") - c("__pe") > void), "error"), ("no_audio", body & ~match, "error"), ("review", body & weak, "warning"),
    ])


def verdict(findings: DataFrame) -> DataFrame:
    """AG-22: errors, warnings and whether a book may be released (neither)."""
    g = findings.groupBy("book").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    return g.withColumn("ready", (F.col("errors") == 0) & (F.col("warnings") == 0))
