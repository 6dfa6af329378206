"""License scan by ordered signature rules; DataFrame functions only.

A literal prefilter over the raw text leaves few texts, each rule's keyword few rules for a text. Those
rules run over the text's words; each detection is an interval of words, and one that lies inside another of
higher priority (or of the same priority, if it is shorter) is dropped. Base phrases are counted at all places and never dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from plumbline.llm.common import stored
from plumbline.llm.license_rules import GATES, Rule, rules as all_rules

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # before A-Z are lower-cased
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _gate(text):
    low = F.lower(text)
    hit = low.contains("cc") & low.rlike(r"cc" + GAP + "by")
    for literal in GATES:
        hit = hit | low.contains(literal)
    return hit


def _blanks(text):
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def license_detections(worded: DataFrame, rules: list[Rule]) -> DataFrame:
    """(row, label, confidence, base, begin, end) of all detections, in words, before suppression.

    ``worded`` has (row, words): lower-cased words with one blank between them.
    """
    listed = worded.sparkSession.createDataFrame(
        [(i, r.label, r.priority, r.keyword, rf"(?<![^ ])(?:{r.pattern})(?![^ ])", r.confidence, r.base) for i, r in enumerate(rules)],
        "rule int, label string, priority int, keyword string, pattern string, confidence double, base boolean",
    )
    keywords = F.array(*[F.lit(k) for k in sorted({r.keyword for r in rules})])
    gated = worded.withColumn("keyword", F.explode(F.filter(keywords, lambda k: F.col("words").contains(k))))
    tried = gated.join(F.broadcast(listed), "keyword")  # the rules are a fixed list
    between, matched = F.split("words", F.col("pattern"), -1), F.regexp_extract_all("words", F.col("pattern"), F.lit(0))
    pieces = tried.withColumn("matched", matched).where(F.size("matched") > 0).withColumn("between", between)
    # split() drops an empty part before a match at the very beginning only for matches of no width, which no rule has
    pieces = pieces.select(
        "row", "rule", "label", "priority", "confidence", "base", F.posexplode(F.arrays_zip("matched", "between")).alias("at", "part")
    ).where(F.col("part.matched").isNotNull())
    so_far = Window.partitionBy("row", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    begin = F.sum(_blanks(F.col("part.between"))).over(so_far) + F.sum(_blanks(F.col("part.matched"))).over(so_far) - _blanks(F.col("part.matched"))
    found = pieces.withColumn("begin", begin.cast("bigint"))
    return found.withColumn("end", F.col("begin") + _blanks(F.col("part.matched")) + 1).drop("part", "at")


def unsuppressed(found: DataFrame) -> DataFrame:
    """Detections that lie in no other of higher priority, nor in an earlier-listed one of the same; base ones all stay."""
    levels = sorted({r.priority for r in all_rules()})
    order = [F.col("begin"), F.col("end").desc(), F.col("priority").desc(), F.col("label"), F.col("rule")]
    before = Window.partitionBy("row").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    covered = F.lit(False)
    for level in levels:
        reach = F.max(F.when(F.col("priority") == level, F.col("end"))).over(before)
        covered = covered | ((F.col("priority") <= level) & F.coalesce(reach >= F.col("end"), F.lit(False)))
    return found.withColumn("covered", covered).where("base or not covered")


def license_scan(docs: DataFrame, rules: list[Rule] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    Words are runs of 0-9, letters (A-Z lower-cased) and non-ASCII characters. n_base counts the places of base phrases, first_word and
    last_word are their smallest and largest start (null without any). The label lists are sorted and comma-joined, empty without any; ``score``
    is 1 less the product of (1 - confidence) of the labels' best detections. A null or empty text has no words and score 0. Repeated rows and
    rows without id stay rows of their own; other columns are not read.
    """
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = F.trim(F.regexp_replace(F.translate(value, UPPER, LOWER), GAP, " "))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{doc_id}`").alias("id"),
        F.regexp_count(value, F.lit(WORD)).cast("bigint").alias("n_words"),
        F.when(_gate(value), words).alias("words"),
    )
    rows = stored(rows, "words")  # row numbers hold from here on
    found = license_detections(rows.where("words is not null").select("row", "words"), rules or all_rules())
    kept = stored(unsuppressed(found).select("row", "label", "confidence", "base", "begin"), "detections")
    of_label = kept.groupBy("row", "label").agg(
        F.max("confidence").alias("confidence"),
        F.sum(F.col("base").cast("bigint")).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("begin"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("begin"))).alias("last_word"),
    )
    of_row = of_label.groupBy("row").agg(
        F.sum("n_base").alias("n_base"),
        F.min("first_word").alias("first_word"),
        F.max("last_word").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("n_base") > 0, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.array_sort(F.collect_list(F.col("confidence"))).alias("parts"),
    )
    score = F.lit(1.0) - F.aggregate("parts", F.lit(1.0), lambda x, c: x * (F.lit(1.0) - c))
    of_row = of_row.withColumn("score", score).drop("parts")
    empty = {"n_base": 0, "base_labels": "", "labels": "", "score": 0.0}
    joined = rows.select("row", "id", "n_words").join(of_row, "row", "left").fillna(empty)
    return joined.select(
        F.col("id").alias(doc_id), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )
