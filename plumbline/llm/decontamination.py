"""Benchmark decontamination by template windows; DataFrame functions only.

Numbers, units behind them and names become typed placeholders, so that a question with other values keeps
its template. Windows of consecutive template tokens are joined by hash with those of the benchmark; windows
on one diagonal make up an overlap, and an overlap counts if it is long enough and its slots are
consistent: equal values in the item stand for equal values in the document, and the other way round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.common import SMALL_SIDE_ROWS, fingerprint, free_names, small_or_shuffled, stored

WINDOW = 8  # template tokens
LITERALS = 5  # of them no placeholders, at least; a window of fewer is met by its exact tokens only
OVERLAP = 13  # tokens of an overlap that counts
SHORTEST = 3  # tokens of the shortest item that is looked for

NUMBER, UNIT, NAME = -1, -2, -3  # in place of a literal's hash

#: fixed list of units that follow a number
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams kilogram kilograms oz ounce ounces lb lbs pound "
    "pounds ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days "
    "week weeks month months year years percent dollar dollars euro euros cent cents usd eur mph kmh degree degrees"
).split()

#: a word or number, with the end of a sentence before it if there is one
TOKEN = r"(?:[.!?:\n][^\p{L}\p{N}]*)?(?:\p{N}+(?:[.,]\p{N}+)*|\p{L}+)"
_LEAD = r"^[^\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def _is_number(token: Column) -> Column:
    first = F.substring(token, 1, 1)
    return (first >= "0") & (first <= "9")


def template(toks: Column) -> Column:
    """The hash of each token in lower case, or the code of its placeholder.

    A name is a capitalised word that begins neither the text nor a sentence and is not all capitals.
    """

    def code(token: Column, i: Column) -> Column:
        first = F.substring(token, 1, 1)
        bare = F.regexp_replace(token, _LEAD, "")
        follows_number = (i > 0) & _is_number(F.get(toks, i - 1))
        return (
            F.when(_is_number(token), F.lit(NUMBER))
            .when(first.isin(".", "!", "?", ":", "\n"), F.when(_is_number(bare), F.lit(NUMBER)).otherwise(F.xxhash64(F.lower(bare))))
            .when((i > 0) & (first != F.lower(first)) & (token != F.upper(token)), F.lit(NAME))
            .when(F.lower(token).isin(*UNITS), F.when(follows_number, F.lit(UNIT)).otherwise(F.xxhash64(F.lower(token))))
            .otherwise(F.xxhash64(F.lower(token)))
            .cast("bigint")
        )

    return F.transform(toks, code)


def _bare(token: Column) -> Column:
    return F.lower(F.regexp_replace(token, _LEAD, ""))


def _exact(toks: Column) -> Column:
    return F.transform(toks, lambda t: F.xxhash64(_bare(t)))


def _windows(codes: Column, size: int) -> Column:
    hashes = F.transform(F.sequence(F.lit(1), F.size(codes) - (size - 1)), lambda i: F.xxhash64(F.slice(codes, i, size)))
    return F.when(F.size(codes) >= size, hashes)


def _item_windows(items: DataFrame, window: int) -> DataFrame:
    """(item_id, item_tag, item_tokens, item_at, form, hash) of all windows of items.

    Form 0 is a template, any other the size of a window of exact tokens. The first token is a literal here; behind another word it would be a
    name if it has a capital, and a unit behind a number, so the first window has a second row with that placeholder.
    """
    first = F.regexp_replace(F.get("item_toks", F.lit(0)), _LEAD, "")
    initial = F.substring(first, 1, 1)
    as_name = (initial != F.lower(initial)) & (first != F.upper(first))
    other = F.when(as_name, F.lit(NAME)).when(F.lower(first).isin(*UNITS), F.lit(UNIT)).cast("bigint")
    rest = F.slice("codes", F.lit(2), F.size("codes"))
    renamed = items.withColumn("codes", F.concat(F.array(other), rest)).where(other.isNotNull())

    def listed(some: DataFrame, only_first: bool) -> DataFrame:
        size = F.least(F.lit(window), F.col("item_tokens"))
        last = F.lit(0) if only_first else F.col("item_tokens") - size
        some = some.select("*", size.alias("size"), F.explode(F.sequence(F.lit(0), last)).alias("item_at"))
        codes = F.slice("codes", F.col("item_at") + 1, F.col("size"))
        literals = F.size(F.filter(codes, lambda c: ~c.isin(NUMBER, UNIT, NAME)))
        thin = (F.col("size") < window) | (literals < min(LITERALS, window))
        exact = F.slice(_exact(F.col("item_toks")), F.col("item_at") + 1, F.col("size"))
        hashed = F.when(thin, F.xxhash64(exact)).otherwise(F.xxhash64(codes))
        return some.select("item_id", "item_tag", "item_tokens", "item_at", F.when(thin, F.col("size")).otherwise(0).alias("form"), hashed.alias("hash"))

    return listed(items, False).union(listed(renamed, True)).distinct()


def leaked_items(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    overlap: int = OVERLAP,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(id, tag, item_id, doc_start, item_start, n_tokens, item_tokens, n_slots, same_values) of overlaps of documents with benchmark items.

    Windows of fewer than LITERALS literals meet by their tokens in lower case, all others by their template. What the first token of an item is
    depends on the text before it, so its first window is looked for in every form the token may have there: no word-for-word copy is missed.
    One row per document, item and diagonal; starts and lengths in template tokens. ``tag`` is a fingerprint of the text, which with the id
    tells rows apart; repeated rows share their rows here. Items (item_id, text) of fewer than ``overlap`` tokens count when covered whole; one of fewer than
    ``window`` tokens is one window, met by its tokens in lower case. Items of fewer than SHORTEST tokens, null and empty ones are never found. A very
    long text is cut into its windows by one task. Items that share an item_id are one item per text. Null ids are kept as such.
    """
    given = docs.select(F.col(f"`{doc_id}`").alias("id"), fingerprint(F.col(f"`{text}`")).alias("tag"), F.col(f"`{text}`").alias("text"))
    items = benchmark.select("item_id", fingerprint(F.col("text")).alias("item_tag"), tokens(F.col("text")).alias("item_toks")).distinct()
    items = items.withColumn("codes", template(F.col("item_toks"))).withColumn("item_tokens", F.size("codes"))
    items = stored(items.where(F.col("item_tokens") >= SHORTEST), "items")
    known = stored(_item_windows(items, window), "item-windows")
    exact_sizes = sorted(r["form"] for r in known.where("form > 0").select("form").distinct().collect())  # at most ``window`` numbers
    side = F.broadcast(known) if known.count() <= SMALL_SIDE_ROWS else known

    least = min([*exact_sizes, window])
    seen = given.select("id", "tag", tokens(F.col("text")).alias("toks")).where(F.size("toks") >= least)
    codes = template(F.col("toks"))
    seen = seen.select("id", "tag", codes.alias("codes"), *([_exact(F.col("toks")).alias("exact")] if exact_sizes else []))

    def placed(hashed: str, form: int) -> Column:
        hashes = _windows(F.col(hashed), form or window)
        found = F.transform(hashes, lambda h, i: F.struct(F.lit(form).alias("form"), i.alias("at"), h.alias("hash")))
        return F.coalesce(found, F.array().cast("array<struct<form:int,at:int,hash:bigint>>"))

    windows = placed("codes", 0)
    if exact_sizes:
        windows = F.concat(windows, *[placed("exact", k) for k in exact_sizes])
    seen = seen.select("id", "tag", F.explode(windows).alias("w")).select("id", "tag", "w.form", "w.at", "w.hash")
    met = seen.join(side, ["form", "hash"])
    overlaps = met.groupBy("id", "tag", "item_id", "item_tag", "item_tokens", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.array_sort(F.collect_set("item_at")).alias("ats")  # at most one entry per token of the item
    )
    reach = F.least(F.lit(window), F.col("item_tokens"))
    gaps = F.transform(
        F.col("ats"), lambda a, i: F.least(reach, F.coalesce(F.get(F.col("ats"), i + 1) - a, reach))
    )
    overlaps = overlaps.withColumn("n_tokens", F.aggregate(gaps, F.lit(0), lambda x, g: x + g))
    overlaps = stored(overlaps.where(F.col("n_tokens") >= F.least(F.lit(overlap), F.col("item_tokens"))), "overlaps")

    slots = items.select("item_id", "item_tag", F.posexplode("codes").alias("place", "kind"), "item_toks").where(F.col("kind").isin(NUMBER, UNIT, NAME))
    slots = slots.select("item_id", "item_tag", "place", "kind", F.get("item_toks", F.col("place")).alias("item_value"))
    covered = F.exists("ats", lambda a: (F.col("place") >= a) & (F.col("place") < a + window))
    key = ["id", "tag", "item_id", "item_tag", "shift"]
    used = overlaps.join(slots, ["item_id", "item_tag"]).where(covered).select(*key, "place", "kind", "item_value")
    used = stored(used, "slots")
    rows = stored(used.select(F.col("id").alias("of_id"), F.col("tag").alias("of_tag")).distinct(), "slot-rows")
    texts = given.join(small_or_shuffled(rows), F.expr("id <=> of_id and tag = of_tag"), "left_semi").dropDuplicates(["id", "tag"])
    texts = texts.select(F.col("id").alias("of_id"), F.col("tag").alias("of_tag"), tokens(F.col("text")).alias("toks"))
    pairs = used.join(texts, F.expr("id <=> of_id and tag = of_tag")).select(
        *key, F.struct("kind", _bare(F.col("item_value")).alias("v")).alias("theirs"), F.struct("kind", _bare(F.get("toks", F.col("place") + F.col("shift"))).alias("v")).alias("ours")
    )
    judged = pairs.groupBy(*key).agg(
        F.count("*").alias("n_slots"),
        F.count_distinct("theirs", "ours").alias("pairs"),
        F.count_distinct("theirs").alias("of_item"),
        F.count_distinct("ours").alias("of_doc"),
        F.min(F.col("theirs") == F.col("ours")).alias("same_values"),
    )
    on = [overlaps[c].eqNullSafe(judged[c]) for c in key]
    joined = overlaps.join(judged, on, "left").where("n_slots is null or (pairs = of_item and pairs = of_doc)")
    first = F.element_at(overlaps["ats"], 1)
    return joined.select(
        overlaps["id"].alias(doc_id),
        overlaps["tag"],
        overlaps["item_id"],
        (first + overlaps["shift"]).cast("bigint").alias("doc_start"),
        first.cast("bigint").alias("item_start"),
        overlaps["n_tokens"].cast("bigint").alias("n_tokens"),
        overlaps["item_tokens"].cast("bigint").alias("item_tokens"),
        F.coalesce(judged["n_slots"], F.lit(0)).cast("bigint").alias("n_slots"),
        F.coalesce(judged["same_values"], F.lit(True)).alias("same_values"),
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options: int) -> DataFrame:
    """The rows of ``docs`` that overlap with no benchmark item, all columns as they were."""
    leaks = leaked_items(docs, benchmark, doc_id=doc_id, text=text, **options)
    of_id, of_tag = free_names(docs, "_leaked_id", "_leaked_tag")
    leaks = stored(leaks.select(F.col(f"`{doc_id}`").alias(of_id), F.col("tag").alias(of_tag)).distinct(), "leaked")
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col(of_id)) & (fingerprint(F.col(f"`{text}`")) == F.col(of_tag))
    return docs.join(small_or_shuffled(leaks), same, "left_anti")
