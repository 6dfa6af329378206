"""Divergence of the sources of a language: how far each source's term shares are from those of the others.

Terms are counted per shard by sorting pointers to their first bytes in the Arrow buffers (``token_sort``); equal runs give the
counts and document frequencies by source, which Spark adds up. All shares and divergences are whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.llm.common import small_or_shuffled, stored, text_bytes, text_chunks
from plumbline.llm.token_sort import LETTERS, Letters, multikey_sort, token_pointers
from plumbline.llm.words import LOWER, gathered

LEAST_DOCS = 3  # documents of a language that hold a kept term
TOP = 200  # terms reported of a source
SHARD_BYTES = 16 << 20  # text sorted at once
PAIRS = 1 << 20  # pairs of sources of a term evaluated at once
UNIT = 1_000_000_000

COUNTED = "lang string, source string, term string, n long, docs long"
SUMMED = "lang string, source string, item string, value long"


def term_runs(texts: pa.Array, group: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(term, group, count, texts that hold it) of every term in every group of the texts (no nulls), A-Z lower-cased."""
    raw, offsets = text_bytes(texts)
    starts, ends = token_pointers(raw, offsets, LETTERS)
    if len(starts) == 0:
        none = np.zeros(0, np.int64)
        return pa.array([], pa.string()), none, none, none
    data = LOWER[raw]
    text = np.searchsorted(offsets, starts, side="right") - 1
    by_group = np.argsort(group[text], kind="stable")  # equal tokens then lie by group, and in a group by text
    order, fresh = multikey_sort(Letters(data, starts, ends), by_group)
    text = text[order]
    owner = group[text]
    fresh[1:] |= owner[1:] != owner[:-1]
    other = fresh.copy()
    other[1:] |= text[1:] != text[:-1]
    begin = np.flatnonzero(fresh)
    count = np.diff(np.append(begin, len(order)))
    held = np.add.reduceat(other.astype(np.int64), begin)
    at = order[begin]
    places, bounds = gathered(ends[at] - starts[at], starts[at])
    terms = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[places].tobytes()))
    return terms.cast(pa.string()), owner[begin], count, held


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (lang, source, text) to partial counts, a shard of about SHARD_BYTES of text at a time."""
    held: list[pa.RecordBatch] = []
    size = 0

    def sorted_() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        for begin, texts in text_chunks(rows.column(2), SHARD_BYTES):
            some = rows.slice(begin, len(texts))
            names = [some.column(k).dictionary_encode() for k in (0, 1)]
            sources = len(names[1].dictionary)
            group = names[0].indices.to_numpy().astype(np.int64) * sources + names[1].indices.to_numpy()
            term, of, n, docs = term_runs(texts, group)
            for a in range(0, len(of), 1 << 16):  # batches that Spark can read in bounded memory
                b = a + (1 << 16)
                lang, source = (names[k].dictionary.take(pa.array(i)) for k, i in ((0, of[a:b] // sources), (1, of[a:b] % sources)))
                yield pa.RecordBatch.from_arrays([lang, source, term[a:b], pa.array(n[a:b]), pa.array(docs[a:b])], names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        held.append(batch)
        size += batch.column(2).nbytes
        if size >= SHARD_BYTES:
            yield from sorted_()
            held, size = [], 0
    if held:
        yield from sorted_()


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, [(source, p, p0)]) of terms to sums by pair of sources, over the terms that both hold.

    A term that both hold adds its divergence, less what it would add if one or the other, and plus what it would add if neither
    held it; the rest of the sum is made from counts (see ``divergences``). Pairs of a block of terms are
    added up here, so that at most one row a pair and block leaves the task.
    """
    for batch in batches:
        lang = batch.column(0).dictionary_encode()
        lists = batch.column(1)
        values = lists.flatten()
        source = values.field(0).dictionary_encode()
        names, index = source.dictionary, source.indices.to_numpy().astype(np.int64)
        p, p0 = (values.field(k).to_numpy(zero_copy_only=False) for k in (1, 2))
        size = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        begin = np.cumsum(size) - size
        # an entry meets all entries of its term: blocks of entries, with their terms' sizes, of at most PAIRS pairs (or one entry)
        mine, theirs = np.repeat(size, size), np.repeat(begin, size)
        of_lang = np.repeat(lang.indices.to_numpy().astype(np.int64), size)
        upto = np.cumsum(mine)
        a = 0
        while a < len(mine):
            b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + PAIRS, side="right")))
            right, _ = gathered(mine[a:b], theirs[a:b])
            left = np.repeat(np.arange(a, b), mine[a:b])
            apart = left != right
            left, right = left[apart], right[apart]
            value = divergence(p[left], p[right]) - divergence(p[left], p0[right]) - divergence(p0[left], p[right]) + divergence(p0[left], p0[right])
            key = (of_lang[left] * len(names) + index[left]) * len(names) + index[right]
            pair, at = np.unique(key, return_inverse=True)
            sums = np.zeros(len(pair), np.int64)
            np.add.at(sums, at, value)
            columns = [lang.dictionary.take(pa.array(pair // len(names) ** 2)), names.take(pa.array(pair // len(names) % len(names))), names.take(pa.array(pair % len(names)))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sums)], names=["lang", "source", "item", "value"])
            a = b


def _share(count: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / (total + kinds)), exact for any counts."""
    top = (F.lit(UNIT).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")).alias("top")
    return F.call_function("div", top, (total + kinds).cast("decimal(20,0)")) + 1


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) over rows (lang, source, text) without nulls."""
    counted = docs.select("lang", "source", "text").mapInArrow(_counted, COUNTED)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def source_divergences(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): how far a source is from each other source of its language, and by which terms from all.

    ``docs`` has lang, source and a text; nulls of all three are read as ''. Every row is a document, repeated ones too. A
    language keeps the terms that ``least_docs`` of its documents hold. Part ``pair`` has a row for each other source, over all kept terms;
    a source without terms has one too, and without kept terms the value is 0. Part ``term`` has the ``top`` terms that a
    source uses more than its language does. Ties go to the smaller item by its bytes. Whole texts are read; a very long one is
    sorted as a shard of its own. An empty table gives no rows; other columns are not read.
    """
    read = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in (("lang", "lang"), ("source", "source"), (f"`{text}`", "text"))]
    given = docs.select(*read)
    # one row a term of a language; its list has an entry a source
    kept = term_counts(given).groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.collect_list(F.struct("source", "n")).alias("held")
    )
    kept = stored(kept.where(F.col("docs") >= least_docs).drop("docs"), "kept-terms")
    used = kept.select("lang", "term", "lang_n", F.inline("held"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    sums = used.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("present"))
    groups = given.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["total", "present", "v", "lang_total"])
    p0 = F.when(F.col("v") > 0, _share(F.lit(0), F.col("total"), F.greatest("v", F.lit(1)))).otherwise(1)
    groups = stored(groups.withColumn("p0", p0), "sources")  # a row a source: the result has the square of them

    shares = used.join(small_or_shuffled(groups), ["lang", "source"])
    shares = stored(
        shares.select(
            "lang", "source", "term", "n", "p0",
            _share(F.col("n"), F.col("total"), F.col("v")).alias("p"),
            _share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q"),
        ),
        "shares",
    )
    pairs = _pair_sums(shares, groups)
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))
    terms = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)  # cut inside each task first
    return pairs.unionByName(terms)


def _pair_sums(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language.

    With f the divergence, p a term's share where a source holds it and p0 where it doesn't, the sum over all V kept terms is that
    of f(p, p0) over the terms of the one, of f(p0, p) over those of the other, (V - both numbers of terms) times f(p0, p0), and
    a correction by the terms that both hold. The first two depend on counts alone: terms of equal count are one row.
    """
    listed = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("held")).where(F.size("held") > 1)
    both = listed.select("lang", "held").mapInArrow(_shared, SUMMED)
    alike = shares.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("m"))
    others = small_or_shuffled(stored(groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("other_p0")), "others"))
    met = alike.join(others, "lang").where("source <> other")
    p, q = F.col("p"), F.col("p0")
    mine = met.groupBy("lang", "source", F.col("other").alias("item")).agg(F.sum(F.col("m") * _apart(p, F.col("other_p0"))).alias("value"))
    theirs = met.groupBy("lang", F.col("other").alias("source"), F.col("source").alias("item")).agg(F.sum(F.col("m") * _apart(F.col("other_p0"), p)).alias("value"))
    second = groups.select("lang", F.col("source").alias("item"), F.col("present").alias("item_present"), F.col("p0").alias("item_p0"))
    every = groups.join(second, "lang").where("source <> item")
    rest = (F.col("v") - F.col("present") - F.col("item_present")) * _apart(q, F.col("item_p0"))
    every = every.select("lang", "source", "item", F.when(F.col("v") > 0, rest).otherwise(0).cast("bigint").alias("value"))
    parts = both.unionByName(mine).unionByName(theirs).unionByName(every)
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
