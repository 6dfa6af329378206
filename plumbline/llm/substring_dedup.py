"""Substring dedup by sliding sentence spans.

Every run of several consecutive sentences is hashed and counted over all documents; sentences covered by a run that
occurs earlier, in a smaller document id or before in the same text, are removed. A second grid of runs takes no notice of
sentences: it is cut where the words' own hashes say so, so that passages copied from the middle of sentences meet too.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import fingerprint, text_chunks
from plumbline.llm.words import Words, find_words, mix

RUN = 3  # sentences of a run, at least
RUN_WORDS = 8  # words of a run, at least
LONGEST = 12  # words of a sentence that is not cut
CLAUSE = 10  # mean words of a part of a longer one
GRID_WORDS = 20  # words of a run of the second grid, at least
GRID_AHEAD = 12  # a run of it begins at a word whose hash is the least of itself and so many words behind it

_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?"]] = True
_CLOSERS = np.zeros(256, bool)
_CLOSERS[[ord(c) for c in "\"')]}"]] = True
_STEPS = (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93)  # odd multipliers of two independent hashes


class Runs(NamedTuple):
    cut: np.ndarray  # first word of each sentence, and behind the last
    first: np.ndarray  # number of sentences before each text, and of all
    begin: np.ndarray  # first word of each run
    end: np.ndarray  # word behind each run
    text: np.ndarray  # text of each run
    key: np.ndarray  # hash of each run
    check: np.ndarray  # second, shorter hash
    fresh: np.ndarray  # whether the run is the first of its text with that key
    again: np.ndarray  # whether the run repeats an earlier one of its text


def _sentence_cuts(words: Words) -> np.ndarray:
    """Indexes of words that begin a sentence.

    A sentence ends at a word that closes with . ! or ? (quotes and brackets may follow), at a line end and at the end of
    the text. One of more than LONGEST words is cut behind every word whose own hash says so, and
    after 4 * CLAUSE words at most, so that copied words are cut alike wherever the sentence began.
    """
    n = len(words.starts)
    last = words.data[words.ends - 1]
    before = words.data[np.maximum(words.ends - 2, words.starts)]
    ends = _ENDS[last] | (_CLOSERS[last] & _ENDS[before])
    lines = np.searchsorted(np.flatnonzero((words.data == 10) | (words.data == 13)), words.starts)
    ends[:-1] |= lines[1:] > lines[:-1]
    begins = np.zeros(n, bool)
    begins[1:] = ends[:-1]
    begins[words.first[:-1][words.first[:-1] < n]] = True
    at = np.flatnonzero(begins)
    sizes = np.diff(np.append(at, n))
    chosen = np.zeros(n, bool)
    chosen[1:] = words.hashes[:-1] % np.uint64(CLAUSE) == 0
    begins |= chosen & np.repeat(sizes > LONGEST, sizes)
    at = np.flatnonzero(begins)
    inside = np.arange(n) - np.repeat(at, np.diff(np.append(at, n)))
    return np.flatnonzero(inside % (4 * CLAUSE) == 0)


def _span_hashes(hashes: np.ndarray, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    up, down = np.full(len(hashes) + 1, step, np.uint64), np.full(len(hashes) + 1, pow(step, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    up, down = np.cumprod(up), np.cumprod(down)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * up[:-1])))
    return mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))


def _grid_runs(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(first words, words behind) of the second grid's runs, whatever the sentences.

    Parts end before a word whose hash is less than its neighbours'; a run is the parts from its first word on that hold
    GRID_WORDS words. Where it begins and ends depends on its own words and on one beside it, so any place of a copied passage
    is cut alike but for its edges.
    """
    h, n = words.hashes, len(words.starts)
    least = np.ones(n, bool)
    for k in range(1, min(GRID_AHEAD, n - 1) + 1):
        least[:-k] &= h[:-k] <= h[k:]
    behind = np.repeat(words.first[1:], np.diff(words.first))
    begin = np.flatnonzero(least & (np.arange(n) + GRID_WORDS <= behind))
    part = np.zeros(n + 1, bool)
    part[begin] = True
    part[1 : n - 1] |= (h[1:-1] < h[:-2]) & (h[1:-1] <= h[2:])
    part[words.first] = True
    part = np.flatnonzero(part)
    return begin, part[np.searchsorted(part, begin + GRID_WORDS)]


def find_runs(texts: pa.Array, run: int = RUN, run_words: int = RUN_WORDS) -> tuple[Words, Runs]:
    """The shortest run of at least ``run`` sentences and ``run_words`` words from every sentence on, and the second grid's runs.

    A text too short for any such run of sentences is one run if it has ``run_words`` words. A run of the second grid counts as
    repeated in its text only where it begins behind the first one's end.
    """
    words = find_words(texts)
    n = len(words.starts)
    none = np.zeros(0, np.int64)
    if n == 0:
        return words, Runs(np.zeros(1, np.int64), np.zeros(len(texts) + 1, np.int64), none, none, none, none, none, none > 0, none > 0)
    cut = np.append(_sentence_cuts(words), n)
    first = np.searchsorted(cut, words.first)
    m = len(cut) - 1
    begin = np.arange(m)
    text = np.searchsorted(first, begin, side="right") - 1
    end = np.maximum(begin + run, np.searchsorted(cut, cut[:-1] + run_words))
    fits = end <= first[text + 1]
    whole = np.flatnonzero(np.diff(words.first) >= run_words)
    if len(whole):
        has = np.zeros(len(texts), bool)
        has[text[fits]] = True
        short = whole[~has[whole]]
        fits[first[short]] = True
        end[first[short]] = first[short + 1]
    grid_begin, grid_end = _grid_runs(words)
    free = np.repeat([False, True], [int(fits.sum()), len(grid_begin)])  # of the second grid
    begin, end = np.concatenate((cut[begin[fits]], grid_begin)), np.concatenate((cut[end[fits]], grid_end))
    text = np.concatenate((text[fits], np.searchsorted(words.first, grid_begin, side="right") - 1))
    # equal words are other keys in the other grid
    key, check = (np.where(free, mix(k), k) for k in (_span_hashes(words.hashes, begin, end, s) for s in _STEPS))
    order = np.lexsort((begin, key, text))
    begin, end, text, key, check, free = (x[order] for x in (begin, end, text, key, check, free))
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    original = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    again = ~fresh & (~free | (begin >= end[original]))
    check = (check >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return words, Runs(cut, first, begin, end, text, key.view(np.int64), check, fresh, again)


def _runs_of(run: int, run_words: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in text_chunks(batch.column(2)):
                _, found = find_runs(texts, run, run_words)
                fresh = found.fresh
                rows = pa.array(found.text[fresh] + begin)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.key[fresh]), pa.array(found.check[fresh]), batch.column(0).take(rows), batch.column(1).take(rows)],
                    names=["key", "chk", "id", "tag"],
                )

    return go


def _without_marked(run: int, run_words: int):
    """Batches of (row, text, keys of runs to go) to (row, text left, n_sentences, n_removed)."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given, marks = batch.column(1), batch.column(2)
            for at, texts in text_chunks(given):
                words, found = find_runs(texts, run, run_words)
                marked = found.again.copy()
                of_text = np.searchsorted(found.text, np.arange(len(texts) + 1))
                listed = marks.slice(at, len(texts))
                for i in np.flatnonzero(listed.is_valid().to_numpy(zero_copy_only=False)):
                    a, b = of_text[i], of_text[i + 1]
                    marked[a:b] |= np.isin(found.key[a:b], listed[int(i)].values.to_numpy())
                change = np.zeros(len(words.starts) + 1, np.int64)
                np.add.at(change, found.begin[marked], 1)
                np.add.at(change, found.end[marked], -1)
                gone = np.cumsum(change) > 0  # by word
                touched = np.logical_or.reduceat(gone[:-1], found.cut[:-1]) if len(words.starts) else np.zeros(0, bool)
                before = np.concatenate(([0], np.cumsum(touched)))
                removed = before[found.first[1:]] - before[found.first[:-1]]
                turns = np.flatnonzero(gone[1:] != gone[:-1]) + 1
                left = given.slice(at, len(texts))
                if removed.any():
                    left = left.to_pylist()
                    offsets = np.concatenate(([0], np.cumsum(pa.compute.binary_length(texts).to_numpy())))
                    for i in np.flatnonzero(removed):
                        raw = left[i].encode()
                        a, b = words.first[i], words.first[i + 1]
                        at_words = np.concatenate(([a], turns[np.searchsorted(turns, a + 1) : np.searchsorted(turns, b)]))
                        edges = np.append(words.starts[at_words] - offsets[i], len(raw))
                        parts = [raw[: edges[0]]]
                        parts += [raw[edges[k] : edges[k + 1]] for k, g in enumerate(gone[at_words]) if not g]
                        left[i] = b"".join(parts).decode()
                    left = pa.array(left, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), left, pa.array(np.diff(found.first)), pa.array(removed)],
                    names=["row", "text", "n_sentences", "n_removed"],
                )

    return go


def without_repeated_spans(
    docs: DataFrame, run: int = RUN, run_words: int = RUN_WORDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with the text left after removal, and n_sentences, n_removed (sentences that lost words) as longs.

    Words are compared with A-Z lower-cased, whatever white space stands between them. The
    occurrence in the smallest id stays; within one text, the first. Rows without an id come after all others, by a
    fingerprint of their text. Rows that share an id count as one document: none removes from the other.
    Null texts stay null, with no sentences; a text that loses all sentences keeps its
    leading white space only. Untouched texts come back byte for byte. Columns of the
    input named like the two added ones are replaced; all others stay.
    """
    key_id, value = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    id_type = docs.schema[doc_id].dataType.simpleString()
    tag = F.when(key_id.isNull(), fingerprint(value)).otherwise(F.lit(0).cast("bigint"))
    given = docs.select(key_id.alias("id"), tag.alias("tag"), value.alias("text"))
    runs = given.mapInArrow(_runs_of(run, run_words), f"key long, chk int, id {id_type}, tag long")
    unnamed = F.when(F.isnull("id"), F.col("tag"))
    shared = runs.groupBy("key", "chk").agg(
        F.count("*").alias("n"), F.min("id").alias("first_id"), F.min(unnamed).alias("first_tag")
    )
    later = F.when(F.col("first_id").isNotNull(), F.isnull("id") | (F.col("id") > F.col("first_id"))).otherwise(
        F.col("tag") > F.col("first_tag")
    )
    marks = (
        runs.join(shared.where("n > 1"), ["key", "chk"])
        .where(later)
        .groupBy(F.col("id").alias("of_id"), F.col("tag").alias("of_tag"))
        .agg(F.collect_list("key").alias("marks"))
    )
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), tag.alias("tag"), value.alias("text"))
    by_id = F.col(f"row.`{doc_id}`").eqNullSafe(F.col("of_id")) & (F.col("tag") == F.col("of_tag"))
    joined = rows.join(marks.hint("shuffle_hash"), by_id, "left").select("row", "text", "marks")
    schema = f"row {rows.schema['row'].dataType.simpleString()}, text string, n_sentences long, n_removed long"
    left = joined.mapInArrow(_without_marked(run, run_words), schema)
    added = ("n_sentences", "n_removed")
    return left.select(
        *[(F.col("text") if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns if c not in added], *added
    )
