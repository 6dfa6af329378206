"""Packing along a space-filling curve: neighbouring documents share sequences of tokens.

Token counts of a document, hashed into a fixed number of signed buckets, are projected to three
dimensions by a fixed random matrix; the cell there has a Hilbert key. In key order the
documents form one stream of tokens, cut every ``length`` tokens. Only small rows take part
in the order: places come from running sums in key ranges and the ranges' totals.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from plumbline.llm.common import fingerprint, small_or_shuffled, stored, text_bytes, text_chunks
from plumbline.llm.words import cut_strings, gathered

DIMENSIONS, DIMENSION_BITS = 3, 10
VECTOR_BITS = 9  # buckets of a hashed document vector
SEED = 20_240
CHUNK = 24 << 20  # bytes of text whose distinct words are encoded together
ENCODED_AT_ONCE, WORDS_AT_ONCE, TEXTS_AT_ONCE = 20_000, 1_000, 512
END = 2  # the token behind each document


def hilbert_key(cells: np.ndarray, bits: int = DIMENSION_BITS) -> np.ndarray:
    """Place on the Hilbert curve of points (rows x dimensions, integers below 2**bits)."""
    x = cells.T.astype(np.int64).copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for i in range(n):
            high = (x[i] & bit) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(high, below, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] & (1 << level)) != 0, (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


class WordEncoder:
    """Token ids of texts, each distinct word between ASCII white space encoded once per chunk.

    For tokenizers that drop white space, lower-case, never join characters across white space and part letters from
    punctuation.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; more threads hold more memory
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        # tokens that close a word, if the tokenizer marks them
        self.closes = None
        if suffix:
            vocabulary = self.tokenizer.get_vocab()
            self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
            self.closes[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _ids(self, strings: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]

    def _encoded(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begin, size) of strings, a bounded number at a time.

        Words of lower-case letters alone are encoded as one text and told apart by the tokens that close a word.
        """
        begin, size = np.zeros(len(strings), np.int64), np.zeros(len(strings), np.int64)
        plain = pc.match_substring_regex(strings, r"^[\p{Ll}\p{Lo}]+$").to_numpy(zero_copy_only=False) & (self.closes is not None)
        tables, done = [np.zeros(0, np.uint32)], 0
        single = [np.flatnonzero(~plain)]
        rows = np.flatnonzero(plain)
        for at in range(0, len(rows), WORDS_AT_ONCE):
            part = rows[at : at + WORDS_AT_ONCE]
            ids = np.array(self._ids([" ".join(strings.take(pa.array(part)).to_pylist())])[0], np.uint32)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(part) or ends[-1] != len(ids):  # some word is no single one to the tokenizer
                single.append(part)
                continue
            size[part] = np.diff(ends, prepend=0)
            begin[part] = done + ends - size[part]
            tables.append(ids)
            done += len(ids)
        rows = np.concatenate(single)
        for at in range(0, len(rows), ENCODED_AT_ONCE):
            part = rows[at : at + ENCODED_AT_ONCE]
            lists = self._ids(strings.take(pa.array(part)).to_pylist())
            size[part] = np.fromiter(map(len, lists), np.int64, len(lists))
            begin[part] = done + np.cumsum(size[part]) - size[part]
            tables.append(np.fromiter(chain.from_iterable(lists), np.uint32, int(size[part].sum())))
            done += len(tables[-1])
        return np.concatenate(tables), begin, size

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of distinct words; closing marks behind a letter or digit are encoded apart."""
        data, offsets = text_bytes(words)
        marked = pc.match_substring_regex(words, "[0-9a-z][.,!?;:]+$")
        cores = pc.if_else(marked, pc.ascii_rtrim(words, characters=".,!?;:"), words)
        edge = offsets[:-1] + pc.binary_length(cores).to_numpy()
        begins, sizes, tables, done = [], [], [], 0
        for strings in (cores, cut_strings(data, edge, offsets[1:])):
            coded = strings.dictionary_encode()
            ids, begin, size = self._encoded(coded.dictionary)
            of_word = coded.indices.to_numpy()
            begins.append(begin[of_word] + done)
            sizes.append(size[of_word])
            tables.append(ids)
            done += len(ids)
        at, bounds = gathered(np.column_stack(sizes).ravel(), np.column_stack(begins).ravel())
        return np.concatenate(tables)[at], bounds[::2]

    def __call__(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first text, text behind, their ids, offsets) of consecutive groups of texts, END after each text."""
        listed = pc.ascii_split_whitespace(texts)
        counts = pc.list_value_length(listed).to_numpy()
        coded = listed.flatten().dictionary_encode()
        places, words = coded.indices.to_numpy(), coded.dictionary
        # the tokenizer lower-cases anyhow, but knows the exact spelling of its special tokens
        lowered = pc.if_else(pc.match_substring(words, "<|"), words, pc.ascii_lower(words)).dictionary_encode()
        table, bounds = self._of_words(lowered.dictionary)
        lookup = lowered.indices.to_numpy()
        table = np.append(table, np.uint32(END))
        first = np.concatenate(([0], np.cumsum(counts)))
        for a in range(0, len(texts), TEXTS_AT_ONCE):
            b = min(a + TEXTS_AT_ONCE, len(texts))
            of_word = lookup[places[first[a] : first[b]]]
            # END counts as one more word of each text
            ends = first[a + 1 : b + 1] - first[a] + np.arange(b - a)
            is_word = np.ones(len(of_word) + b - a, bool)
            is_word[ends] = False
            begin, size = np.full(len(is_word), len(table) - 1), np.ones(len(is_word), np.int64)
            begin[is_word], size[is_word] = bounds[of_word], bounds[of_word + 1] - bounds[of_word]
            at, out = gathered(size, begin)
            yield a, b, table[at], np.concatenate(([0], out[ends + 1]))


def curve_keys(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hilbert keys of documents from their token ids (each has at least one)."""
    draw = np.random.Generator(np.random.PCG64(SEED))
    matrix = draw.standard_normal((1 << VECTOR_BITS, DIMENSIONS)) / np.sqrt(DIMENSIONS)
    scrambled = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    bucket = (scrambled >> np.uint64(64 - VECTOR_BITS)).astype(np.int64)
    sign = 1.0 - 2.0 * ((scrambled >> np.uint64(30)) & np.uint64(1)).astype(np.float64)
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    counts = np.bincount((owner << VECTOR_BITS) | bucket, weights=sign, minlength=n << VECTOR_BITS).reshape(n, -1)
    norm = np.maximum(np.sqrt((counts**2).sum(axis=1, keepdims=True)), 1e-12)
    point = (counts / norm) @ matrix * np.sqrt(DIMENSIONS)  # about standard normal in each dimension
    top = (1 << DIMENSION_BITS) - 1
    return hilbert_key(np.clip(((np.tanh(point) + 1) / 2 * top).astype(np.int64), 0, top))


def _encode(path: str):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path)
        for batch in batches:
            for at, texts in text_chunks(batch.column(2), CHUNK):
                for a, b, ids, offsets in encoder(texts):
                    keys = curve_keys(ids, offsets)
                    packed = ids.astype("<u2") if ids.max() < 1 << 16 else ids.astype("<u4")
                    width = packed.dtype.itemsize
                    blobs = pa.LargeBinaryArray.from_buffers(
                        pa.large_binary(), b - a, [None, pa.py_buffer(offsets * width), pa.py_buffer(packed.tobytes())]
                    )
                    own = batch.slice(at + a, b - a)
                    yield pa.RecordBatch.from_arrays(
                        [own.column(0), own.column(1), pa.array(keys), pa.array(np.diff(offsets)), pa.array(np.full(b - a, width)), blobs.cast(pa.binary())],
                        names=["id", "tag", "key", "n", "width", "ids"],
                    )
                pa.default_memory_pool().release_unused()

    return go


def _cut(length: int, with_ids: bool):
    """Batches of (id, place in the stream, width, ids) to pieces."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list[int]] = [[] for _ in range(7)]
            raws = []
            places, widths = (batch.column(k).to_pylist() for k in (1, 2))
            for i, (place, width, blob) in enumerate(zip(places, widths, batch.column(3), strict=True)):
                ids = np.frombuffer(blob.as_buffer(), "<u2" if width == 2 else "<u4").astype("<u4")
                begin = 0
                while begin < len(ids):
                    sequence, offset = divmod(place + begin, length)
                    end = min(len(ids), begin + length - offset)
                    raw = memoryview(ids[begin:end]).cast("B")
                    for row, value in zip(rows, (i, begin, end - begin, zlib.crc32(raw), len(ids), sequence, offset), strict=True):
                        row.append(value)
                    if with_ids:
                        raws.append(raw.tobytes())
                    begin = end
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows[0], pa.int64())),
                    *(pa.array(r, pa.int64()) for r in rows[1:]),
                    *([pa.array(raws, pa.binary())] if with_ids else []),
                ],
                names=["id", *NUMBERS, *(["token_ids"] if with_ids else [])],
            )

    return go


NUMBERS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def packed(
    docs: DataFrame, tokenizer: str, length: int = 4096, with_ids: bool = True, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pieces (id, start, length, ids_crc32, doc_tokens, sequence_id, offset, token_ids) of sequences of ``length`` tokens.

    ``tokenizer`` is the path of a tokenizer file on every executor. A null text is an empty one: its only token
    is END. Only the last sequence is not full. ``token_ids`` holds the piece's ids as unsigned 32-bit
    little-endian integers, and is left out without ``with_ids``. Equal keys are ordered by id, then by a fingerprint of the text; repeated rows and
    rows without id are documents of their own. Other columns are not read.
    """
    spark = docs.sparkSession
    id_type = docs.schema[doc_id].dataType.simpleString()
    given = docs.select(F.col(f"`{doc_id}`").alias("id"), fingerprint(F.col(f"`{text}`")).alias("tag"), F.col(f"`{text}`").alias("text"))
    coded = given.mapInArrow(_encode(tokenizer), f"id {id_type}, tag long, key long, n long, width long, ids binary")
    coded = stored(coded.withColumn("row", F.monotonically_increasing_id()), "encoded")

    order = ["key", "id", "tag", "row"]
    ranged = coded.select(*order, "n").repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "ranged")
    totals = ranged.groupBy("part").agg(F.sum("n").alias("tokens")).orderBy("part").collect()  # a row per key range
    before, done = [], 0
    for t in totals:
        before.append((t["part"], done))
        done += t["tokens"]
    bases = spark.createDataFrame(before, "part int, base long")
    running = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    places = ranged.withColumn("inner", F.coalesce(F.sum("n").over(running), F.lit(0))).join(F.broadcast(bases), "part")
    places = stored(places.select("row", (F.col("base") + F.col("inner")).alias("place")), "places")
    placed = coded.join(small_or_shuffled(places), "row").select("id", "place", "width", "ids")
    schema = f"id {id_type}, {', '.join(f'{c} long' for c in NUMBERS)}" + (", token_ids binary" if with_ids else "")
    return placed.mapInArrow(_cut(length, with_ids), schema).withColumnRenamed("id", doc_id)
