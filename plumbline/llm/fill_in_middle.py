"""Fill-in-the-middle transformation: a text is cut at two unit boundaries and its middle moves to the end.

The boundaries of a slice of texts form one set of byte positions (``boundary_set``); both cuts of every text are read from it by
rank. Spark cuts, joins and restores the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.boundary_set import BoundarySet
from plumbline.llm.common import text_bytes, text_chunks
from plumbline.llm.words import SPACE

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
WORDS, CHARACTERS = "words", "characters"
CUTS = "n long, prefix_chars long, middle_chars long"
ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


def unit_ends(data: np.ndarray, offsets: np.ndarray, unit: str = WORDS) -> np.ndarray:
    """Positions behind every unit of the texts data[offsets[i]:offsets[i + 1]], ascending.

    A word takes the white space before it; white space at the end of a text is a unit of its own. An empty text has none.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    ends = np.zeros(n + 1, bool)
    if unit == WORDS:
        space = SPACE[data]
        ends[1:n] = ~space[:-1] & space[1:]
    else:
        ends[:n] = (data & 0xC0) != 0x80
    ends[offsets] = True
    ends[0] = False
    return np.flatnonzero(ends)


def cut_places(texts: pa.Array, one: np.ndarray, two: np.ndarray, unit: str = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(units, code points of the prefix, code points of the middle) of texts without nulls and their two draws."""
    data, offsets = text_bytes(texts)
    ends = unit_ends(data, offsets, unit)
    first = np.searchsorted(ends, offsets, side="right")
    n = np.diff(first)
    one, two = one % (n + 1), two % (n + 1)
    boundaries = BoundarySet(ends)
    edges = [offsets[:-1]]
    for units in (np.minimum(one, two), np.maximum(one, two)):
        place = offsets[:-1].copy()
        cut = units > 0
        place[cut] = boundaries.select(first[:-1][cut] + units[cut] - 1)
        edges.append(place)
    before = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    begin, low, high = (before[e] for e in edges)
    return n, low - begin, high - low


def _cuts(unit: str):
    def go(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, one, two in batches:
            one, two = one.to_numpy(zero_copy_only=False), two.to_numpy(zero_copy_only=False)
            parts = []
            for begin, some in text_chunks(texts):
                end = begin + len(some)
                found = cut_places(some, one[begin:end], two[begin:end], unit)
                parts.append([pa.array(f.astype(np.int64)) for f in found])
            joined = [pa.concat_arrays(c) for c in zip(*parts, strict=True)] if parts else [pa.array([], pa.int64())] * 3
            yield pa.StructArray.from_arrays(joined, names=["n", "prefix_chars", "middle_chars"])

    # evaluated by Spark as types, which the names of this module's annotations are not
    go.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(go, CUTS)


def draw(seed: int, doc_id: Column, k: int) -> Column:
    """The k-th unsigned 32-bit number (from 1) that a seed gives for an id; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("bigint")


def fill_in_middle(
    docs: DataFrame,
    seed: int = 42,
    rate: int = 50,
    suffix_first: int = 80,
    unit: str = WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``docs`` with n (units), form, prefix_chars, middle_chars (code points) and output.

    ``rate`` percent of the texts are transformed, ``suffix_first`` percent of these in form spm, the others in form psm. The cuts
    depend on seed, id and number of units alone, so any split of the rows gives the same result. Empty texts and texts that
    hold a marker stay as they are (form plain, no counts); a null text counts as an empty one. Rows that share an id, or have none, draw
    alike. Texts are cut whole, a very long one by itself in one slice. Columns of the input named like an added one
    are replaced; all others stay.
    """
    key, value = F.col(f"`{doc_id}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    given = docs.select(row, value.alias("value"), *[draw(seed, key, k).alias(f"h{k}") for k in (1, 2, 3, 4)])
    marked = F.col("value").contains(PREFIX) | F.col("value").contains(SUFFIX) | F.col("value").contains(MIDDLE)
    plain = (F.col("value") == "") | marked | (F.col("h3") % 100 >= rate)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < suffix_first, "spm").otherwise("psm")
    cut = given.select("row", "value", form.alias("form"), _cuts(unit)("value", "h1", "h2").alias("cuts"))
    head, inner = F.col("cuts.prefix_chars").cast("int"), F.col("cuts.middle_chars").cast("int")
    prefix, middle = F.substring("value", F.lit(1), head), F.substring("value", head + 1, inner)
    suffix = F.substring("value", head + inner + 1, F.length("value"))
    output = (
        F.when(F.col("form") == "plain", F.col("value"))
        .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
    )
    moved = F.col("form") != "plain"
    return cut.select(
        *[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ADDED],
        F.col("cuts.n").alias("n"),
        "form",
        F.when(moved, F.col("cuts.prefix_chars")).alias("prefix_chars"),
        F.when(moved, F.col("cuts.middle_chars")).alias("middle_chars"),
        output.alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` was given. A transformed text holds no marker of its own."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    return (
        F.when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .otherwise(output)
    )
