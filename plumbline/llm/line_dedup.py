"""Line dedup: lines that several documents hold stay only in the document of the smallest id.

Lines are exploded and normalised, hashes counted by document, and the positions that go come back to their texts. Texts are
shuffled once, in the last join; all before carries numbers only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.common import fingerprint, stored

THRESHOLD = 2  # documents that must hold a line
LEAST_CHARS = 10  # code points of a line that may go
SLICES = 1000  # a line with more than this part of all repeated ones is joined in slices

_BLANKS = " \t\n\x0b\x0c\r"
_UPPER = "".join(map(chr, range(65, 91)))
ADDED = ("n_lines", "n_dropped")


def line_key(line: Column) -> Column:
    """A line without white space at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(_BLANKS)), _UPPER, _UPPER.lower())


def lines_of(text: Column) -> Column:
    """The lines of a text; a null or empty one has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _without(lines: Column, places: Column) -> Column:
    """The lines but those at the ascending places (from 0), joined: the pieces between two places, in linear time."""
    begins = F.concat(F.array(F.lit(0)), F.transform(places, lambda p: p + 1))
    ends = F.concat(places, F.array(F.size(lines)))
    pieces = F.filter(F.arrays_zip(begins.alias("a"), ends.alias("b")), lambda p: p["b"] > p["a"])
    return F.array_join(F.transform(pieces, lambda p: F.array_join(F.slice(lines, p["a"] + 1, p["b"] - p["a"]), "\n")), "\n")


def repeated_lines(lines: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(h1, h2, n, first_id) of the hashes that at least ``threshold`` documents hold, from rows (id, h1, h2).

    Rows without an id count as one document behind all others. Counts are combined in the map tasks.
    """
    unnamed = F.max(F.isnull("id"))
    if threshold == 2:  # two distinct documents hold it exactly if the smallest is not the largest
        several = (F.min("id") < F.max("id")) | (unnamed & F.min("id").isNotNull())
    else:
        several = F.count_distinct("id") + unnamed.cast("int") >= threshold
    found = lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("id").alias("first_id"), several.alias("several"))
    return found.where("several").drop("several")


def without_repeated_lines(
    docs: DataFrame, threshold: int = THRESHOLD, least_chars: int = LEAST_CHARS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with the text left, n_lines (before) and n_dropped as longs.

    A line of at least ``least_chars`` code points (without white space at its ends) that ``threshold`` documents hold, compared
    with A-Z lower-cased, goes from all but the smallest id; there all its places stay. Rows without an id count as one document
    behind all others, rows that share an id as one document. Null texts stay null and count one line. Untouched lines come
    back byte for byte. Lines are known by two 64-bit hashes. A very long text is one row of the last
    join, like in the input. Columns of the input named like the two added ones are replaced; all others stay.
    """
    key_id, value = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    given = docs.select(key_id.alias("id"), fingerprint(value).alias("tag"), F.posexplode(lines_of(value)).alias("pos", "line"))
    key = line_key(F.col("line"))
    lines = given.where(F.length(F.btrim("line", F.lit(_BLANKS))) >= least_chars).select(
        "id", "tag", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")
    )
    repeated = stored(repeated_lines(lines.select("id", "h1", "h2"), threshold), "repeated-lines")
    total = repeated.agg(F.sum("n")).first()[0] or 1
    # at most SLICES lines can reach this share: the list is bounded, and so are their slices, of which there are 2 * SLICES at most
    hot = repeated.where(F.col("n") * SLICES >= total)
    hot = F.broadcast(hot.select("h1", "h2", F.ceil(F.col("n") * SLICES / total).cast("int").alias("slices")))
    slice_ = F.when(F.col("slices").isNull(), 0).otherwise(F.pmod(F.xxhash64("id", "tag", "pos"), "slices")).cast("int")
    places = lines.join(hot, ["h1", "h2"], "left").withColumn("slice", slice_)
    every = F.explode(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1))
    owners = repeated.join(hot, ["h1", "h2"], "left").select("h1", "h2", "first_id", every.alias("slice"))
    later = F.isnull("id") | (F.col("id") > F.col("first_id"))
    gone = (
        places.join(owners, ["h1", "h2", "slice"])
        .where(later)
        .groupBy(F.col("id").alias("of_id"), F.col("tag").alias("of_tag"))
        .agg(F.array_sort(F.collect_set("pos")).alias("places"))
    )
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), fingerprint(value).alias("tag"))
    same = F.col(f"row.`{doc_id}`").eqNullSafe(F.col("of_id")) & (F.col("tag") == F.col("of_tag"))
    joined = rows.join(gone.hint("shuffle_hash"), same, "left").select("row", "places")
    old = F.col(f"row.`{text}`")
    joined = joined.select("row", "places", lines_of(old).alias("lines"))
    left = F.when(F.col("places").isNull(), old).otherwise(_without(F.col("lines"), F.col("places")))
    return joined.select(
        *[(left if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns if c not in ADDED],
        F.size("lines").cast("bigint").alias("n_lines"),
        F.when(F.col("places").isNull(), 0).otherwise(F.size("places")).cast("bigint").alias("n_dropped"),
    )
