"""Source divergence audit, fill-in-the-middle and line dedup against plain Python, on odd rows, and their SQL."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from oracle_check import duck, rows_of
from pyspark.sql import functions as F

from plumbline.llm import source_audit
from plumbline.llm.boundary_set import ARRAY, BITMAP, RUN, SPAN, BoundarySet
from plumbline.llm.fill_in_middle import cut_places, fill_in_middle, restored
from plumbline.llm.line_dedup import without_repeated_lines
from plumbline.llm.queries import ORACLES, QUERIES
from plumbline.llm.source_audit import source_divergences, term_runs
from plumbline.llm.token_sort import Letters, multikey_sort, token_pointers

SF_DIR = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", ["op11_source_divergence_audit", "op12_fill_in_middle", "op13_line_dedup"])
def test_query_matches_sql(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    cursor = duck(SF_DIR).execute(ORACLES[name])
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert rows_of(found.columns, [tuple(r) for r in found.collect()]) == want


# ---- pointer sort


words = st.text(st.sampled_from("abZé7 -ß漢"), max_size=60)


@settings(max_examples=60, deadline=None)
@given(st.lists(words, max_size=12), st.integers(1, 9))
def test_multikey_sort_is_a_stable_sort(texts, small):
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.cumsum([0] + [len(r) for r in raw])
    starts, ends = token_pointers(data, offsets)
    spelled = [bytes(data[a:b]) for a, b in zip(starts, ends)]
    assert spelled == [m for r in raw for m in re.findall(rb"[A-Za-z\x80-\xff]+", r)]
    order, fresh = multikey_sort(Letters(data, starts, ends), np.arange(len(starts)), small)
    want = sorted(range(len(starts)), key=lambda i: (spelled[i], i))
    assert order.tolist() == want
    assert fresh.tolist() == [k == 0 or spelled[want[k]] != spelled[want[k - 1]] for k in range(len(want))]


def test_multikey_sort_of_tokens_that_agree_for_long():
    rng = random.Random(3)
    spelled = [("ab" * 3000)[: rng.choice([7, 8, 9, 16, 5999, 6000])] for _ in range(300)]
    data = np.frombuffer(" ".join(spelled).encode(), np.uint8)
    starts, ends = token_pointers(data, np.array([0, len(data)]))
    for small in (2, 50, 1000):
        order, fresh = multikey_sort(Letters(data, starts, ends), np.arange(300), small)
        assert order.tolist() == sorted(range(300), key=lambda i: (spelled[i], i)) and fresh.sum() == len(set(spelled))


def test_term_runs_count_texts_and_groups():
    texts = pa.array(["The the CAT", "", "cat", "the", "Élan élan 7 cat"])
    term, group, n, docs = term_runs(texts, np.array([1, 1, 0, 1, 0]))
    got = {(t, g): (x, y) for t, g, x, y in zip(term.to_pylist(), group.tolist(), n.tolist(), docs.tolist())}
    assert got == {("cat", 0): (2, 2), ("cat", 1): (1, 1), ("the", 1): (3, 2), ("Élan", 0): (1, 1), ("élan", 0): (1, 1)}


# ---- source audit


def audited(rows, least=3, top=200):
    """The contract by plain loops over rows (lang, source, text)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    found, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        terms = [t.translate(LOWER) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
        found[lang, source].update(terms)
        docs[lang].update(set(terms))
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        whole = Counter()
        for s in sources:
            whole.update(found[lang, s])

        def shares(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (total + len(kept)) for t in kept}

        p, q = {s: shares(found[lang, s]) for s in sources}, shares(whole)
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if found[lang, s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, t, v, k + 1) for k, (t, v) in enumerate(items[:limit])]
    return sorted(out)


def audit_of(spark, rows, **options):
    df = spark.createDataFrame([(*r, 5) for r in rows], "lang string, source string, text string, n int")
    return sorted(tuple(r) for r in source_divergences(df, **options).collect())


def test_source_audit_matches_plain_loops(spark, monkeypatch):
    monkeypatch.setattr(source_audit, "PAIRS", 7)  # many blocks
    monkeypatch.setattr(source_audit, "SHARD_BYTES", 200)
    rng = random.Random(5)
    vocabulary = [f"{a}{b}" for a in "abcdefgh" for b in ("", "x", "LONGENDING", "ö")]
    rows = []
    for _ in range(300):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["web", "news", "web", "ß", None, "b"])
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 5, 40])))
        rows.append((lang, source, text if rng.random() > 0.05 else None))
    rows += [("xx", "only", "one two"), ("yy", "a", "never kept"), ("yy", "b", "")] + [rows[7]] * 4
    assert audit_of(spark, rows) == audited(rows)
    assert audit_of(spark, rows, least_docs=1, top=2) == audited(rows, 1, 2)


def test_source_audit_of_odd_tables(spark):
    assert audit_of(spark, []) == []
    assert audit_of(spark, [(None, None, None)]) == []
    assert audit_of(spark, [("en", "a", None), ("en", "b", "")]) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    long = "word " * 200_000 + "z" * 300_000  # one text, one token longer than a shard's other texts
    rows = [("en", "a", long), ("en", "b", "z" * 300_000 + " word"), ("en", "b", "word zz"), ("en", "c", "z" * 300_000)]
    assert audit_of(spark, rows) == audited(rows)


# ---- boundary set and fill-in-the-middle


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4 * SPAN), unique=True, max_size=300), st.integers(0, 4 * SPAN), st.integers(0, 9000))
def test_boundary_set_selects_by_rank(some, begin, run):
    positions = np.unique(np.array([*some, *range(begin, begin + run)], np.int64))
    ranks = np.random.default_rng(1).permutation(len(positions))
    found = BoundarySet(positions)
    assert len(found) == len(positions) and found.select(ranks).tolist() == positions[ranks].tolist()


def test_boundary_set_takes_the_smallest_container():
    dense = np.flatnonzero(np.random.default_rng(2).random(SPAN) < 0.4)
    positions = np.concatenate(([3, 9, 70], SPAN + np.arange(60_000), 2 * SPAN + dense, 9 * SPAN + np.array([SPAN - 1])))
    found = BoundarySet(positions)
    assert [c.kind for c in found.containers] == [ARRAY, RUN, BITMAP, ARRAY]
    assert found.select(np.arange(len(positions))).tolist() == positions.tolist()
    assert found.nbytes < 2 * len(positions)


def cut_plainly(doc_id, text, unit="words"):
    pattern = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+" if unit == "words" else r"(?s:.)"
    text = text or ""
    units = re.findall(pattern, text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def hostile_texts():
    rng = random.Random(11)
    texts = [None, "", " ", "\n\t ", "<P>", "a <M> b", "< P> <S", "ends in <", "S>P>", "é" * 9, "漢字 \x0b仮名\x0c", "\x1c\x85  x", "a"]
    texts += ["".join(rng.choice(["a", "bc", " ", "\n", "é", "漢", "<", "P>", "　"]) for _ in range(rng.randrange(60))) for _ in range(150)]
    return texts + ["word \n" * 60_000, "x" * 200_000, " " * 100_000, "é漢 " * 50_000]


@pytest.mark.parametrize("unit", ["words", "characters"])
def test_fill_in_middle_matches_plain_cuts(spark, unit):
    rows = [(i, t) for i, t in enumerate(hostile_texts())] + [(None, "no id a b c d"), (7, "shared id x y z"), (7, "shared id x y z")]
    df = spark.createDataFrame([(*r, "other", 1) for r in rows], "doc_id long, text string, form string, kept_column int")
    found = fill_in_middle(df, unit=unit)
    assert found.columns == ["doc_id", "text", "kept_column", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = found.withColumn("again", restored(F.col("output"), F.col("form"))).collect()
    assert all(r["again"] == (r["text"] or "") for r in got)
    names = ("doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output")
    assert sorted((tuple(r[n] for n in names) for r in got), key=repr) == sorted(((i, t, *cut_plainly(i, t, unit)) for i, t in rows), key=repr)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_an_empty_table(spark):
    assert fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_cut_places_of_texts_over_many_containers():
    texts = ["ab " * 40_000, "", "c" * 140_000, "d e"]
    one, two = np.array([17, 3, 1, 5]), np.array([39_999, 0, 0, 1])
    n, prefix, middle = cut_places(pa.array(texts), one, two)
    assert n.tolist() == [40_001, 0, 1, 2]
    assert prefix.tolist() == [17 * 3 - 1, 0, 0, 1] and middle.tolist() == [3 * (39_999 - 17), 0, 140_000, 2]


# ---- line dedup


def deduplicated(rows, threshold=2, least=10):
    owners, holders = {}, defaultdict(set)
    order = {i: (i is None, i) for i, _ in rows}
    keyed = [(i, t, (t or "").split("\n")) for i, t in rows]
    for i, _, lines in keyed:
        for line in lines:
            key = line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
            holders[key].add(i)
    for key, ids in holders.items():
        if len(key) >= least and len(ids) >= threshold:
            owners[key] = min(ids, key=lambda i: order[i])
    out = []
    for i, t, lines in keyed:
        left = [x for x in lines if owners.get(x.strip(" \t\n\x0b\x0c\r").translate(LOWER), i) == i]
        out.append((i, None if t is None else "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=repr)


def line_rows():
    rng = random.Random(23)
    pool = ["", "short", " the same long line ", "The Same LONG line\t", "ÄÖÜ äöü ß and so on", "äöü äöü ß and so on", "123456789", "1234567890", "\x0b1234567890\r", "only here %d"]
    rows = []
    for i in range(120):
        lines = [rng.choice(pool) for _ in range(rng.randrange(9))]
        rows.append((i, "\n".join(x % i if "%" in x else x for x in lines)))
    hot = "this line stands in every third document"
    rows = [(i, t + "\n" + hot if i % 3 == 0 else t) for i, t in rows]
    rows += [(130, None), (131, ""), (132, "\n\n"), (None, hot + "\nwithout an id"), (None, "without an id"), (5, "another text of id 5\n" + hot), (5, hot), (5, hot)]
    rows += [(200, ("a very long text of lines\n" + "its own line\n") * 30_000), (-1, "its own line\n" * 3)]
    return rows


@pytest.mark.parametrize("threshold", [2, 4])
def test_line_dedup_matches_plain_loops(spark, threshold):
    rows = line_rows()
    df = spark.createDataFrame([(*r, 9, "x") for r in rows], "doc_id long, text string, n_lines int, id string").repartition(7)
    found = without_repeated_lines(df, threshold)
    assert found.columns == ["doc_id", "text", "id", "n_lines", "n_dropped"]
    assert sorted((tuple(r) for r in found.drop("id").collect()), key=repr) == deduplicated(rows, threshold)


def test_line_dedup_of_text_ids_and_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert without_repeated_lines(empty).count() == 0
    rows = [("b", "a line to be found\nx"), ("a", "A line to be found"), ("c", "none")]
    found = without_repeated_lines(spark.createDataFrame(rows, "doc_id string, text string"))
    assert sorted(tuple(r) for r in found.collect()) == [("a", "A line to be found", 1, 0), ("b", "x", 2, 1), ("c", "none", 1, 0)]
