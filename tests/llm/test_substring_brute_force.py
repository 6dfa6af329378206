"""Removal of repeated spans against plain loops that compare the words themselves."""

from __future__ import annotations

import random
import re

import pyarrow as pa

from plumbline.llm.substring_dedup import CLAUSE, GRID_AHEAD, GRID_WORDS, LONGEST, RUN, RUN_WORDS, without_repeated_spans
from plumbline.llm.words import find_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_of(text):
    """(words, (grid, begin, end) of every run); only the hash of a single word is taken from the library."""
    places = list(WORD.finditer(text))
    words = [m.group().lower() for m in places]
    n, h = len(words), find_words(pa.array([text])).hashes.tolist()
    begins = {0}
    for i in range(1, n):
        w = words[i - 1]
        closed = w[-1] in ".!?" or (len(w) > 1 and w[-1] in "\"')]}" and w[-2] in ".!?")
        if closed or re.search("[\n\r]", text[places[i - 1].end() : places[i].start()]):
            begins.add(i)
    edges = sorted(begins) + [n]
    for a, b in zip(edges, edges[1:]):
        if b - a > LONGEST:
            begins |= {i for i in range(a + 1, b) if h[i - 1] % CLAUSE == 0}
    edges = sorted(begins) + [n]
    cut = [i for a, b in zip(edges, edges[1:]) for i in range(a, b, 4 * CLAUSE)] + [n] if n else [0]
    found = []
    for k in range(len(cut) - 1):
        ends = [e for j, e in enumerate(cut) if j >= k + RUN and e - cut[k] >= RUN_WORDS]
        if ends:
            found.append(("sentences", cut[k], ends[0]))
    if not found and n >= RUN_WORDS:
        found.append(("sentences", 0, n))
    starts = [i for i in range(n - GRID_WORDS + 1) if all(h[i] <= h[j] for j in range(i + 1, i + 1 + GRID_AHEAD))]
    parts = {n, *starts, *[i for i in range(1, n - 1) if h[i - 1] > h[i] <= h[i + 1]]}
    found += [("grid", i, min(e for e in parts if e >= i + GRID_WORDS)) for i in starts]
    return places, words, found


def left_by_loops(rows):
    first = {}
    read = {i: runs_of(text) for i, text in rows}
    for i in sorted(read):
        _, words, found = read[i]
        for grid, a, b in sorted(found, key=lambda r: r[1]):
            first.setdefault((grid, *words[a:b]), (i, a, b))
    left = {}
    for i, text in rows:
        places, words, found = read[i]
        gone, seen = [False] * len(words), {}
        for grid, a, b in sorted(found, key=lambda r: r[1]):
            key = (grid, *words[a:b])
            own = seen.setdefault(key, (a, b))
            again = own[0] < a and (grid == "sentences" or a >= own[1])
            if first[key][0] < i or again:
                gone[a:b] = [True] * (b - a)
        starts = [m.start() for m in places] + [len(text)]
        left[i] = text[: starts[0]] + "".join(text[starts[k] : starts[k + 1]] for k in range(len(words)) if not gone[k])
    return left


def test_rows_equal_those_of_plain_loops(spark):
    draw = random.Random(23)

    def drawn(n, vocabulary=400):
        ends = draw.choice([".", "", "!)", "\n", ".\n "])
        return " ".join(f"{draw.choice('Wwé')}{draw.randrange(vocabulary)}" + (ends if draw.random() < 0.1 else "") for _ in range(n))

    passages = [drawn(60).split() for _ in range(6)]
    rows = []
    for k in range(90):
        parts = [drawn(draw.randrange(40))]
        for _ in range(draw.randrange(3)):
            p = draw.choice(passages)
            a = draw.randrange(20)
            parts += [" ".join(p[a : a + draw.randrange(15, 60)]), drawn(draw.randrange(40), draw.choice([3, 400]))]
        rows.append((k * 7 % 90, draw.choice([" ", "\n", "  "]).join(parts)))
    rows += [(200, ""), (201, "ha " * 90), (202, "Ha " * 50), (203, rows[5][1]), (204, "one two three. " * 12)]
    got = {r["doc_id"]: r["text"] for r in without_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = left_by_loops(rows)
    assert got == want
    assert sum(want[i] != t for i, t in rows) > 30 and sum(want[i] == t for i, t in rows) > 20
