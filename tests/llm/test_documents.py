"""Operators on documents against brute force, and on odd rows."""

from __future__ import annotations

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from plumbline.llm import lm_scoring
from plumbline.llm.decontamination import leaked_items, without_leaks
from plumbline.llm.licenses import license_scan
from plumbline.llm.license_rules import GATES, rules
from plumbline.llm.lm_scoring import bits_of, fit, lm_scores, segments
from plumbline.llm.near_dedup import likeliest, near_duplicates, registers
from plumbline.llm.packing import WordEncoder, hilbert_key, packed
from plumbline.llm.queries import word_tokenizer
from plumbline.llm.sharding import first_map, grown_map, rebalanced_map, sharded, slot_loads, store_map, stored_map
from plumbline.llm.substring_dedup import find_runs, without_repeated_spans
from plumbline.llm.toxicity import maximal_segments, toxic_passages
from plumbline.llm.words import chain, find_words, mix, shingles

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def sentences(seed, n, words=9):
    draw = random.Random(seed)
    return [" ".join(draw.choice("abcdefghij") * draw.randint(1, 3) + str(draw.randint(0, 999)) for _ in range(words)) + "." for _ in range(n)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=" \n\tAbcé.", max_size=12), min_size=1, max_size=6))
def test_words_are_those_of_the_pattern(texts):
    found = find_words(pa.array(texts))
    for i, text in enumerate(texts):
        own = [bytes(found.data[a:b]).decode() for a, b in zip(found.starts[found.first[i] : found.first[i + 1]], found.ends[found.first[i] : found.first[i + 1]])]
        assert own == words_of(text)
    by_word = collections.defaultdict(set)
    for a, b, h in zip(found.starts, found.ends, found.hashes):
        by_word[bytes(found.data[a:b])].add(int(h))
    assert all(len(h) == 1 for h in by_word.values()) and len({h for s in by_word.values() for h in s}) == len(by_word)


def test_shingles_are_distinct_runs_of_words():
    texts = ["a b c d e", "a b", "", "a b c d a b c d", "x"]
    found, offsets = shingles(find_words(pa.array(texts)), 4)
    assert np.diff(offsets).tolist() == [2, 1, 0, 4, 1]
    assert len(chain(np.arange(3, dtype=np.uint64), 4)) == 0


def test_registers_estimate_similarity_and_merge():
    a, b = mix(np.arange(0, 900, dtype=np.uint64)), mix(np.arange(100, 1000, dtype=np.uint64))
    regs = registers(np.concatenate([a, b]), np.array([0, 900, 1800]), 512)
    union = registers(mix(np.arange(1000, dtype=np.uint64)), np.array([0, 1000]), 512)
    assert (np.maximum(regs[0], regs[1]) == union[0]).all()
    n = np.array([900.0])
    assert abs(likeliest(n, n, regs[:1], regs[1:])[0] - 0.8) < 0.08


def test_near_duplicates_against_all_pairs(spark, odd, plain_odd_rows):
    draw, texts = random.Random(3), list(plain_odd_rows)
    for group in range(6):
        base = " ".join(sentences(group, 12)).split()
        for k in range(12):
            copy = list(base)
            for _ in range(draw.randint(0, 5)):
                copy[draw.randrange(len(copy))] = f"changed{draw.randint(0, 10**6)}"
            texts.append((100 * group + 10 + k, " ".join(copy)))
    sets = {}
    for i, t in texts:
        w = words_of(t)
        sets.setdefault((i, t), {tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) > 3 else ({tuple(w)} if w else set()))
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in sets:
        for y in sets:
            if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                root[find(x)] = find(y)
    members = collections.defaultdict(list)
    for k in sets:
        members[find(k)].append(k[0])
    want = collections.Counter()
    for i, t in texts:
        ids = [x for x in members[find((i, t))] if x is not None]
        component = min(ids) if sets[i, t] and ids else i
        want[(i, len(sets[i, t]), component, i is not None and i == component)] += 1
    got = near_duplicates(odd(texts), size=4, threshold=80)
    assert collections.Counter(tuple(r) for r in got.collect()) == want
    assert near_duplicates(odd([]), size=4).count() == 0


def test_repeated_passages_go_and_the_rest_stays(odd, plain_odd_rows):
    passage = sentences(1, 7)
    alone = [sentences(10 + k, 6) for k in range(4)]
    texts = [
        (10, " ".join(alone[0])),
        (11, "\n".join(alone[1][:3] + passage + alone[1][3:])),
        (12, " ".join(alone[2][:2] + [s.upper() for s in passage] + alone[2][2:])),
        (None, " ".join(alone[3] + passage)),
        (13, "  " + " ".join(passage)),
    ]
    rows = {r["doc_id"]: r for r in without_repeated_spans(odd(texts)).collect()}
    assert [rows[k]["text"] for k in (10, 11)] == [texts[0][1], texts[1][1]]
    assert rows[12]["text"].split() == " ".join(alone[2]).split() and rows[12]["n_removed"] == 7
    assert rows[None]["text"].strip() == " ".join(alone[3]) and rows[13]["text"] == "  "
    assert rows[12]["source"] == "s" and rows[12]["id"] == "x"
    left = without_repeated_spans(odd(plain_odd_rows)).collect()
    kept = collections.Counter((r["doc_id"], r["text"]) for r in left if r["doc_id"] != 4)
    assert kept == collections.Counter(t for t in plain_odd_rows if t[0] != 4)
    long = [r for r in left if r["doc_id"] == 4]
    assert len(long) == 2 and long[0] == long[1] and long[0]["n_removed"] > 3_000  # repeated inside one text
    assert without_repeated_spans(odd([])).count() == 0


def test_runs_are_cut_alike_wherever_a_long_sentence_begins():
    body = " ".join(f"w{k}" for k in range(400))
    keys = [set(find_runs(pa.array([t]))[1].key.tolist()) for t in (body, "some words before " + body)]
    assert len(keys[0] & keys[1]) > 0.8 * len(keys[0])


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(-5, 5).filter(bool), min_size=1, max_size=14))
def test_maximal_segments_against_their_definition(scores):
    sums = np.concatenate(([0], np.cumsum(scores)))
    at = [i for i, s in enumerate(scores) if s > 0]
    found = maximal_segments(sums[at].tolist(), sums[[i + 1 for i in at]].tolist())

    def all_maximal(a, b):
        spans = [(sums[j] - sums[i], -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)]
        best = max(spans, default=(0,))
        return [] if best[0] <= 0 else [*all_maximal(a, best[3]), (best[3], best[4], best[0]), *all_maximal(best[4], b)]

    assert sorted(s for _, _, s in found) == sorted(s for _, _, s in all_maximal(0, len(scores)))


def test_toxicity_on_held_out_rows_and_odd_ones(spark, odd, plain_odd_rows):
    draw, texts, labels = random.Random(5), list(plain_odd_rows), []
    for i in range(100, 1100):
        toxic = int(draw.random() < 0.3)
        words = [f"w{draw.randint(0, 300)}" for _ in range(draw.randint(20, 80))]
        for _ in range(3 * toxic):
            words.insert(draw.randrange(len(words)), draw.choice(["idiot", "scum", "moron"]))
        texts.append((i, " ".join(words)))
        labels.append((i, toxic))
    table = spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id long, toxic int")
    got = toxic_passages(odd(texts), table, F.expr("crc32(cast(id as string)) % 5 <> 0")).collect()
    assert len(got) == len(texts)
    truth = dict(labels)
    held = [r for r in got if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) > 0.97 * len(held) > 100
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert all(r["predicted"] == 0 and not r["passages"] for r in got if r["doc_id"] in (1, 2, 3))
    assert toxic_passages(odd(texts[:9]), table.limit(0), F.lit(True)).where("predicted = 1").count() == 0
    assert toxic_passages(odd([]), table, F.lit(True)).count() == 0


def test_license_rules_pass_their_gates():
    assert len(rules()) > 400
    assert all("cc by" in r.keyword or any(g in r.keyword for g in GATES) for r in rules())


def test_every_alternative_of_a_license_rule_holds_its_keyword(odd):
    def matches(parts):
        found = [""]
        for op, arg in parts:
            name = str(op)
            if name == "LITERAL":
                each = [chr(arg)]
            elif name == "SUBPATTERN":
                each = matches(arg[3])
            elif name == "BRANCH":
                each = [m for branch in arg[1] for m in matches(branch)]
            elif name == "IN":
                each = [chr(c) for kind, v in arg for c in ((v,) if str(kind) == "LITERAL" else v[:1])]
            else:
                assert name == "MAX_REPEAT"
                each = [m * k for k in {arg[0], max(arg[0], 1)} for m in matches(arg[2])]
            found = [a + b for a in found for b in dict.fromkeys(each)]
        return found

    for rule in rules():
        made = matches(re._parser.parse(rule.pattern))
        assert made and all(re.fullmatch(rule.pattern, m) and rule.keyword in m for m in made), rule
    texts = [(1, "Licensed under the Expat License."), (2, "ASF License 2.0"), (3, "Do What The Fuck You Want To Public Licence")]
    got = {r["doc_id"]: r["labels"] for r in license_scan(odd(texts)).collect()}
    assert got == {1: "mit", 2: "apache-2.0", 3: "wtfpl"}


def test_licenses_against_words(odd, plain_odd_rows):
    texts = [
        *plain_odd_rows,
        (20, "CC-BY cc by, cc\nBY; General Public LICENSE"),
        (21, "Licensed under the Apache License, Version 2.0. All rights reserved."),
        (22, "This work is licensed under the GNU General Public License, version 3."),
        (23, "cc bye, occ by, general public licensee; émit License"),
        (24, "Licensed under CC BY-NC 4.0."),
        (25, "ALL RIGHTS RESERVED"),
    ]
    got = {}
    for r in license_scan(odd(texts)).collect():
        got.setdefault(r["doc_id"], r)
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    for i, t in texts:
        if i is not None:
            assert got[i]["n_words"] == len(re.findall(pattern, (t or "").translate(LOWER)))
    say = lambda i: tuple(got[i][c] for c in ("n_base", "first_word", "last_word", "base_labels", "labels"))
    assert say(20) == (4, 0, 6, "cc-by,gpl", "cc-by,gpl")
    assert say(21) == (1, 8, 8, "reserved", "apache-2.0,reserved")
    assert say(22) == (1, 7, 7, "gpl", "gpl,gpl-3.0")  # the shorter detections inside are dropped
    assert say(23) == (0, None, None, "", "")
    assert say(24) == (1, 2, 2, "cc-by", "cc-by,cc-by-nc-4.0")
    assert say(25)[0] == 1 and got[2]["score"] == 0 and 0.9 < got[21]["score"] <= 1
    assert license_scan(odd([])).count() == 0


def test_leaks_of_copied_and_changed_items(spark, odd, plain_odd_rows):
    item = "A train leaves Boston with Alice on board and travels 60 miles in 2 hours before Alice leaves it again near Salem at 9."
    changed = item.replace("Boston", "Paris").replace("Alice", "Bruno").replace("60 miles", "75 km")
    mixed = item.replace("Alice", "Bruno", 1)  # one name for two
    plain = " ".join(f"word{chr(97 + k)}" for k in range(20)) + "."
    bench = spark.createDataFrame([(1, item), (2, plain), (3, None), (4, ""), (5, "too short")], "item_id long, text string")
    texts = [
        *plain_odd_rows, (30, f"Before. {item} After."), (31, f"Before. {changed} After."), (32, f"Before. {mixed} After."),
        (33, f"Some {plain.upper()} end"), (34, " ".join(plain.split()[:9])), (35, "too short"), (None, item),
    ]
    got = {(r["doc_id"], r["item_id"], r["same_values"]) for r in leaked_items(odd(texts), bench).collect()}
    assert got == {(30, 1, True), (31, 1, False), (33, 2, True), (None, 1, True)}
    left = without_leaks(odd(texts), bench)
    assert collections.Counter((r["doc_id"], r["text"]) for r in left.collect()) == collections.Counter(t for t in texts if t[0] not in (30, 31, 33) and t != (None, item))
    assert leaked_items(odd([]), bench).count() == 0 and leaked_items(odd(texts), bench.limit(0)).count() == 0


def test_leaks_of_items_full_of_numbers_or_names(spark, odd):
    sums = "If 3 x + 5 y = 20 and 2 x - 4 y = 10, what is x?"
    people = "Those were Alice Brown, Carol Davis, Erin Fox, Grace Hill, Ivan Jones, Kate Lane and Mia Nash."
    bench = spark.createDataFrame([(1, sums), (2, people)], "item_id long, text string")
    other = sums.replace("20", "21").replace("10", "11").replace("5 y", "6 y").replace("3 x", "9 x")
    texts = [(1, f"Before. {sums} After."), (2, f"before {people.lower()} after"), (3, people.upper()), (4, f"Before. {other} After."), (5, "1 2 3 " * 20)]
    got = {(r["doc_id"], r["item_id"], r["n_tokens"], r["same_values"]) for r in leaked_items(odd(texts), bench).collect()}
    assert got == {(1, 1, 15, True), (2, 2, 17, True), (3, 2, 17, True)}


def test_lm_scores_against_counts(odd, plain_odd_rows):
    texts = [*plain_odd_rows, *((40 + k, " ".join(sentences(k, 3))) for k in range(30)), (90, "ÀB " + "z" * 5000)]
    got = lm_scores(odd(texts), F.col("id") % 7 != 2).collect()
    learnt = collections.Counter(w for i, t in texts if i is not None and i % 7 != 2 for w in [*words_of(t), "\n"])
    n, v = sum(learnt.values()), len(learnt)
    want = collections.Counter()
    for i, t in texts:
        tokens = [*words_of(t), "\n"]
        base = sum(math.log10((learnt[w] + 1) / (n + v + 1)) for w in tokens)
        want[(i, len(tokens), sum(learnt[w] > 0 for w in tokens), n, round(base, 4))] += 1
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    known = {r["doc_id"]: r["bits_per_byte"] for r in got}
    assert known[41] < known[90] or known[41] < 8 and known[1] is None
    assert lm_scores(odd([]), F.lit(True)).count() == 0


def test_long_unknown_words_cost_their_whole_spelling(odd):
    draw = random.Random(7)
    blocks = ["".join(draw.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=k)) for k in (2_000, 20_000)]
    texts = [*((40 + k, " ".join(sentences(k, 3))) for k in range(30)), (93, blocks[0]), (100, blocks[1])]  # both held out
    got = {r["doc_id"]: r for r in lm_scores(odd(texts), F.col("id") % 7 != 2).collect()}
    assert all(got[i]["bits_per_byte"] > 3 for i in (93, 100)) and got[100]["score"] < 9 * got[93]["score"]


def test_scores_do_not_depend_on_chunks(odd, plain_odd_rows, monkeypatch):
    texts = [*plain_odd_rows, *((40 + k, " ".join(sentences(k, 3))) for k in range(30))]

    def told():
        return sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["per_byte"], round(r["base_score"], 6), round(r["score"], 2)) for r in found.collect())

    found = lm_scores(odd(texts), F.col("id") % 7 != 2).withColumn("per_byte", F.round("bits_per_byte", 2))
    whole = told()
    monkeypatch.setattr(lm_scoring, "CHUNK", 1)  # a chunk for each slice of texts
    monkeypatch.setattr(lm_scoring, "WORD_ROWS", 3)
    found = lm_scores(odd(texts).repartition(5), F.col("id") % 7 != 2).withColumn("per_byte", F.round("bits_per_byte", 2))
    assert told() == whole


@pytest.mark.parametrize("most", [0, 255, 256, 70_000, 1 << 24])
def test_places_of_words_come_back(most):
    given = np.array([0, most, most // 2, 0], np.uint32)
    width = max(1, (most.bit_length() + 7) // 8)
    assert len(lm_scoring._planes(given, width)) == 4 * width
    assert (lm_scoring._places(pa.py_buffer(lm_scoring._planes(given, width)), 4) == given).all()
    assert len(lm_scoring._places(pa.py_buffer(b""), 0)) == 0


def test_contexts_of_very_many_words_keep_their_odds(spark):
    letter = F.when(F.col("id") % 10 < 7, F.lit("a")).otherwise(F.lit("5"))
    model = fit(spark.range(300_000).select(F.concat(letter, F.col("id").cast("string")).alias("word")), 300_000)
    steps = bits_of(*segments(pa.array(["a"]))[:2])
    next(steps)
    _, slots, _, bit = next(steps)  # the bit that tells letters from digits, at the beginning of a word: 210,000 ones and 90,000 zeros
    assert bit[0] == 1 and abs(model.odds[slots[0, 0]] - math.log(210 / 90)) < 0.01


def test_hilbert_neighbours_touch():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    keys = hilbert_key(cells, 3)
    assert sorted(keys) == list(range(512))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_packing_is_a_partition_of_the_ids(odd, plain_odd_rows):
    from tokenizers import Tokenizer

    texts = [*plain_odd_rows, (50, "Don't <|endoftext|> stop <|ENDOFTEXT|> now...it's 3.5% «x» ΣΑΣ Áb İ K!?;"), *((60 + k, " ".join(sentences(k, 20))) for k in range(20))]
    whole = Tokenizer.from_file(word_tokenizer())
    ids = {(i, t): [*whole.encode(t or "", add_special_tokens=False).ids, 2] for i, t in texts}
    pieces = packed(odd(texts), word_tokenizer(), length=256).collect()
    fill = collections.defaultdict(list)
    for p in pieces:
        own = np.frombuffer(p["token_ids"], "<u4").tolist()
        assert p["ids_crc32"] == zlib.crc32(p["token_ids"]) and p["length"] == len(own) <= 256
        assert any(i == p["doc_id"] and v[p["start"] : p["start"] + len(own)] == own and len(v) == p["doc_tokens"] for (i, _), v in ids.items())
        fill[p["sequence_id"]].append((p["offset"], p["length"]))
    assert sorted(fill) == list(range(len(fill)))
    for k, spans in fill.items():
        spans.sort()
        assert [a for a, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1]]
        assert sum(n for _, n in spans) == 256 or k == len(fill) - 1
    assert sum(p["length"] for p in pieces) == sum(len(ids[t]) for t in texts)
    assert packed(odd([]), word_tokenizer()).count() == 0
    assert WordEncoder(word_tokenizer()).closes is not None


def test_sharding_by_fixed_slots(spark, odd, plain_odd_rows):
    texts = [*plain_odd_rows, *((k, f"text {k}" * (k % 50)) for k in range(100, 3000)), *[(99, "same")] * 500]
    first = first_map(spark, 8, 512)
    from plumbline.llm import sharding

    slots, sharding.SLOTS = sharding.SLOTS, 512
    try:
        got = sharded(odd(texts), first_map(spark, 8), grown_map(first_map(spark, 8))).toPandas()
    finally:
        sharding.SLOTS = slots
    assert len(got) == len(texts) and got["size"].sum() == sum(len((t or "").encode()) + 16 for _, t in texts)
    for _, own in got.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    moved = got[got.grown_shard != got["shard"]]
    assert (moved.grown_shard == 8).all() and 0 < len(moved) < 0.3 * len(got)
    assert got[got.doc_id == 99]["shard"].nunique() == 1
    grown = grown_map(first).toPandas()
    assert grown.version.unique() == [2] and grown.shard.value_counts().max() - grown.shard.value_counts().min() <= 1
    loads = spark.createDataFrame([(k, 1 + k % 97) for k in range(512)], "virtual_slot int, size long")
    even = rebalanced_map(first, slot_loads(loads)).join(loads, "virtual_slot").groupBy("shard").sum("size").toPandas()["sum(size)"]
    assert (even.max() - even.min()) <= 0.02 * even.mean()
    assert sharded(odd([]), first).count() == 0


@pytest.mark.parametrize("keys", [{"op1_substring_dedup", "op10_packing", "pipeline"}])
def test_all_are_registered(keys):
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert keys <= names and {n.split("_")[0] for n in names if re.match(r"op\d+_", n)} == {f"op{k}" for k in range(1, 14)}


def test_slot_maps_are_kept_by_version(spark, odd, tmp_path):
    folder = str(tmp_path / "maps")
    first = store_map(first_map(spark, 8, 512), folder)
    store_map(grown_map(stored_map(spark, folder)), folder)
    loads = spark.createDataFrame([(k, 1 + k % 97) for k in range(512)], "virtual_slot int, size long")
    store_map(rebalanced_map(stored_map(spark, folder), slot_loads(loads)), folder)
    shards = {v: [r["shard"] for r in stored_map(spark, folder, v).orderBy("virtual_slot").collect()] for v in (1, 2, 3)}
    assert shards[1] == [k % 8 for k in range(512)] and set(shards[2]) == set(shards[3]) == set(range(9))
    assert stored_map(spark, folder).first()["version"] == 3 and first.count() == 512
    assert shards[2] == [r["shard"] for r in grown_map(first).orderBy("virtual_slot").collect()]
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        store_map(first_map(spark, 4, 512), folder)
    with pytest.raises(ValueError, match="no slot map 9"):
        stored_map(spark, folder, 9)


def test_passages_begun_in_the_middle_of_sentences_meet():
    """51 words copied from anywhere, with and without sentence ends: fewer than 2 % share no run."""
    draw = random.Random(11)
    for ends in (".", ""):
        missed = 0
        for _ in range(200):
            text = " ".join(f"w{draw.randrange(3_000)}{ends if k % 9 == 0 else ''}" for k in range(500)).split()
            a = draw.randrange(400)
            texts = [" ".join(f"{side}{draw.randrange(900)}" for _ in range(draw.randrange(1, 30))) for side in "xyxy"]
            copy = " ".join(text[a : a + 51])
            _, found = find_runs(pa.array([f"{texts[0]} {copy} {texts[1]}", f"{texts[2]} {copy} {texts[3]}"]))
            missed += not set(found.key[found.text == 0].tolist()) & set(found.key[found.text == 1].tolist())
        assert missed < 4


def test_second_grid_leaves_the_first_occurrence_whole(odd):
    words = [f"w{k}" for k in range(60)]
    once = "start " + " ".join(words) + " stop"
    rows = {r["doc_id"]: r["text"] for r in without_repeated_spans(odd([(1, once), (2, "other " + " ".join(words) + " words"), (3, "ha " * 25)])).collect()}
    assert rows[1] == once and rows[3] == "ha " * 25
    assert len(rows[2].split()) < 25 and rows[2].startswith("other ") and rows[2].endswith(" words")
