"""Jaccard join, decontamination, line dedup and sharding against brute force, with the edge cases of their docstrings."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recordsync.llm import common, components, jaccard_join, line_index, maglev, winnowing

BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute_components(rows, k, p, q):
    sets = collections.defaultdict(list)
    for d, text in rows:
        w = BLANK_WORD.findall((text or "").translate(LOWER))
        sets[d].append(frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if any(x and y and q * len(x & y) >= p * len(x | y) for x in sets[a] for y in sets[b]):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {d: find(d) for d in ids}


def near_copies(seed, sizes):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(50)]
    rows = []
    for size in sizes:
        base = [rnd.choice(vocab) for _ in range(size)]
        for _ in range(rnd.choice([2, 4, 8])):
            w = list(base)
            for _ in range(rnd.choice([0, 1, 1, 2])):
                at = rnd.randrange(len(w))
                w[at] = rnd.choice(vocab)
            rows.append((len(rows) * 7919 % 100003, " ".join(w)))
    return rows


@pytest.mark.parametrize("k,ratio", [(3, (90, 100)), (5, (80, 100))])
def test_jaccard_join_is_brute_force(spark, k, ratio):
    rows = near_copies(k, [4, 9, 15, 19, 20, 24, 33, 60, 140])
    rows += [(200001, None), (200002, ""), (200003, " \n"), (200004, "One"), (200005, "ONE"), (200006, "one two"),
             (200007, "x " * 3000), (200004, "One"), (200008, rows[-1][1] + " tail")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash"))
    got = jaccard_join.join(df, k=k, ratio=ratio).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == brute_components(rows, k, *ratio)
    sizes = {r.doc_id: r.n_shingles for r in got}
    assert sizes[200001] == sizes[200002] == sizes[200003] == 0 and sizes[200006] == 1 and sizes[200007] == 1


def test_jaccard_join_null_id_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c d"), (1, "a b c d")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in jaccard_join.join(df).collect()) == [(0, 0), (1, 1)]
    assert jaccard_join.join(df.where("false")).collect() == []


def test_join_hands_over_short_batches(spark, monkeypatch):
    """Long rows go to Python a few MB at a time, not 64 MB, while the join runs; afterwards the session is as it was."""
    name, most = common.BATCH_BYTES
    before, seen = spark.conf.get(name), []
    rows = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))

    def sizes(docs, k, inner=jaccard_join.frequent_elements):
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])
        seen.extend(r.size for r in rows.mapInArrow(run, "size long").collect())
        return inner(docs, k)
    monkeypatch.setattr(jaccard_join, "frequent_elements", sizes)
    df = spark.createDataFrame([(2, "a b c d"), (1, "a b c d")], "doc_id long, text string")
    assert {r.component_id for r in jaccard_join.join(df).collect()} == {1}
    assert sum(seen) >= 30_000_000 and max(seen) <= 1.1 * most
    assert spark.conf.get(name) == before


def test_frequent_elements_count_over_batches(spark):
    """What three texts share is counted even if they come in batches of their own."""
    rows = spark.createDataFrame([("a b c",)] * 5, "text string").coalesce(1)
    name, _ = common.BATCH_BYTES
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, 1)
        found, _ = jaccard_join.frequent_elements(rows, 3)
    finally:
        spark.conf.set(name, before)
    assert len(found) == 1


def test_subsets_and_sketch_keep_every_link():
    """A link's sets share a subset that both emit, and their sketches differ in no more than the sets do."""
    rule, rng = jaccard_join.Rule(90, 100), np.random.default_rng(5)
    for _ in range(300):
        a = rng.choice(1 << 40, size=rng.integers(5, 60), replace=False).astype(np.uint64)
        b = np.concatenate([a[rng.integers(0, 4):], rng.choice(1 << 41, size=rng.integers(0, 4)).astype(np.uint64)])
        overlap = len(np.intersect1d(a, b))
        linked = bool(rule.links(overlap, len(a), len(b)))
        assert linked == (overlap >= rule.need(len(a), len(b)))
        if linked:
            pair = (min(len(a), len(b)), max(len(a), len(b)))
            assert pair in {x[:2] for x in rule.subsets(len(a))} and pair in {x[:2] for x in rule.subsets(len(b))}
            one, two = (np.frombuffer(jaccard_join._sketch(x, 64), np.uint64) for x in (a, b))
            assert np.bitwise_count(one ^ two).sum() <= rule.differ(np.int64(len(a)), np.int64(len(b)))


def test_scan_list_finds_each_component_of_a_hot_group():
    rule = jaccard_join.Rule(90, 100)
    rng = np.random.default_rng(1)
    base = rng.choice(1 << 60, size=150, replace=False).astype(np.uint64)
    sets = [np.concatenate([np.delete(base, i), [np.uint64(i + 1)]]) for i in range(100)]
    sketch = np.stack([np.frombuffer(jaccard_join._sketch(s, 512), np.uint64) for s in sets])
    edges = list(jaccard_join.scan_list(rule, np.arange(100), np.full(100, 150), sketch, np.zeros(100, int)))
    assert len(edges) == 99  # a forest, not 4950 pairs


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (103, 101), (7, 7)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 103: 100}


def brute_hits(text, items, span=10):
    w = WORD.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item, said in items:
        x = WORD.findall((said or "").translate(LOWER))
        n = min(span, len(x))
        grams = {tuple(x[i:i + n]) for i in range(len(x) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i:i + n]) in grams:
                hit.update(range(i, i + n))
                found.add("" if item is None else str(item))
    names = ",".join(sorted(found))
    return len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)


def test_decontaminate_is_brute_force(spark):
    rnd = random.Random(2)
    vocab = ["a", "b", "cé", "d1", "e", "f", "g", "h", "éa", "7"]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(n))) for i, n in enumerate([3, 1, 9, 10, 11, 25, 40, 0, 25])]
    items += [(3, items[3][1]), (None, "q r s t u v w x y z"), (12, None), (13, "same " * 15)]
    docs = []
    for i in range(60):
        w = [rnd.choice(vocab) for _ in range(rnd.choice([0, 5, 30, 120]))]
        for item in rnd.sample(items, 2):
            x = (item[1] or "").split()
            cut = rnd.randrange(len(x) + 1)
            at = rnd.randrange(len(w) + 1)
            w[at:at] = x[:cut] if rnd.random() < 0.3 else x
        docs.append((i, (rnd.choice([" ", ", ", "-\n"])).join(w).upper() if i % 3 else " ".join(w)))
    docs += [(100, None), (101, ""), (102, "!!!"), (103, "Same " * 400), (103, "Same " * 400), (None, items[5][1])]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, n_hit string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = winnowing.decontaminate(df, bench).collect()
    key = lambda r: (str(r[0]), r[1:])
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got], key=key) == sorted(
        [(d, *brute_hits(t, items)) for d, t in docs], key=key)
    none = winnowing.decontaminate(df, bench.where("false")).agg(F.sum("n_hit"), F.count("*")).first()
    assert tuple(none) == (0, len(docs))


def brute_lines(rows, min_length=40, min_docs=5):
    strip = " \t\n\x0b\x0c\r"
    holders = collections.defaultdict(set)
    for d, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(strip).translate(LOWER)
            if len(key) >= min_length:
                holders[key].add(-(1 << 63) if d is None else d)
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        me = -(1 << 63) if d is None else d
        kept = [x for x in lines if len(holders.get(x.strip(strip).translate(LOWER), ())) < min_docs
                or max(holders[x.strip(strip).translate(LOWER)]) == me]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_line_dedup_is_brute_force(spark, monkeypatch):
    monkeypatch.setattr(line_index, "SHARD_KEYS", 20)
    monkeypatch.setattr(line_index, "PROBES", 50)  # so that hot shards are copied
    rnd = random.Random(4)
    lines = ["é" * 40, "x" * 39, "Shared line that is long enough to count here", "y" * 60] + [
        f"line number {i} padded up to more than forty characters" for i in range(60)]
    rows = []
    for d in range(80):
        text = [rnd.choice(lines) for _ in range(rnd.choice([1, 3, 8]))] + [lines[2]] * (d % 3)
        rows.append((d, rnd.choice(["\n", "\n\n", " \n\t"]).join(x.upper() if d % 5 == 0 else x for x in text)))
    rows += [(200, None), (201, ""), (202, "\n\n"), (None, lines[2] + "\n" + lines[2]), (79, rows[79][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_lines", F.lit("clash"))
    key = lambda r: (str(r[0]), r[1:])
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in line_index.dedup_lines(df).collect()]
    assert sorted(got, key=key) == sorted(brute_lines(rows), key=key)
    assert line_index.dedup_lines(df.where("false")).collect() == []


def test_perfect_hash_is_minimal_and_survives_bytes():
    for n in (0, 1, 2, 1000, 20000):
        keys = np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64)
        h = line_index.PerfectHash.from_bytes(line_index.PerfectHash.build(keys).to_bytes())
        assert sorted(h.number(keys).tolist()) == list(range(n))


def test_maglev_table_and_placement(spark):
    names = tuple(f"s{i}" for i in range(10))
    table = maglev.fill_table(names, 1009)
    counts = np.bincount(table)
    assert set(table) == set(range(10)) and counts.max() - counts.min() <= 1
    fewer = maglev.fill_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 9)
    assert moved < 0.25 * 1009  # most slots of the shards that stay do so
    for bad in (((), 7), (("a", "a"), 7), (("a", "b"), 8), (("a",), 1)):
        with pytest.raises(ValueError):
            maglev.fill_table(*bad)
    df = spark.createDataFrame([(1, "x", 5), (1, "y", 6), (None, None, 7), (2, "", 8)], "doc_id long, text string, slot int")
    got = maglev.place(df, "doc_id", names, 1009).collect()
    want = {k: int(hashlib.md5(str("" if k is None else k).encode()).hexdigest()[:8], 16) % 1009 for k in (1, 2, None)}
    assert len(got) == 4 and all(r.slot == want[r.doc_id] and r.shard_id == table[r.slot] for r in got)
    assert maglev.place(df.where("false"), "doc_id").collect() == []
