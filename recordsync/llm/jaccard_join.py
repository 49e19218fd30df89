"""Size-aware heavy-light Jaccard join on word shingles (operator 1).

Texts become sets of hashed shingles.  Equal sets are one class, represented
by its smallest doc_id.  Two sets of sizes a and b link when their overlap is
at least ``need(a, b)``, so a set may lack only few of its elements.

Light: sets up to a boundary size emit, for each size b of a possible partner,
the hashes of all their subsets of ``need(a, b)`` elements (a set's hash is the
sum of its elements' hashes, so dropping elements is a subtraction).  Sets that
share a subset link by definition; in a bucket of such sets all link to its
smallest one of the smaller size.

Heavy: larger sets enter inverted lists, each with the prefix of its elements
(frequent ones last) that any partner must share, and a parity sketch of all of
them.  The bits in which two sketches differ are at most the elements in which
the sets differ, so a scan of a list can drop pairs without losing a link.  A
list yields a forest over the pairs left, not the pairs; the forest's edges are
verified on the whole sets.  A list with a refuted edge is scanned again with
sketches doubled ``FINER`` times, which differ in nearly as many bits as the
sets do in elements, and yields every pair left between the parts that the
verified edges made; these are few, and are verified too.
Lists beyond ``BLOCK`` members are dealt out in blocks, each pair of blocks to
its own task.

The boundary is the size at which enumerating costs what scanning does, from
the sizes of all sets (see ``boundary``).  Links then make components.

Defined cases: texts without words have empty sets and link with nothing; null
ids are not representatives and stay alone; rows of equal id count as one
document with the sets of all its texts; a very long text is one set, held by
the task that reads it; an empty table gives no rows; columns with the names of
new ones are not handed on.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytespans import BLANK, LOWER, chunks, hashes, mixed, spans
from .common import discard, intermediate, partitions, read, short_batches, small, written
from .components import components

SHINGLE, NUMERATOR, DENOMINATOR = 3, 90, 100
#: Members of a list that one task scans at once.
BLOCK = 8192
#: Cost of one scanned posting, by that of one emitted subset.
SCAN_COST = 40
LARGEST_LIGHT = 64
#: Doublings of a sketch's length for the second scan.
FINER = 5
#: Ids that a semi join broadcasts at most (8 bytes each).
BROADCAST_IDS = 500_000
#: Elements of several texts that a task holds to count them.
COUNTED = 1 << 22
#: Most frequent elements that are moved to the end of every prefix (8 bytes each, broadcast).
FREQUENT = 200_000


class Rule:
    """100 * overlap >= 90 * union, or another ratio."""

    def __init__(self, numerator: int, denominator: int):
        self.p, self.q = numerator, denominator

    def need(self, a: int, b: int) -> int:
        """Least overlap of linked sets of these sizes."""
        return -(-self.p * (a + b) // (self.p + self.q))

    def least(self, a: int) -> int:
        """Smallest size of a partner of a set of size a."""
        return -(-self.p * a // self.q)

    def most(self, a: int) -> int:
        return a * self.q // self.p

    def prefix(self, a: np.ndarray) -> np.ndarray:
        """Elements to index so that linked sets share one: all but what any partner must share, and one."""
        return a - -(-self.p * a // self.q) + 1

    def differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Most elements in which linked sets differ."""
        total = a + b
        return total - 2 * -(-self.p * total // (self.p + self.q))

    def links(self, overlap: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.q * overlap >= self.p * (a + b - overlap)

    def subsets(self, b: int) -> list[tuple[int, int, int]]:
        """(smaller size, larger size, elements dropped) of the subsets that a set of size b emits."""
        sizes = [(min(a, b), max(a, b)) for a in range(self.least(b), self.most(b) + 1)]
        return [(a, c, b - self.need(a, c)) for a, c in sizes if self.need(a, c) <= a]

    def n_subsets(self, b: int) -> int:
        return sum(math.comb(b, d) for _, _, d in self.subsets(b))


def boundary(rule: Rule, sizes: dict[int, int]) -> int:
    """Largest light size: while the subsets of the sets of the next size cost less than to scan their postings.

    sizes: number of distinct sets of each size.  A set's scan costs its prefix times SCAN_COST.
    """
    light = 0
    for size in range(1, LARGEST_LIGHT + 1):
        scan = int(rule.prefix(np.array([size]))[0]) * SCAN_COST
        if sizes.get(size, 0) and rule.n_subsets(size) > scan:
            break
        light = size
    return light


def sketch_bits(rule: Rule, size: np.ndarray) -> np.ndarray:
    """Bits of the sketch of a class of sizes: about 4 to 8 times what linked sets may differ in."""
    return 1 << np.maximum(6, np.ceil(np.log2(np.maximum(1, 4 * rule.differ(size, size)))).astype(int))


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets, elements): the sorted sets of runs of rows."""
    for row, offsets, data in chunks(column):
        data = LOWER[data]
        text, starts, ends = spans(offsets, data, ~BLANK)
        words = hashes(data, starts, ends)
        n_rows = len(offsets) - 1
        n = np.bincount(text, minlength=n_rows)
        first = np.cumsum(n) - n
        count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
        owner = np.repeat(np.arange(n_rows), count)
        at = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        value = np.zeros(len(owner), np.uint64)
        for j in range(k):
            there = j < n[owner]
            word = np.where(there, words[np.minimum(at + j, len(words) - 1)] if len(words) else 0, np.uint64(0))
            value = np.where(there, mixed(value + word + np.uint64(j + 1)), value)
        order = np.lexsort((value, owner))
        owner, value = owner[order], value[order]
        new = np.ones(len(value), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
        owner, value = owner[new], value[new]
        yield row, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n_rows))]), value


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.uint64).view(np.int64)


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType = pa.int64()) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def _set_hash(value: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for salt in (1, 2):
        summed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(value * np.uint64(2) + np.uint64(salt)))])
        out.append(_signed(summed[bounds[1:]] - summed[bounds[:-1]]))
    return out[0], out[1]


def frequent_elements(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(elements, levels): the most frequent elements with the level of their frequency, at most FREQUENT.
    Counts are over all documents (a task reports what 3 of some COUNTED elements' texts have); only the order of prefixes
    depends on them, so a low count costs time and no link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: list[np.ndarray] = []

        def reported() -> pa.RecordBatch:
            value, n = np.unique(np.concatenate(met) if met else np.zeros(0, np.uint64), return_counts=True)
            met.clear()
            return pa.RecordBatch.from_arrays([pa.array(_signed(value[n > 2])), pa.array(n[n > 2])], ["element", "n"])
        held = 0
        for batch in batches:
            for _, _, value in shingle_sets(batch.column("text"), k):
                met.append(value)
                held += len(value)
                if held >= COUNTED:
                    yield reported()
                    held = 0
        yield reported()
    counted = docs.select("text").mapInArrow(run, "element long, n long").groupBy("element").agg(F.sum("n").alias("n"))
    counted = written(counted.select("element", F.floor(F.log2("n") * 4).cast("int").alias("level")))
    bins = {r.level: r["count"] for r in counted.groupBy("level").count().collect()}  # 256 rows at most
    total, least = 0, max(bins, default=0) + 1
    for level in sorted(bins, reverse=True):
        total += bins[level]
        if total > FREQUENT:
            break
        least = level
    rows = counted.where(F.col("level") >= least).toArrow()  # at most FREQUENT
    elements, levels = rows["element"].to_numpy(), rows["level"].to_numpy()
    order = np.argsort(elements)
    return elements[order].astype(np.int64), levels[order].astype(np.int16)


def _sketch(part: np.ndarray, bits: int) -> bytes:
    flips = np.bincount((part >> np.uint64(13)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(flips.astype(bool)).tobytes()


def _folded(sketch: bytes, bits: int) -> np.ndarray:
    """A sketch as words of 64 bits, folded to fewer bits (parities of the halves add up)."""
    words = np.frombuffer(sketch, np.uint64)
    while len(words) * 64 > bits:
        words = words[:len(words) // 2] ^ words[len(words) // 2:]
    return words


def document_sets(docs: DataFrame, k: int, rule: Rule, frequent) -> DataFrame:
    """(id, n, h1, h2, low, high, elements, sketch) of each document; docs: id, text.

    elements: the prefix of the set, rare elements first, or all of a small set.  sketch: its parities in
    2**high bits, for the largest class of sizes that a partner is in; low: the same of its own class.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late, levels = frequent.value
        for batch in batches:
            for row, bounds, value in shingle_sets(batch.column("text"), k):
                h1, h2 = _set_hash(value, bounds)
                size = np.diff(bounds)
                owner = np.repeat(np.arange(len(size)), size)
                element = _signed(value)
                level = np.zeros(len(element), np.int16)
                if len(late):
                    at = np.minimum(np.searchsorted(late, element), len(late) - 1)
                    level = np.where(late[at] == element, levels[at] + 1, 0)
                order = np.lexsort((element, level, owner))
                place = np.arange(len(order)) - bounds[:-1][owner]
                kept = order[place < np.where(size <= LARGEST_LIGHT, size, rule.prefix(size))[owner]]
                n = np.bincount(owner[kept], minlength=len(size))
                high = sketch_bits(rule, size * rule.q // rule.p)
                sketch = [_sketch(value[x:y], b) for x, y, b in zip(bounds[:-1], bounds[1:], high.tolist())]
                log = [np.round(np.log2(x)).astype(np.int64) for x in (sketch_bits(rule, size), high)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(row, len(size)), pa.array(size), pa.array(h1), pa.array(h2), pa.array(log[0]),
                     pa.array(log[1]), _lists(element[kept], np.concatenate([[0], np.cumsum(n)])), pa.array(sketch, pa.binary())],
                    ["id", "n", "h1", "h2", "low", "high", "elements", "sketch"])
    return docs.select("id", "text").mapInArrow(
        run, "id long, n long, h1 long, h2 long, low long, high long, elements array<long>, sketch binary")


def _light_rows(rule: Rule, light: int, ids: np.ndarray, bounds: np.ndarray, value: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(small, large, s1, s2, n, id) of the subsets of the light sets."""
    size = np.diff(bounds)
    e1, e2 = (mixed(value * np.uint64(2) + np.uint64(salt)) for salt in (1, 2))
    for b in np.unique(size[(size > 0) & (size <= light)]):
        rows = np.flatnonzero(size == b)
        at = bounds[rows][:, None] + np.arange(b)
        part = [e1[at], e2[at]]
        whole = [x.sum(axis=1, dtype=np.uint64)[:, None] for x in part]
        for small, large, dropped in rule.subsets(int(b)):
            picks = np.array(list(itertools.combinations(range(b), dropped)), np.int64).reshape(math.comb(b, dropped), dropped)
            sums = [w - x[:, picks].sum(axis=2, dtype=np.uint64) for w, x in zip(whole, part)]
            n = sums[0].size
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, small)), pa.array(np.full(n, large)), pa.array(_signed(sums[0].ravel())),
                 pa.array(_signed(sums[1].ravel())), pa.array(np.full(n, b)), pa.array(np.repeat(ids[rows], len(picks)))],
                ["small", "large", "s1", "s2", "n", "id"])


def light_edges(reps: DataFrame, rule: Rule, light: int) -> DataFrame:
    """(a, b) links between sets up to the boundary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            lists = batch.column("elements")
            bounds = lists.offsets.to_numpy().astype(np.int64)
            value = lists.values.to_numpy(zero_copy_only=False)[bounds[0]:bounds[-1]].view(np.uint64)
            yield from _light_rows(rule, light, ids, bounds - bounds[0], value)
    subsets = reps.where(F.col("n") <= light).select("id", "elements").mapInArrow(
        run, "small long, large long, s1 long, s2 long, n long, id long")
    key = ["small", "large", "s1", "s2"]
    buckets = written(subsets)
    # A bucket is a star around one of its sets, not its pairs.
    centres = buckets.groupBy(*key).agg(F.min(F.when(F.col("n") == F.col("small"), F.col("id"))).alias("centre"),
                                        F.count(F.lit(1)).alias("members"))
    centres = centres.where("members > 1 AND centre IS NOT NULL").drop("members")
    return buckets.join(centres, key).where("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()


def _candidates(rule: Rule, sketch: np.ndarray, size: np.ndarray, i: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ``others``, those that the sizes and sketches allow to link with i, and the bits in which they differ."""
    ok = (size[others] >= -(-rule.p * size[i] // rule.q)) & (rule.p * size[others] <= rule.q * size[i])
    others = others[ok]
    apart = np.bitwise_count(sketch[others] ^ sketch[i]).sum(axis=1, dtype=np.int64)
    ok = apart <= rule.differ(size[others], size[i])
    return others[ok], apart[ok]


def scan_list(rule: Rule, ids: np.ndarray, size: np.ndarray, sketch: np.ndarray, side: np.ndarray,
              part: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """Pairs (ids) of a list.  Without ``part``: a forest over its candidate pairs.  With it: every
    candidate pair of different parts.  side: 0 and 1 for two different blocks (pairs within are scanned
    elsewhere), or one value."""
    n, two = len(ids), side.min() != side.max()  # two rows of one id are one node
    order = np.argsort(ids, kind="stable")
    ids, size, sketch, side = ids[order], size[order], sketch[order], side[order]
    root = np.arange(n) if part is None else part[order]
    for i in range(1, n):
        others = np.arange(i)
        if two:
            others = others[side[:i] != side[i]]
        if part is not None:
            others = others[root[others] != root[i]]
        near, apart = _candidates(rule, sketch, size, i, others)
        if part is not None:
            yield from ((int(ids[j]), int(ids[i])) for j in near if ids[j] != ids[i])
        elif len(near):
            # The earliest of the nearest first, so that the lists of a group of copies agree on their edges.
            near = near[np.lexsort((near, apart))]
            for r in np.unique(root[near], return_index=True)[1]:
                j = near[r]
                if root[j] != root[i]:
                    if ids[j] != ids[i]:
                        yield int(ids[j]), int(ids[i])
                    root[root == root[i]] = root[j]


def _scan(rule: Rule, parted: bool, finer: int):
    """Scans lists whose rows come sorted: one list is held at a time, short ones many at once."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["bits", "element", "i", "j"]
        held: pd.DataFrame | None = None

        def scanned(rows: pd.DataFrame) -> pd.DataFrame:
            found: list[tuple] = []
            change = np.ones(len(rows) + 1, bool)
            change[1:-1] = (rows[names].to_numpy()[1:] != rows[names].to_numpy()[:-1]).any(axis=1)
            bounds = np.flatnonzero(change)
            ids, size, side = rows.id.to_numpy(), rows.n.to_numpy(), rows.side.to_numpy()
            keys, sketch = rows[names].to_numpy(), rows.sketch.to_numpy()
            part = rows.part.to_numpy() if parted else None
            for a, b in zip(bounds[:-1], bounds[1:]):
                if b - a > 1:
                    bits = np.stack([_folded(x, 1 << int(keys[a, 0] + finer)) for x in sketch[a:b]])
                    found += [(*keys[a, :2].tolist(), *pair) for pair in scan_list(
                        rule, ids[a:b], size[a:b], bits, side[a:b], None if part is None else part[a:b])]
            return pd.DataFrame(found, columns=["bits", "element", "a", "b"])

        for rows in batches:
            rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
            last = (rows[names] == rows[names].iloc[-1]).all(axis=1).to_numpy()
            held, whole = rows[last], rows[~last]
            if len(whole):
                yield scanned(whole)
        if held is not None:
            yield scanned(held)
    return run


def _shared(lists: DataFrame, index: DataFrame) -> DataFrame:
    """One row per set and list, copied to every pair of the list's blocks that the set's block is in."""
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    every = lists.withColumn("blocks", blocks).withColumn("mine", mine).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = every.select("bits", "element", "id", "n", F.least("mine", "other").alias("i"),
                          F.greatest("mine", "other").alias("j"),
                          (F.col("mine") > F.col("other")).cast("int").alias("side"))
    return placed.join(index, "id")


def heavy_pairs(lists: DataFrame, index: DataFrame, rule: Rule, part: DataFrame | None = None) -> DataFrame:
    """(bits, element, a, b): pairs to verify."""
    rows = _shared(lists, index)
    if part is not None:
        rows = rows.join(part.select(F.col("node").alias("id"), F.col("component").alias("part")), "id", "left").withColumn(
            "part", F.coalesce("part", "id"))
    key = ["bits", "element", "i", "j"]
    dealt = rows.repartition(partitions(lists.sparkSession), *key).sortWithinPartitions(*key, "id")
    finer = 0 if part is None else FINER
    return dealt.mapInPandas(_scan(rule, part is not None, finer), "bits long, element long, a long, b long")


def verify(pairs: DataFrame, docs: DataFrame, k: int, rule: Rule) -> DataFrame:
    """(a, b, linked): the pairs compared on their whole sets; docs: id, text."""
    pairs = pairs.select("a", "b").distinct()
    needed = small(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(),
                   BROADCAST_IDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, bounds, value in shingle_sets(batch.column("text"), k):
                raw = [value[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(row, len(raw)), pa.array(raw, pa.binary())],
                                                 ["id", "elements"])
    sets = written(docs.select("id", "text").join(needed, "id", "left_semi").mapInArrow(run, "id long, elements binary"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            linked = []
            for x, y in zip(rows.x, rows.y):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                linked.append(bool(rule.links(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))))
            yield pd.DataFrame({"a": rows.a, "b": rows.b, "linked": linked})
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("elements").alias("x")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("elements").alias("y")), "b")
    compared = both.mapInPandas(compare, "a long, b long, linked boolean")
    return compared.groupBy("a", "b").agg(F.max("linked").alias("linked"))  # an id may have several texts


def finer_sketches(reps: DataFrame, docs: DataFrame, k: int, rule: Rule) -> DataFrame:
    """(id, sketch) of ``reps`` (id, n, h1, h2), longer ones than document_sets gives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, bounds, value in shingle_sets(batch.column("text"), k):
                h1, h2 = _set_hash(value, bounds)
                size = np.diff(bounds)
                bits = sketch_bits(rule, size * rule.q // rule.p) << FINER
                sketch = [_sketch(value[x:y], b) for x, y, b in zip(bounds[:-1], bounds[1:], bits.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(row, len(size)), pa.array(size), pa.array(h1), pa.array(h2),
                     pa.array(sketch, pa.binary())], ["id", "n", "h1", "h2", "sketch"])
    asked = docs.select("id", "text").join(small(reps.select("id").distinct(), BROADCAST_IDS), "id", "left_semi")
    made = asked.mapInArrow(run, "id long, n long, h1 long, h2 long, sketch binary")
    key = ["id", "n", "h1", "h2"]
    return made.join(reps.select(*key), key, "left_semi").dropDuplicates(key).select("id", "sketch")


def heavy_edges(reps: DataFrame, docs: DataFrame, k: int, rule: Rule, light: int) -> DataFrame:
    """(a, b) links of sets above the boundary with any set, enough of them to connect what links connect."""
    floor = rule.least(light + 1)
    prefix = F.col("n") - F.ceil(F.col("n") * rule.p / rule.q) + 1
    prefix = F.when(F.col("n") <= LARGEST_LIGHT, F.slice("elements", F.lit(1), prefix.cast("int"))).otherwise(F.col("elements"))
    flat = reps.where(F.col("n") >= floor).select("id", "n", "low", "high", F.explode(prefix).alias("element"))
    # A set is in the lists of its class of sizes and of the classes of its larger partners.
    flat = flat.select("id", "n", "element", F.explode(F.sequence("low", "high")).alias("bits"))
    count = flat.groupBy("bits", "element").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    with intermediate() as scanned:
        lists = written(flat.join(count, ["bits", "element"]))
        index = written(reps.select("id", "n", "sketch").join(lists.select("id").distinct(), "id", "left_semi").drop("n"))
        pairs = written(heavy_pairs(lists, index, rule))
    checked = written(verify(pairs, docs, k, rule))
    linked, refuted = checked.where("linked").select("a", "b"), checked.where("NOT linked").select("a", "b")
    if refuted.isEmpty():
        return linked
    again = pairs.join(refuted, ["a", "b"], "left_semi").select("bits", "element").distinct()
    rescanned = written(lists.join(again, ["bits", "element"], "left_semi"))
    discard(reps.sparkSession, scanned)
    index = written(finer_sketches(reps.join(rescanned.select("id").distinct(), "id", "left_semi"), docs, k, rule))
    more = heavy_pairs(rescanned, index, rule, components(linked))
    more = written(more.select("a", "b").distinct().join(refuted, ["a", "b"], "left_anti"))
    return linked.unionByName(verify(more, docs, k, rule).where("linked").select("a", "b"))


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE,
         ratio: tuple[int, int] = (NUMERATOR, DENOMINATOR)) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``."""
    with short_batches(docs.sparkSession):  # sets and sketches are long rows
        return _joined(docs, doc_id, text, k, ratio)


def _joined(docs: DataFrame, doc_id: str, text: str, k: int, ratio: tuple[int, int]) -> DataFrame:
    spark, rule = docs.sparkSession, Rule(*ratio)
    named = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    frequent = spark.sparkContext.broadcast(frequent_elements(named, k))
    with intermediate() as fat:
        found = written(document_sets(named, k, rule, frequent))
    key = ["h1", "h2", "n"]
    whole = found.where("id IS NOT NULL AND n > 0")
    classes = written(whole.groupBy(*key).agg(F.min("id").alias("id")))
    reps = written(whole.join(classes, ["id", *key], "left_semi").dropDuplicates(["id", *key]))
    sizes = {r.n: r["count"] for r in classes.where(F.col("n") <= LARGEST_LIGHT).groupBy("n").count().collect()}
    light = boundary(rule, sizes)
    texts = named.where("id IS NOT NULL")
    members = written(whole.select("id", *key).join(classes.withColumnRenamed("id", "rep"), key).select("id", "rep").distinct())
    first = members.groupBy("id").agg(F.min("rep").alias("first"))
    several = members.join(first, "id").where("rep <> first").select(F.col("first").alias("a"), F.col("rep").alias("b"))
    found = written(found.select("id", "n"))
    discard(spark, fat)  # the sets themselves; those of the representatives stay
    with intermediate() as spent:
        edges = light_edges(reps, rule, light).unionByName(heavy_edges(reps, texts, k, rule, light)).unionByName(several)
        links = written(edges.select("a", "b").distinct())
    discard(spark, spent, links)
    part = components(links)
    of = first.join(part, first["first"] == part["node"], "left").select(
        "id", F.coalesce("component", "first").alias("component"))
    return found.select("id", "n").join(of, "id", "left").select(
        F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(read(spark, sf_dir, "documents").select("doc_id", "text"))
