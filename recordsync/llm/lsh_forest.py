"""Approximate nearest neighbours by a forest of sorted hash strings (operator 8).

Nearness is the inner product.  Vectors get one more component that brings all
candidates to the largest norm (queries get 0 there), so that nearness becomes
an angle; a tree hashes it to a string of ``BITS`` signs of random projections.
Each tree is the sorted array of its strings.  A query descends in all trees to
its own string and ascends in all of them at once: the prefix shared with the
query is shortened bit by bit until the entries that share it, over all trees,
are ``goal`` times the index's size, and ``2 * k`` per tree besides.  Where
even ``TOP`` bits are shared by more, each tree descends further by itself.
Entries that share the prefix stand side by side in the sorted array and are scored by the exact product on the original
vectors in double precision; every tree returns its best.

The arrays are cut into blocks of about ``BLOCK`` entries at prefixes of
``TOP`` bits, whose counts (a table of ``2 ** TOP`` rows per tree at most, from
all rows) say which blocks hold a query's entries.  A block with more entries
is split, one with many queries is copied, so that near copies of one vector do
not meet in one task.  Equal vectors are one entry with its smallest ids, as no
others can be among a query's nearest.

The planes are random (seeded), nothing is fitted, and every row is indexed.
Recall falls with ``goal``; the tests measure it against brute force.

Defined cases: vectors that are null, zero or hold null or non-finite
components take no part, nor do those whose length is not the most common one
(the larger, on a tie); repeated rows of one id with equal vectors are one;
null ids take no part; fewer candidates than ``k`` give fewer rows; ties go to
the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, row_key, written

K = 20
TREES, BITS, TOP = 24, 48, 12
GOAL = 0.75
BLOCK, QUERIES = 16384, 4096


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, vector of double) of the rows that take part."""
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    lengths = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = lengths.d if lengths else 0
    return rows.where(F.size("vector") == d).withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))  # -0 is 0


def planes(d: int, seed: int = 11) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((d + 1, TREES * BITS)).astype(np.float32)


def codes(vectors: np.ndarray, added: np.ndarray, normals: np.ndarray) -> np.ndarray:
    """Hash strings (rows, trees) of vectors with their added component."""
    whole = np.concatenate([vectors, added[:, None]], axis=1).astype(np.float32)
    signs = (whole @ normals > 0).reshape(len(whole), TREES, BITS)
    return signs @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def _hashed(rows: DataFrame, normals, largest: float, is_query: bool) -> DataFrame:
    """rows (rep, vector) with ``codes``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            found = []
            for k in range(0, len(x), 1024):
                part = x[k:k + 1024]
                added = np.zeros(len(part)) if is_query else np.sqrt(np.maximum(0, largest - (part * part).sum(1)))
                found.append(codes(part, added, normals.value))
            flat = np.concatenate(found).ravel() if found else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * TREES, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("vector"), lists], ["rep", "vector", "codes"])
    return rows.select("rep", "vector").mapInArrow(run, "rep long, vector array<double>, codes array<long>")


class Layout:
    """Where the sorted arrays are cut: from the number of entries under each prefix of TOP bits."""

    def __init__(self, counts: np.ndarray):
        self.below = np.concatenate([np.zeros((len(counts), 1), np.int64), np.cumsum(counts, axis=1)], axis=1)
        self.block = np.zeros(counts.shape, np.int32)  # of each prefix
        self.parts: list[list[int]] = []
        for t, row in enumerate(counts):
            held, number, sizes = 0, 0, [0]
            for prefix, n in enumerate(row.tolist()):
                if held and held + n > BLOCK:
                    number, held = number + 1, 0
                    sizes.append(0)
                self.block[t, prefix] = number
                held += n
                sizes[number] = held
            self.parts.append([max(1, -(-s // BLOCK)) for s in sizes])

    def level(self, prefixes: np.ndarray, goal: float) -> tuple[int, bool]:
        """Most shared bits (up to TOP) under which the trees together have ``goal`` entries, and whether
        TOP bits have more than that."""
        trees = np.arange(len(prefixes))
        for bits in range(TOP, -1, -1):
            shift = TOP - bits
            first = (prefixes >> shift) << shift
            n = int((self.below[trees, first + (1 << shift)] - self.below[trees, first]).sum())
            if n >= goal or not bits:
                return bits, bits == TOP and n > goal
        raise AssertionError

    def places(self, tree: int, prefix: int, bits: int) -> list[tuple[int, int]]:
        """(block, part) of the entries that share the prefix's first bits."""
        shift = TOP - bits
        first = (prefix >> shift) << shift
        blocks = np.unique(self.block[tree, first:first + (1 << shift)])
        return [(int(b), p) for b in blocks for p in range(self.parts[tree][b])]


def _routed(queries: DataFrame, layout, goal: float) -> DataFrame:
    """(rep, tree, block, part, code, bits, deep) of every visit of a query."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where = layout.value
        for rows in batches:
            out = []
            for rep, found in zip(rows.rep, rows.codes):
                found = np.asarray(found, np.int64)
                prefixes = found >> (BITS - TOP)
                bits, deep = where.level(prefixes, goal)
                for tree, (code, prefix) in enumerate(zip(found.tolist(), prefixes.tolist())):
                    out += [(rep, tree, block, part, code, bits, deep) for block, part in where.places(tree, prefix, bits)]
            yield pd.DataFrame(out, columns=["rep", "tree", "block", "part", "code", "bits", "deep"])
    return queries.select("rep", "codes").mapInPandas(
        run, "rep long, tree int, block int, part int, code long, bits int, deep boolean")


def _search(k: int, each: int):
    """Best ``k`` entries of a block for each of its queries."""
    def search(key: tuple, asked: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        names = ["query", "rep", "score"]
        if not len(asked) or not len(entries):
            return pd.DataFrame({n: [] for n in names})
        order = np.argsort(entries.code.to_numpy(), kind="stable")
        array, reps = entries.code.to_numpy()[order], entries.rep.to_numpy()[order]
        vectors = np.stack(entries.vector.to_numpy())[order]
        out = []
        for rep, code, bits, deep, vector in zip(asked.rep, asked.code, asked.bits, asked.deep, asked.vector):
            for shared in range(BITS if deep else bits, bits - 1, -1):
                shift = BITS - shared
                first = (code >> shift) << shift
                low, high = np.searchsorted(array, [first, first + (1 << shift)])
                if high - low >= each:
                    break
            score = vectors[low:high] @ vector
            best = np.arange(len(score))
            if len(best) > k:
                least = np.partition(score, -k)[-k]
                best = np.flatnonzero(score >= least)
            best = best[np.lexsort((reps[low:high][best], -score[best]))][:k]
            out.append(pd.DataFrame({"query": rep, "rep": reps[low:high][best], "score": score[best]}))
        return pd.concat(out, ignore_index=True)
    return search


def nearest(df: DataFrame, is_query, vec_id: str = "vec_id", vector: str = "embedding", k: int = K,
            goal: float = GOAL) -> DataFrame:
    """(query_id, rank, vec_id, score); is_query: a condition on the column ``id``."""
    spark = df.sparkSession
    rows = usable(df, vec_id, vector)
    keyed = written(rows.select("id", "vector", *row_key(F.col("vector"))).dropDuplicates(["id", "k1", "k2"]))
    # The k + 1 smallest ids of a vector: first within parts, as one vector may have most of the rows.
    part = Window.partitionBy("k1", "k2", F.pmod("id", F.lit(64))).orderBy("id")
    whole = Window.partitionBy("k1", "k2").orderBy("id")
    members = keyed.select("k1", "k2", "id").withColumn("__n", F.row_number().over(part)).where(F.col("__n") <= k + 1)
    members = members.withColumn("__n", F.row_number().over(whole)).where(F.col("__n") <= k + 1).drop("__n")
    reps = keyed.groupBy("k1", "k2").agg(F.min("id").alias("rep"))
    members = written(members.join(reps, ["k1", "k2"]).select("rep", "id"))
    asking = written(keyed.where(is_query).select("k1", "k2", "id").join(reps, ["k1", "k2"]).select("rep", "id"))
    entries = keyed.join(reps.withColumnRenamed("rep", "id"), ["id", "k1", "k2"], "left_semi").select(
        F.col("id").alias("rep"), "vector").dropDuplicates(["rep"])
    entries = written(entries)
    stats = entries.agg(F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)).alias("norm"),
                        F.max(F.size("vector")).alias("d"), F.count(F.lit(1)).alias("n")).first()
    normals = spark.sparkContext.broadcast(planes(stats.d or 1))
    index = written(_hashed(entries, normals, stats.norm or 0.0, False))
    placed = index.select("rep", "vector", F.posexplode("codes").alias("tree", "code"))
    top = F.shiftright("code", BITS - TOP)
    counts = np.zeros((TREES, 1 << TOP), np.int64)
    met = placed.groupBy("tree", top.alias("prefix")).count().toArrow()  # TREES * 2**TOP rows at most
    counts[met["tree"].to_numpy(), met["prefix"].to_numpy()] = met["count"].to_numpy()
    layout = Layout(counts)
    shared = spark.sparkContext.broadcast(layout)
    wanted = entries.join(asking.select("rep").distinct(), "rep", "left_semi")
    wish = goal * (stats.n or 0) + 2 * k * TREES
    visits = written(_routed(_hashed(wanted, normals, 0.0, True), shared, wish))
    loads = written(visits.groupBy("tree", "block", "part").count().select(
        "tree", "block", "part", F.ceil(F.col("count") / QUERIES).cast("int").alias("copies")))

    block = spark.createDataFrame([(t, b, n) for t, row in enumerate(layout.parts) for b, n in enumerate(row)],
                                  "tree int, block int, parts int")
    starts = [(t, int(p), int(layout.block[t, p])) for t in range(TREES)
              for p in np.unique(layout.block[t], return_index=True)[1]]
    cuts = spark.createDataFrame(starts, "tree int, start long, block int")
    ends = cuts.withColumn("end", F.coalesce(F.lead("start").over(Window.partitionBy("tree").orderBy("start")), F.lit(1 << TOP)))
    prefix_block = ends.select("tree", "block", F.explode(F.sequence("start", F.col("end") - 1)).alias("prefix"))
    looked = F.broadcast(prefix_block.join(block, ["tree", "block"]))  # TREES * 2**TOP rows
    dealt = placed.withColumn("prefix", top.cast("long")).join(looked, ["tree", "prefix"]).withColumn(
        "part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    copied = dealt.join(loads, ["tree", "block", "part"]).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    asked = visits.join(loads, ["tree", "block", "part"]).withColumn(
        "copy", F.pmod(F.xxhash64("rep"), F.col("copies")).cast("int")).join(wanted, "rep")
    key = ["tree", "block", "part", "copy"]
    best = asked.select(*key, "rep", "code", "bits", "deep", "vector").groupBy(*key).cogroup(
        copied.select(*key, "rep", "code", "vector").groupBy(*key)).applyInPandas(
        _search(k + 1, int(wish / TREES)), "query long, rep long, score double")
    best = best.groupBy("query", "rep").agg(F.max("score").alias("score"))
    order = [F.desc("score"), F.asc("id")]
    first = best.join(members, "rep").select("query", "id", "score").withColumn(
        "__n", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("__n") <= k + 1).drop("__n")
    each = asking.select(F.col("rep").alias("query"), F.col("id").alias("query_id")).join(first, "query").where("id <> query_id")
    ranked = each.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "query").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op8_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("id") % 20 == 0)
