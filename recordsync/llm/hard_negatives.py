"""Hard negatives by coordinate pruning in length buckets (operator 11).

Rows are sorted by label and length and cut into buckets; a bucket holds its rows' vectors and, for every coordinate, the
list of its rows sorted by that coordinate of their unit vectors.  An anchor that asks for scores of at least t needs an
angle of cos >= t / (its length * the bucket's greatest length): beyond 1 the whole bucket is out; else the angle bounds
each coordinate of a fitting row.  For the anchor's few largest (focus) coordinates, binary searches in the sorted lists
give the rows within those bounds, the sets are intersected, and what is left is verified by its exact integer score.

One search serves both steps: each anchor asks first for the best rows of its own label, then, per positive, for the best
rows of other labels between a share of the positive's score and that score.  Blocks of anchors meet groups of buckets;
what t is known to be grows while a group's buckets are searched, longest first.  A first round over about the square
root of the groups gives every ask a t to start the other groups with, so that these return little.

Defined cases: rows without an id, label or vector, or with a null or non-finite component take no part; a vector that is
shorter than others counts as followed by zeros; zero vectors score 0; repeated rows are rows of their own, also as
anchors, and an anchor is not its own positive, a repetition of it may be; ties go to the smaller id; positives of a
negative score have no hard negatives; without anchors, or on an empty table, there are no rows; scores beyond a long
raise an error.  Other columns of the table play no part, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import partitions, read, written

SCALE = 256
POSITIVES = NEGATIVES = 5
#: A negative's score is at least this part of the positive's, as a fraction.
SHARE = (80, 100)
#: Rows of a bucket, buckets of a group (on average), anchors of a block, focus coordinates.
BUCKET, GROUP, BLOCK, FOCUS = 1024, 4, 1024, 3
#: Where the shortest feasible range has more than this part of a bucket, its rows are verified at once.
DENSE = 0.25
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def usable(df: DataFrame, vec_id: str, vector: str, label: Column) -> DataFrame:
    """(row, id, label, vector of integers as doubles, norm) of the rows that take part; written out."""
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("id"), label.cast("long").alias("label"),
                     F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)

    def rounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            values = np.floor(column.flatten().to_numpy(zero_copy_only=False) * float(SCALE)) + 0.0
            offsets = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))])
            squares = np.concatenate([[0.0], np.cumsum(values * values)])
            norms = np.sqrt(np.maximum(squares[offsets[1:]] - squares[offsets[:-1]], 0.0))  # an order only: see Bucket
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(values)), pa.array(norms)], ["id", "label", "vector", "norm"])

    whole = rows.mapInArrow(rounded, "id long, label long, vector array<double>, norm double")
    return written(whole.withColumn("row", F.monotonically_increasing_id()))


def _matrix(vectors: list[np.ndarray]) -> np.ndarray:
    d = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), d))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _packed(x: np.ndarray) -> tuple[bytes, str]:
    kind = "<i2" if not x.size or np.abs(x).max() < 1 << 15 else "<f8"
    return x.astype(kind).tobytes(), kind


def _unpacked(data: bytes, kind: str, n: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(n, -1).astype(np.float64)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of integers (longs, or Python's integers where sums may pass 2**53)."""
    d = min(a.shape[1], b.shape[1])
    a, b = a[:, :d], b[:, :d]
    largest = (float(np.abs(a).max()) * float(np.abs(b).max()) * d) if a.size and b.size else 0.0
    if largest < 1 << 53:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return whole(a) @ whole(b).T


_BUCKET = "n int, low long, high long, ids binary, rows binary, labels binary, vectors binary, kind string, lists binary"


def buckets(rows: DataFrame) -> DataFrame:
    """Length buckets with their sorted coordinate lists, one per row; written out."""
    size = BUCKET

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                kept.append(row)
                if len(kept) == size:
                    yield bucket(kept)
                    kept = []
        if kept:
            yield bucket(kept)

    def bucket(kept: list[dict]) -> pa.RecordBatch:
        x = _matrix([np.array(r["vector"]) for r in kept])
        data, kind = _packed(x)
        ids, numbers, labels = (np.array([r[c] for r in kept], np.int64) for c in ("id", "row", "label"))
        lists = np.argsort(_unit(x)[0], axis=0, kind="stable").T.astype("<u2")
        made = [len(kept), int(labels.min()), int(labels.max()), ids.tobytes(), numbers.tobytes(), labels.tobytes(), data, kind,
                np.ascontiguousarray(lists).tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(made, _TYPES)], _NAMES)

    order = ["label", F.desc("norm"), "row"]
    sorted_rows = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    return written(sorted_rows.select("id", "row", "label", "vector").mapInArrow(cut, _BUCKET).withColumn(
        "bucket", F.monotonically_increasing_id()))


_NAMES = [c.strip().split()[0] for c in _BUCKET.split(",")]
_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.string(), pa.binary()]


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length 1 (zero rows stay), and the lengths."""
    largest = np.abs(x).max(axis=1, initial=0.0)
    scaled = x / np.where(largest > 0, largest, 1.0)[:, None]
    norms = np.sqrt((scaled * scaled).sum(axis=1))
    return scaled / np.where(norms > 0, norms, 1.0)[:, None], norms * largest


class Bucket:
    """A bucket of the index, as a task searches it."""

    def __init__(self, row) -> None:
        self.x = _unpacked(row.vectors, row.kind, row.n)
        self.ids, self.rows, self.labels = (np.frombuffer(b, np.int64) for b in (row.ids, row.rows, row.labels))
        self.low, self.high = row.low, row.high
        self.unit, norms = _unit(self.x)
        self.length = float(norms.max())
        self.lists = np.frombuffer(row.lists, "<u2").reshape(-1, row.n)
        self.sorted = np.take_along_axis(self.unit.T, self.lists.astype(np.int64), axis=1)  # values along each list

    def feasible(self, unit: np.ndarray, least: float) -> np.ndarray | None:
        """Rows that can be within cos >= ``least`` of an anchor's unit vector; None: too many, take all."""
        wide = math.acos(min(1.0, least))
        ranges = []
        for f in np.argsort(-np.abs(unit))[:FOCUS]:
            if f >= len(self.lists):  # this bucket's rows are shorter: zeros there
                continue
            angle = math.acos(max(-1.0, min(1.0, float(unit[f]))))
            low, high = math.cos(min(math.pi, angle + wide)) - 1e-9, math.cos(max(0.0, angle - wide)) + 1e-9
            first, last = np.searchsorted(self.sorted[f], low), np.searchsorted(self.sorted[f], high, "right")
            ranges.append((last - first, f, first, last, low, high))
        if not ranges:
            return None
        count, f, first, last, _, _ = min(ranges)
        if count > DENSE * len(self.x):
            return None
        found = self.lists[f, first:last].astype(np.int64)
        for _, other, _, _, low, high in ranges:
            if other != f:
                at = self.unit[found, other]
                found = found[(at >= low) & (at <= high)]
        return found


class Asks:
    """The asks of a block's anchors, and the best rows found for each."""

    def __init__(self, block: pd.DataFrame, k: int) -> None:
        self.k = k
        self.x = _matrix([np.asarray(v, dtype=np.float64) for v in block["vector"]])
        self.unit, self.norms = _unit(self.x)
        self.rows, self.labels = block["row"].to_numpy(np.int64), block["label"].to_numpy(np.int64)
        self.asks = [[[int(a["ask"]), int(a["low"]), int(a["high"])] for a in some] for some in block["asks"]]
        self.best: list[list[list[tuple[int, int]]]] = [[[] for _ in some] for some in self.asks]

    def search(self, bucket: Bucket, same: bool) -> None:
        dense, sparse = [], []
        for i, some in enumerate(self.asks):
            if not some:
                continue
            if same and not bucket.low <= self.labels[i] <= bucket.high:
                continue
            if not same and bucket.low == bucket.high == self.labels[i]:
                continue
            least = min(a[1] for a in some)
            reach = self.norms[i] * bucket.length
            if least <= 0:
                dense.append(i)
            elif least <= reach * (1 + 1e-9):
                rows = bucket.feasible(self.unit[i], least / reach * (1 - 1e-9))
                if rows is None:
                    dense.append(i)
                elif len(rows):
                    sparse.append((i, rows))
        if dense:
            for i, scored in zip(dense, scores(self.x[dense], bucket.x)):
                self.take(i, scored, bucket, np.arange(len(bucket.x)), same)
        for i, rows in sparse:
            self.take(i, scores(self.x[i:i + 1], bucket.x[rows])[0], bucket, rows, same)

    def take(self, i: int, scored: np.ndarray, bucket: Bucket, rows: np.ndarray, same: bool) -> None:
        fits = (bucket.labels[rows] == self.labels[i]) == same
        fits &= bucket.rows[rows] != self.rows[i]
        scored, ids = scored[fits], bucket.ids[rows][fits]
        for ask, best in zip(self.asks[i], self.best[i]):
            here = np.flatnonzero((scored >= ask[1]) & (scored <= ask[2]))
            if not len(here):
                continue
            first = here[np.lexsort((ids[here], -scored[here]))[:self.k]]
            best += [(-int(scored[j]), int(ids[j])) for j in first]
            best.sort()
            del best[self.k:]
            if len(best) == self.k:
                ask[1] = max(ask[1], -best[-1][0])


def _searching(k: int, same: bool) -> Callable:
    def run(index: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(index) and len(blocks):
            found = sorted((Bucket(r) for r in index.itertuples()), key=lambda b: -b.length)
            for start in range(0, len(blocks), BLOCK):
                asks = Asks(blocks.iloc[start:start + BLOCK], k)
                for bucket in found:
                    asks.search(bucket, same)
                for row, some, best in zip(asks.rows, asks.asks, asks.best):
                    out += [(int(row), ask[0], i, -s) for ask, hits in zip(some, best) for s, i in hits]
        return pd.DataFrame(out, columns=["row", "ask", "id", "score"])
    return run


def best_rows(asking: DataFrame, index: DataFrame, k: int, same: bool) -> DataFrame:
    """(row, ask, id, score, rank) of the first ``k`` index rows for each ask, best first; written out.

    asking: row, label, vector, asks (array of (ask, low, high): bounds of the score, both within).
    """
    groups = max(1, -(-index.count() // GROUP))
    blocks = max(1, -(-asking.count() // (4 * BLOCK)))
    first_round = math.isqrt(groups - 1) + 1 if groups > 1 else 1  # groups searched first
    spread = index.withColumn("part", F.pmod(F.xxhash64("bucket"), F.lit(groups)).cast("int"))
    spread = spread.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    order = [F.desc("score"), F.asc("id")]
    ranked = F.row_number().over(Window.partitionBy("row", "ask").orderBy(*order))

    def search(asked: DataFrame, low: int, high: int) -> DataFrame:
        copied = asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).withColumn(
            "part", F.explode(F.sequence(F.lit(low), F.lit(high - 1))))
        found = spread.where(F.col("part").between(low, high - 1)).groupBy("part", "block").cogroup(
            copied.groupBy("part", "block")).applyInPandas(_searching(k, same), "row long, ask int, id long, score long")
        return written(found.withColumn("rank", ranked).where(F.col("rank") <= k))

    found = search(asking, 0, first_round)
    if first_round == groups:
        return found
    known = found.where(F.col("rank") == k).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("ask", "score"))).alias("known"))
    raised = F.transform("asks", lambda a: F.struct(a["ask"].alias("ask"), F.greatest(
        a["low"], F.coalesce(F.element_at("known", a["ask"]), F.lit(_LEAST))).alias("low"), a["high"].alias("high")))
    started = asking.join(known, "row", "left").withColumn("asks", raised).drop("known")
    both = found.drop("rank").unionByName(search(started, first_round, groups).drop("rank"))
    return written(both.withColumn("rank", ranked).where(F.col("rank") <= k))


def mine(df: DataFrame, anchor: Column, label: Column, vec_id: str = "vec_id", vector: str = "embedding",
         positives: int = POSITIVES, negatives: int = NEGATIVES, share: tuple[int, int] = SHARE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every anchor (``anchor`` over the
    column ``id``) and each of its best rows of the same label, the best rows of other labels that score at least
    ``share`` of that positive's score and not more than it."""
    rows = usable(df, vec_id, vector, label)
    index = buckets(rows)
    one = F.array(F.struct(F.lit(0).alias("ask"), F.lit(_LEAST).alias("low"), F.lit(_MOST).alias("high")))
    asking = written(rows.where(anchor).select("row", "id", "label", "vector"))
    close = best_rows(asking.select("row", "label", "vector", one.alias("asks")), index, positives, True)
    cut = math.gcd(*share)
    less, whole = (share[1] - share[0]) // cut, share[1] // cut
    low = F.expr(f"score - (score * {less}L) div {whole}L")  # the least integer of that share
    wanted = close.where("score >= 0").groupBy("row").agg(F.collect_list(F.struct(
        F.col("rank").alias("ask"), low.alias("low"), F.col("score").alias("high"))).alias("asks"))
    hard = best_rows(asking.select("row", "label", "vector").join(wanted, "row"), index, negatives, False)
    told = close.select("row", F.col("rank").alias("ask"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return hard.join(told, ["row", "ask"]).join(asking.select("row", F.col("id").alias("anchor_id")), "row").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), F.col("id") % 100 == 0, label)


OP11_SQL = """
    WITH rows AS (
        SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT a.r, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
        FROM rows a JOIN rows b ON a.r <> b.r WHERE a.vec_id % 100 = 0
    ), positives AS (
        SELECT r, anchor_id, vec_id AS positive_id, score AS positive_score, n FROM (
            SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS n FROM scored WHERE same) WHERE n <= 5
    ), fitting AS (
        SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
               row_number() OVER (PARTITION BY p.r, p.n ORDER BY s.score DESC, s.vec_id) AS rank
        FROM positives p JOIN scored s ON s.r = p.r AND NOT s.same
            AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
    )
    SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM fitting WHERE rank <= 5
"""
