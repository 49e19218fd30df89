"""Sums over documents of a value that each distinct token has (used by token counts and by LM scoring).

Each text is cut once, into its distinct tokens and how often each occurs.
The value is worked out once per distinct token of the corpus; documents join
to it.  The most frequent tokens make up most of all occurrences; up to
``HEAD`` of them are broadcast (long ones by a hash), so they cause no shuffle
and no hot key.  The rest are joined by a shuffle on the token; none of them is
as frequent as the tokens of the head.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import written

#: Characters of text cut at once (a longer text is a chunk of its own).
CHUNK = 1 << 20
#: Most tokens that are broadcast, and the bytes beyond which a token is joined by its hash: a bound of some 30 MB.
HEAD = 200_000
KEY_BYTES = 64
_STEPS = 16  # of the frequency histogram, for each doubling


def head_frequency(values: DataFrame, head: int) -> float:
    """The least frequency (on the histogram's grid) that at most ``head`` tokens reach."""
    step = F.floor(F.log2("freq") * _STEPS).cast("int")
    bins = values.where(F.col("freq") > 0).groupBy(step.alias("step")).count().collect()  # 64 * _STEPS rows at most
    total = 0
    for r in sorted(bins, key=lambda r: -r.step):
        total += r["count"]
        if total > head:
            return 2 ** ((r.step + 1) / _STEPS)
    return 0.0


def join_key(token: Column) -> Column:
    """The token, or for a long one 128 bits of its hash, after more bytes than a short one has."""
    hashed = F.concat(F.lit("\0" * KEY_BYTES), F.hex(F.xxhash64(F.lit(1), token)), F.hex(F.xxhash64(F.lit(2), token)))
    return F.when(F.octet_length(token) <= KEY_BYTES, token).otherwise(hashed)


def cut(rows: DataFrame, tokens_of: Callable[[], Callable[[str], Iterable[str | bytes]]]) -> DataFrame:
    """``rows`` with ``tokens``, the distinct tokens of ``__text``, and ``times``, how often each, in its place; written.
    ``tokens_of`` makes the function that cuts a text, once in each task."""
    kept = rows.drop("__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutting = tokens_of()
        for batch in batches:
            texts, start, held = batch.column("__text").to_pylist(), 0, 0
            others = batch.drop_columns("__text")
            for end, text in enumerate(texts, 1):
                held += len(text or "")
                if held > CHUNK or end == len(texts):
                    yield counted(others.slice(start, end - start), texts[start:end], cutting)
                    start, held = end, 0

    def counted(others: pa.RecordBatch, texts: list[str | None], cutting: Callable) -> pa.RecordBatch:
        tokens: list = []
        times: list[int] = []
        ends = [0]
        for text in texts:
            met = Counter(cutting(text)) if text else {}
            tokens += met.keys()
            times += met.values()
            ends.append(len(tokens))
        ends = pa.array(ends, pa.int32())
        told = pa.array(tokens, pa.binary() if tokens and isinstance(tokens[0], bytes) else pa.string()).cast(pa.string())
        return pa.RecordBatch.from_arrays([*others.columns, pa.ListArray.from_arrays(ends, told),
                                           pa.ListArray.from_arrays(ends, pa.array(times, pa.int32()))],
                                          [*others.schema.names, "tokens", "times"])

    made = StructType([*kept.schema.fields, StructField("tokens", ArrayType(StringType())),
                       StructField("times", ArrayType(IntegerType()))])
    return written(rows.mapInArrow(run, made), compression="zstd")


def each(parts: DataFrame, *names: str) -> DataFrame:
    """(names, token, times): the cut rows' tokens one by one."""
    return parts.select(*names, F.inline(F.arrays_zip("tokens", "times"))).withColumnRenamed("tokens", "token")


def sums(parts: DataFrame, values: DataFrame, names: list[str], most: int = HEAD) -> DataFrame:
    """(__row, names): each name of ``values`` (token, freq, names) summed over the tokens of a row of ``parts`` (__row,
    tokens, times), each as often as it occurs; rows without tokens are left out."""
    keyed = values.select(join_key(F.col("token")).alias("key"), "freq", *names)
    in_head = F.col("freq") >= head_frequency(values, most)
    known = F.broadcast(keyed.where(in_head).select("key", F.lit(True).alias("__head"), *names))
    met = each(parts, "__row").select("__row", "times", join_key(F.col("token")).alias("key"))
    looked = met.join(known, "key", "left")
    uses = [F.sum(F.col(n) * F.col("times")).alias(n) for n in names]
    common = looked.where(F.col("__head").isNotNull()).groupBy("__row").agg(*uses)
    rare = looked.where(F.col("__head").isNull()).select("__row", "times", "key").join(
        keyed.where(~in_head).drop("freq").hint("shuffle_hash"), "key")
    both = common.unionByName(rare.groupBy("__row").agg(*uses))
    return both.groupBy("__row").agg(*[F.sum(n).alias(n) for n in names])
