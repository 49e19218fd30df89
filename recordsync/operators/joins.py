"""Join operators.

Per-row lookups of the source system (one SQL/HTTP call per row) become one
join over the whole batch.  Keys are normalised into a column first so the
join stays an equi-join (hash/sort-merge, never a nested loop).  Side tables
are not hinted for broadcast: Catalyst broadcasts them when their estimated
size is under ``spark.sql.autoBroadcastJoinThreshold`` (a checked bound) and
AQE re-plans from the real shuffle sizes; above it the join is sort-merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import taxid_key


def semi_restrict(df: DataFrame, key: str, allowed: DataFrame, allowed_key: str) -> DataFrame:
    """Rows whose key is ``IN (SELECT allowed_key FROM allowed)``."""
    a = allowed.select(F.col(allowed_key).alias("_k"))
    return df.join(a, F.col(key) == F.col("_k"), "left_semi")


def exclude(df: DataFrame, key: str, excluded: DataFrame, excluded_key: str) -> DataFrame:
    """Left-anti join with an exclusion list (NOT IN without the
    NULL trap: a NULL in the list does not empty the result)."""
    x = excluded.select(F.col(excluded_key).alias("_x")).where(F.col("_x").isNotNull())
    return df.join(x, F.col(key) == F.col("_x"), "left_anti")


def domain_or_default(df: DataFrame, col: str, domain: DataFrame, domain_col: str, default, out: str | None = None) -> DataFrame:
    """Keep the value when it belongs to the domain, else ``default``."""
    d = domain.select(F.col(domain_col).alias("_d")).distinct()
    j = df.join(d, F.col(col) == F.col("_d"), "left")
    return j.withColumn(out or col, F.when(F.col("_d").isNotNull(), F.col(col)).otherwise(F.lit(default))).drop("_d")


def taxid_join(df: DataFrame, taxid_col: str, ref: DataFrame, ref_taxid: str, how: str = "inner") -> DataFrame:
    """Join on ``ltrim(lpad(taxid, 14, '0'))`` computed once per side."""
    return (df.withColumn("_tk", taxid_key(F.col(taxid_col)))
            .join(ref.withColumn("_tk", taxid_key(F.col(ref_taxid))), "_tk", how).drop("_tk"))


def or_match(changes: DataFrame, target: DataFrame, change_keys: tuple[str, str], target_keys: tuple[str, str],
             change_id: str, target_id: str) -> DataFrame:
    """For each target row, the change that applies to it when a change
    matches on ``lower(email)`` OR on the CRM id (the highest change id wins).

    No nested loop and no pair explosion: changes are first reduced to one
    per e-mail (the winner) and one per id, so each equi-join emits at most
    one row per target row, even when one address holds a third of all rows.
    """
    ce, cid = change_keys
    te, tid = target_keys
    c = changes.select(F.col(change_id).alias("_win"), F.lower(F.col(ce)).alias("_em"), F.col(cid).alias("_k"))
    by_em_c = c.where(F.col("_em").isNotNull()).groupBy("_em").agg(F.max("_win").alias("_win"))
    by_id_c = c.where(F.col("_k").isNotNull()).groupBy("_k").agg(F.max("_win").alias("_win"))
    t = target.select(F.col(target_id).alias("_tid"), F.lower(F.col(te)).alias("_em"), F.col(tid).alias("_k"))
    by_em = t.join(by_em_c, "_em").select("_tid", "_win", F.lit(True).alias("_e"), F.lit(False).alias("_i"))
    by_id = t.join(by_id_c, "_k").select("_tid", "_win", F.lit(False).alias("_e"), F.lit(True).alias("_i"))
    u = by_em.unionByName(by_id)
    return (u.groupBy("_tid").agg(F.max("_win").alias(change_id), F.max("_e").alias("by_email"),
                                  F.max("_i").alias("by_id"))
            .withColumnRenamed("_tid", target_id))


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Deterministic first row per key (smallest ``order``), as a
    ``min_by`` aggregate: partial aggregation keeps one candidate per key and
    task, so a key with a third of all rows is never sorted in one task."""
    others = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def last_per_key(df: DataFrame, keys: list[str], by: str, tie: str | None = None) -> DataFrame:
    """Latest row per key by ``by`` (then ``tie``), as one aggregate.

    ``max_by`` over a struct keeps the work in a partial/final hash
    aggregate, so a key holding a third of all rows is reduced map-side
    before the shuffle instead of sorting all its rows in one task.
    """
    order = F.struct(F.col(by), F.col(tie)) if tie else F.col(by)
    others = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def enrich(base: DataFrame, key: str, *sides: tuple[DataFrame, str]) -> DataFrame:
    """One left join per side table (each side must be unique on its key)."""
    out = base
    for side, side_key in sides:
        s = side.withColumnRenamed(side_key, "_ek")
        out = out.join(s, F.col(key) == F.col("_ek"), "left").drop("_ek")
    return out


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], salt_buckets: int = 16, how: str = "inner",
                salt_by: list[str] | None = None) -> DataFrame:
    """Equi-join that spreads a hot key over ``salt_buckets`` tasks.

    For when one key may hold a third of the big side and AQE cannot split
    it (no shuffle to split, e.g. bucketed inputs, or a full outer join):
    each big row gets a salt from a hash of ``salt_by`` columns (default: all
    its columns), the small side is replicated once per salt, and the join
    runs on (keys, salt).  Every big row meets exactly one copy of its
    partner, so the output equals the plain join, rows are never dropped or
    capped, and the small side grows by a fixed factor only.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins (the replicated side is the right one)")
    cols = salt_by or big.columns
    b = big.withColumn("_salt", F.pmod(F.xxhash64(*cols), F.lit(salt_buckets)))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
    return b.join(s, [*keys, "_salt"], how).drop("_salt")
