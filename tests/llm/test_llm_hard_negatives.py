"""Hard negatives against brute force, with the edge cases of the docstring."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from recordsync.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    taken = [(n, i, y, [math.floor(256 * float(np.float32(x))) for x in v]) for n, (i, v, y) in enumerate(rows)
             if None not in (i, v, y) and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, y, v in taken:
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, z) for m, j, z, w in taken if m != n)
        for s, p, _ in [c for c in scored if c[2] == y][:5]:
            fit = [c for c in scored if c[2] != y and 80 * -s <= 100 * -c[0] <= 100 * -s][:5]
            out += [(i, p, r + 1, c[1], -s, -c[0]) for r, c in enumerate(fit)]
    return sorted(out)


def mined(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit("clash")).withColumn("id", F.lit("own"))
    out = H.mine(df, F.col("id") % 100 == 0, F.col("label"))
    return sorted(tuple(r) for r in out.collect())


def table(seed, n, d, groups):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(d)] for _ in range(groups)]
    return [(i * 25, [c + rnd.gauss(0, 0.3) for c in rnd.choice(centres)], rnd.randrange(4)) for i in range(n)]


def test_mine_is_brute_force(spark, monkeypatch):
    monkeypatch.setattr(H, "BUCKET", 32)  # many buckets and groups, so that both rounds run and ranges prune
    rows = table(1, 400, 8, 6)
    rows += [rows[4], rows[4], (1001, rows[7][1], 2), (1001, rows[7][1], 3), (1001, rows[7][1], 3)]  # ties and repeats
    rows += [(None, rows[0][1], 1), (3, None, 1), (5, rows[0][1], None), (7, [1.0, None], 1), (9, [float("nan")] * 8, 1),
             (11, [float("inf")] * 8, 1), (2, [0.0] * 8, 1), (200, [0.0] * 8, 1), (13, rows[0][1][:3], 0), (300, [], 2)]
    assert mined(spark, rows) == brute(rows)


def test_large_components_stay_exact(spark):
    rows = [(100 * i, [1e6 + i, 3e5 - i, 7.0], i % 2) for i in range(12)]
    assert mined(spark, rows) == brute(rows)


def test_empty_and_lonely(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, [1.0, 2.0], 1)]) == []
    assert mined(spark, [(101, [1.0], 1), (102, [1.0], 2)]) == []


@pytest.mark.parametrize("least", [-1.0, 0.2, 0.6, 0.95, 0.999])
def test_feasible_ranges_lose_no_row(least):
    """Every row within the angle is within the ranges, and narrow ranges leave rows out."""
    rng = np.random.default_rng(3)
    x = np.floor(rng.normal(size=(500, 6)) * 256)
    x[:40] = x[0] + np.floor(rng.normal(size=(40, 6)) * 3)
    unit, _ = H._unit(x)
    data, kind = H._packed(x)
    lists = np.ascontiguousarray(np.argsort(unit, axis=0, kind="stable").T.astype("<u2")).tobytes()
    number = np.arange(500, dtype=np.int64).tobytes()
    bucket = H.Bucket(pd.Series({"n": 500, "low": 0, "high": 0, "ids": number, "rows": number, "labels": number, "vectors": data,
                                 "kind": kind, "lists": lists}))
    found = bucket.feasible(unit[5], least)
    within = set(np.flatnonzero(unit @ unit[5] >= least))
    assert found is None or within <= set(found)
    assert least < 0.9 or (found is not None and len(found) < 125)


def test_scores_are_exact():
    a, b = np.array([[2.0 ** 40, 3.0]]), np.array([[2.0 ** 20, 1.0], [1.0, 2.0 ** 30]])
    assert [int(s) for s in H.scores(a, b)[0]] == [2 ** 60 + 3, 2 ** 40 + 3 * 2 ** 30]
