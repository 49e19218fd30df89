"""Property tests (hypothesis) for the merge and fingerprint operators."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from recordsync.operators import fingerprint as FP
from recordsync.operators import merge as M

SCHEMA = "id bigint, a string, b bigint"
vals = st.one_of(st.none(), st.sampled_from(["x", "y", "ñ", ""]))
nums = st.one_of(st.none(), st.integers(-3, 3))
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@st.composite
def tables(draw):
    keys = draw(st.lists(st.integers(0, 30), min_size=1, max_size=12, unique=True))
    src = [(k, draw(vals), draw(nums)) for k in keys]
    tgt_keys = draw(st.lists(st.sampled_from(keys), unique=True))
    tgt = [(k, draw(vals), draw(nums)) for k in tgt_keys]
    return src, tgt


@SETTINGS
@given(tables())
def test_apply_diff_gives_source_and_is_idempotent(spark, data):
    src_rows, tgt_rows = data
    src = spark.createDataFrame(src_rows, SCHEMA)
    tgt = spark.createDataFrame(tgt_rows, SCHEMA)
    diff = src.subtract(tgt)
    once = M.merge_snapshot(tgt, diff, ["id"])
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(map(tuple, src.collect()), key=repr)
    twice = M.merge_snapshot(once, diff, ["id"])
    assert sorted(map(tuple, twice.collect()), key=repr) == sorted(map(tuple, once.collect()), key=repr)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 50), vals, nums), max_size=25), st.randoms())
def test_fingerprint_is_order_and_partition_free(spark, rows, rnd):
    shuffled = list(rows)
    rnd.shuffle(shuffled)
    a = FP.dataset_fingerprint(spark.createDataFrame(rows, SCHEMA).coalesce(1)).first()
    b = FP.dataset_fingerprint(spark.createDataFrame(shuffled, SCHEMA).repartition(5)).first()
    assert (a.rows, a.digest) == (b.rows, b.digest) == (len(rows), a.digest)
