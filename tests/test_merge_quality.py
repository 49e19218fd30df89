from pyspark.sql import functions as F

from recordsync.operators import merge as M
from recordsync.operators import quality as Q
from recordsync.functions.nested import json_key_present

T_SCHEMA = "id bigint, name string, phone string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_snapshot_upsert_delete_idempotent(spark):
    t = spark.createDataFrame([(1, "a", "p1"), (2, "b", "p2"), (3, "c", None)], T_SCHEMA)
    ch = spark.createDataFrame([(2, "B", None, False), (4, "d", "p4", False), (3, None, None, True)],
                               "id bigint, name string, phone string, deleted boolean")
    out = M.merge_snapshot(t, ch, ["id"], ["name"], delete_col="deleted")
    assert rows(out) == [(1, "a", "p1"), (2, "B", "p2"), (4, "d", "p4")]
    again = M.merge_snapshot(out, ch.where("NOT deleted"), ["id"], ["name"])
    assert rows(again) == rows(out)


def test_merge_apply_diff_gives_source(spark):
    src = spark.createDataFrame([(1, "a", "x"), (2, "B", "y"), (5, "e", None)], T_SCHEMA)
    tgt = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], T_SCHEMA)
    diff = src.subtract(tgt)
    assert rows(M.merge_snapshot(tgt, diff, ["id"])) == rows(src)


def test_partial_update_absent_vs_null_and_per_field_latest(spark):
    t = spark.createDataFrame([(1, "old", "111"), (2, "keep", "222")], T_SCHEMA)
    docs = spark.createDataFrame([
        (1, 1, '{"Lead":{"Company":"first","Phone":"999"}}'),
        (1, 2, '{"Lead":{"Phone":null}}'),            # present and null -> sets NULL
        (2, 1, '{"Lead":{}}'),                        # nothing present -> unchanged
    ], "id bigint, ord int, raw string")
    raw = F.col("raw")
    fields = {"name": (F.get_json_object(raw, "$.Lead.Company"), json_key_present(raw, "$.Lead", "Company")),
              "phone": (F.get_json_object(raw, "$.Lead.Phone"), json_key_present(raw, "$.Lead", "Phone"))}
    out = M.partial_update(t, docs, "id", fields, "ord")
    # name comes from the latest doc that has it (ord 1), phone from ord 2 (null)
    assert rows(out) == [(1, "first", None), (2, "keep", "222")]


def test_contact_route_counts(spark):
    target = spark.createDataFrame([("A@x.org",), ("a@X.org",), ("b@x.org",)], "email string")
    inc = spark.createDataFrame([(1, "a@x.org"), (2, "B@x.org"), (3, "c@x.org"), (4, None)], "id bigint, email string")
    got = {r.id: r.action for r in M.contact_route(inc, target).collect()}
    assert got == {1: "ambiguous", 2: "update", 3: "insert", 4: "reject_no_email"}


def test_contact_merge_cases(spark):
    tgt = spark.createDataFrame([
        (10, "Ann", "ann@x.org", "1", "T", 1, "S", 100),
        (11, "Bob", "bob@x.org", "2", "T", 1, "N", 101),
        (12, "Cid", "cid@x.org", "3", "T", 2, "N", None),
    ], "code bigint, name string, email string, phone string, job_title_desc string, branch_client bigint, "
       "is_primary string, id_crm bigint")
    ch = spark.createDataFrame([
        (1, "Ann B", "ANN@x.org", "9", "boss", "S", 100, "A"),    # update by e-mail (case-insensitive)
        (1, "Del", "zzz@x.org", None, None, "N", 101, "D"),       # delete by CRM id
        (2, "New", "new@x.org", "7", "dev", "N", 200, "A"),       # insert
        (None, "NoClient", "nc@x.org", None, None, "N", 300, "A"),  # no client -> no-op
        (2, "Dup", "dup@x.org", None, None, "N", 100, "A"),       # CRM id exists -> ignored insert
    ], "client bigint, name string, email string, phone string, job_title string, is_primary string, "
       "id_crm bigint, op string")
    out = {r.code: r for r in M.contact_merge(tgt, ch).collect()}
    assert 11 not in out
    assert out[10].name == "Ann B" and out[10].job_title_desc == "BOSS" and out[10].phone == "9"
    assert out[12].name == "Cid"
    new = [r for r in out.values() if r.id_crm == 200]
    assert len(new) == 1 and new[0].code == 13 and new[0].email == "new@x.org"
    assert not [r for r in out.values() if r.id_crm == 300]


def test_contact_merge_arrival_order(spark):
    """Delete then add, add then delete, adds without an e-mail, and updates of what the batch inserted."""
    schema = ("code bigint, name string, email string, phone string, job_title_desc string, branch_client bigint, "
              "is_primary string, id_crm bigint")
    tgt = spark.createDataFrame([(1, "Ann", "a@x.org", "1", "T", 5, "S", 100), (2, "Bob", "b@x.org", "2", "T", 5, "N", None)], schema)
    ch = spark.createDataFrame([
        (5, "gone", "A@x.org", None, None, "N", 201, "D"), (6, "Ann 2", "a@x.org", "9", "dev", "S", 202, "A"),
        (6, "Bob 2", "b@x.org", "8", "dev", "S", 203, "A"), (6, "gone", "b@x.org", None, None, "N", 204, "D"),
        (7, "None", None, "3", "dev", "N", 205, "A"), (8, "New", "n@x.org", "4", "dev", "N", 206, "A"),
        (9, "New 2", "N@x.org", "5", "ops", "S", 207, "A")],
        "client bigint, name string, email string, phone string, job_title string, is_primary string, id_crm bigint, op string")
    out = sorted(tuple(r)[1:] for r in M.contact_merge(tgt, ch).collect())
    assert out == [("Ann 2", "a@x.org", "9", "dev", 6, "S", 202), ("New 2", "n@x.org", "5", "OPS", 8, "S", 207),
                   ("None", None, "3", "dev", 7, "N", 205)]


def test_write_back_by_key(spark):
    t = spark.createDataFrame([(1, "a@x.org", None), (2, "B@x.org", 5)], "code bigint, email string, id_crm bigint")
    pairs = spark.createDataFrame([("b@x.org", 7), ("b@x.org", 9)], "email string, id_crm bigint")
    out = M.write_back(t, pairs, F.lower(F.col("email")), "email", {"id_crm": F.col("_p_id_crm")})
    assert rows(out) == [(1, "a@x.org", None), (2, "B@x.org", 9)]


def test_assign_ids_contiguous_across_partitions(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(7)
    ids = sorted((r.k, r.new_id) for r in Q.assign_ids(df, 41, ["k"], "new_id").collect())
    assert [i for _, i in ids] == list(range(42, 1042))
    assert [k for k, _ in ids] == sorted(k for k, _ in ids)


def test_assign_ids_keeps_every_row(spark):
    """Wide rows over many partitions, with columns that one use of the numbered frame doesn't need."""
    n = 300_000
    wide = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), *[F.sha2(F.concat(F.col("id").cast("string"), F.lit(c)), 256).alias(c)
                                                                       for c in "abcd"]).repartition(40)
    got = Q.assign_ids(wide, 0, ["k"], "new_id").agg(
        F.count("*"), F.countDistinct("new_id"), F.min("new_id"), F.max("new_id"), F.max(F.abs(F.col("new_id") - F.col("k") - 1))).first()
    assert tuple(got) == (n, n, 1, n, 0)


def test_next_sequence(spark):
    hist = spark.createDataFrame([(1, 3), (1, 5), (2, 1)], "client bigint, sequence bigint")
    new = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c")], "client bigint, obs string")
    got = rows(M.next_sequence(hist, new, "client", "sequence", "obs"))
    assert got == [(1, "a", 6), (1, "b", 7), (3, "c", 1)]


def test_insert_ignore(spark):
    t = spark.createDataFrame([(1,), (2,)], "k bigint")
    r = spark.createDataFrame([(2, "x"), (3, "y"), (3, "z")], "k bigint, v string")
    out = M.insert_ignore(t, r, ["k"]).collect()
    assert [x.k for x in out] == [3]


def test_validate_falsy_and_log(spark):
    df = spark.createDataFrame([(1, "A", "", "S1"), (0, None, "x", "S1"), (2, None, None, "other")],
                               "id bigint, lead string, cep string, stage string")
    v = Q.validate(df, ["id", "lead", "cep"], applies=F.col("stage") == "S1")
    got = {r.id: r.failed_fields for r in v.collect()}
    assert got == {1: ["cep"], 0: ["id", "lead"], 2: []}
    log = Q.missing_field_log(v).collect()
    assert sorted((r.lead_id, r.field) for r in log) == [("0", "id"), ("1", "cep")]
    ok, rej = Q.split_valid(v)
    assert ok.count() == 1 and rej.count() == 2


def test_key_violations(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a int, b int")
    assert [tuple(r) for r in Q.key_violations(df, ["a", "b"]).collect()] == [(1, 1, 2)]


def test_stage_regression(spark):
    from recordsync.schemas import STAGES_ALIAS, STAGES_CANONICAL
    alias_of = dict(zip(STAGES_ALIAS, STAGES_CANONICAL))
    leads = spark.createDataFrame([(1, "11", "Activation"), (2, "22", "Activation"), (3, "33", "Handoff"),
                                   (4, "44", "Handoff")], "id bigint, taxid string, stage string")
    # looked up by tax id (zero-padded on the CRM side), not by id
    crm = spark.createDataFrame([(9, "00000000000011", STAGES_CANONICAL[6]), (8, "00000000000022", "Novos\u00a0leads"),
                                 (7, "00000000000033", "???")], "id bigint, cnpj string, stage string")
    got = {r.id: r.reason for r in M.stage_regression(leads, crm, STAGES_CANONICAL, alias_of).collect()}
    assert got == {2: "stage_regressed", 3: "unknown_stage", 4: "missing_in_crm"}


def test_next_sequence_hot_key_spread(spark):
    """A key holding most of the new rows is numbered across partitions."""
    hist = spark.createDataFrame([(1, 10)], "client bigint, sequence bigint")
    new = spark.range(0, 3000).select(F.when(F.col("id") % 10 < 8, F.lit(1)).otherwise(F.col("id") % 5)
                                      .cast("bigint").alias("client"), F.col("id").alias("obs"))
    out = M.next_sequence(hist, new, "client", "sequence", "obs").collect()
    by = {}
    for r in out:
        by.setdefault(r.client, []).append((r.obs, r.sequence))
    hot = sorted(by[1])
    assert [s for _, s in hot] == list(range(11, 11 + len(hot)))
    for k, v in by.items():
        if k != 1:
            assert [s for _, s in sorted(v)] == list(range(1, len(v) + 1))


def test_or_match_linear_and_winner(spark):
    from recordsync.operators.joins import or_match
    tgt = spark.createDataFrame([(1, "A@x.org", None), (2, "a@x.org", 7), (3, "z@x.org", 9), (4, None, None)],
                                "code bigint, email string, id_crm bigint")
    ch = spark.createDataFrame([(5, "a@X.org"), (6, "a@x.org"), (9, "q@x.org")], "id_crm bigint, email string")
    got = {r.code: (r.id_crm, r.by_email, r.by_id)
           for r in or_match(ch, tgt, ("email", "id_crm"), ("email", "id_crm"), "id_crm", "code").collect()}
    assert got == {1: (6, True, False), 2: (6, True, False), 3: (9, False, True)}


def test_first_per_key_aggregate(spark):
    from recordsync.operators.joins import first_per_key
    df = spark.createDataFrame([(1, 5, "e"), (1, 3, "c"), (2, 9, "x"), (1, 4, "d")], "k int, o int, v string")
    assert sorted(tuple(r) for r in first_per_key(df, ["k"], ["o"]).collect()) == [(1, 3, "c"), (2, 9, "x")]


def test_webhook_fields_first_custom_field_and_shaping(spark):
    from recordsync.sources.webhook import is_synced, lead_update_fields
    raw = ('{"Lead":{"Id":1,"Company":"' + "A" * 50 + '","Address":{"ZipCode":"12.345-678"},'
           '"CustomFields":[{"id":"_cod.gestores","value":"7"},{"id":"_cod.gestores","value":"8"},'
           '{"id":"_inscricaoestadual","value":""}],"Stage":"Ativação"}}')
    df = spark.createDataFrame([(raw,), ('{"Lead":{"Id":2,"Stage":"Novos leads"}}',)], "raw string")
    f = lead_update_fields(F.col("raw"))
    r = df.select(*[v.alias(f"v_{c}") for c, (v, p) in f.items()], *[p.alias(f"p_{c}") for c, (v, p) in f.items()],
                  is_synced(F.col("raw")).alias("synced")).collect()
    a, b = r
    assert a.v_name == "A" * 40 and a.v_address_zipcode == "12345678" and a.v_stage == "Activation"
    assert a.v_sales_rep == 7 and a.p_sales_rep  # first entry wins
    assert not a.p_tax_registration  # empty custom value is not applied
    assert not a.p_city and a.p_address_zipcode and not a.p_phone
    assert a.synced and not b.synced


def test_salted_join_equals_plain_join_on_hot_key(spark):
    from recordsync.operators.joins import salted_join
    big = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50)
                                      .alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([(7, "hot"), (1, "one"), (99, "none")], "k long, name string")
    plain = sorted(map(tuple, big.join(small, "k", "left").collect()), key=repr)
    salted = sorted(map(tuple, salted_join(big, small, ["k"], 8, "left").select("k", "v", "name").collect()), key=repr)
    assert salted == plain


def test_field_diff_null_semantics(spark):
    from recordsync.operators.changes import field_diff
    src = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "c", "y"), (4, "d", "z")], "id bigint, n string, v string")
    tgt = spark.createDataFrame([(1, "a", "old"), (2, "B", "x"), (3, "c", "y")], "id bigint, n string, v string")
    plain = {r.id: r.changed for r in field_diff(src, tgt, "id", ["n", "v"]).collect()}
    assert plain == {2: "n", 4: ""}  # NULL vs value is no change (Q9); 4 is missing in the target
    safe = {r.id: r.changed for r in field_diff(src, tgt, "id", ["n", "v"], null_safe=True).collect()}
    assert safe == {1: "v", 2: "n", 4: "n,v"}
