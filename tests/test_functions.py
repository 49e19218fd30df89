from pyspark.sql import functions as F

from recordsync import functions as X
from recordsync.schemas import STAGES_CANONICAL


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(expr(F.col("x")).alias("y")).first()["y"]


def test_initcap_words_starts_after_any_separator(spark):
    assert one(spark, X.initcap_words, "SAO-PAULO do sul") == "Sao-Paulo Do Sul"
    assert one(spark, X.initcap_words, "d'ÁGUA") == "D'Água"
    assert one(spark, X.initcap_words, None) is None


def test_taxid_padding_and_cut(spark):
    assert one(spark, X.pad_taxid, "123") == "00000000000123"
    assert one(spark, X.pad_taxid, "123456789012345") == "12345678901234"  # lpad cuts
    assert one(spark, X.taxid_too_long, "123456789012345") is True
    assert one(spark, X.pad_taxid, None) is None
    assert one(spark, X.zfill, "123456789012345") == "123456789012345"  # zfill never cuts
    assert one(spark, X.zfill, "42") == "00000000000042"


def test_accents_and_keys(spark):
    assert one(spark, X.remove_accents, "São Paulo, Ação") == "Sao Paulo, Acao"
    assert one(spark, X.normalize_key, "straße") == "STRASSE"
    assert one(spark, X.normalize_key, "Ñandú") == "NANDU"


def test_oracle_concat_null_as_empty(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    assert df.select(X.oracle_concat("a", F.lit("-"), "b")).first()[0] == "a-"
    assert df.select(F.concat("a", F.lit("-"), "b")).first()[0] is None  # Spark's own || gives NULL


def test_decode_is_null_safe(spark):
    df = spark.createDataFrame([(None,), ("US",), ("BR",)], "c string")
    got = [r[0] for r in df.select(X.decode_eq("c", "US", F.lit("y"), F.lit("n"))).collect()]
    assert got == ["n", "y", "n"]


def test_house_number(spark):
    for raw, want in [("12", 12), ("SN", 0), ("12a", 0), (None, 0)]:
        assert one(spark, X.house_number, raw) == want
    assert one(spark, X.house_number_out, None, "int") == "SN"


def test_registration_codes(spark):
    for raw, erp in [("ISENTO", "99"), ("isento", "99"), ("99", "99"), ("0", "99"), (None, "99"),
                     ("1.234-5", "12345")]:
        assert one(spark, X.registration_to_erp, raw) == erp
    assert one(spark, X.registration_to_crm, "99") == "ISENTO"
    assert one(spark, X.registration_to_crm, "12345") == "12345"


def test_flags(spark):
    assert one(spark, X.flag_to_sn, "true") == "S"
    assert one(spark, X.flag_to_sn, "false") == "N"
    assert one(spark, X.flag_to_sn, "maybe") is None
    assert one(spark, X.sn_to_bool, "S") is True
    assert one(spark, X.sn_to_bool, "N") is False


def test_text_helpers(spark):
    assert one(spark, X.strip_punct, "12.345-678") == "12345678"
    assert one(spark, X.slug, "ACME Ltda. / Sul, SP") == "ACME_Ltda__Sul_SP"
    assert one(spark, X.street_token, "Rua A - fundos, 12") == "Rua A"
    assert one(spark, X.first_token, "  Rua   das Flores") == "Rua"
    assert one(spark, X.int_part, "123.0") == "123"
    assert one(spark, lambda c: X.truncate(c, 3), "abcdef") == "abc"


def test_stage_ordinal_nbsp_unknown_null(spark):
    def o(v):
        return one(spark, lambda c: X.stage_ordinal(c, STAGES_CANONICAL), v)
    assert o(STAGES_CANONICAL[5]) == 6
    assert o("Novos\u00a0leads") == 2  # non-breaking space from the CRM
    assert o("Unknown") == 0
    assert o(None) is None


def test_price_fallback(spark):
    df = spark.createDataFrame([(None, 5.0), (0.0, 5.0), (3.0, 5.0)], "n double, p double")
    assert [r[0] for r in df.select(X.price_fallback("n", "p")).collect()] == [5.0, 5.0, 3.0]


def test_custom_field_lookup(spark):
    df = spark.createDataFrame([([("a", "1"), ("b", "2"), ("a", "3")],), ([],), (None,)],
                               "cf array<struct<id:string,value:string>>")
    got = [r[0] for r in df.select(X.custom_field("cf", "a")).collect()]
    assert got == ["3", None, None]  # last one wins; absent -> NULL, no ANSI error
    got = [r[0] for r in df.select(X.custom_field("cf", "zz")).collect()]
    assert got == [None, None, None]
    m = df.select(X.custom_fields_to_map("cf").alias("m")).first()["m"]
    assert m == {"a": "3", "b": "2"}


def test_append_custom_field(spark):
    df = spark.createDataFrame([([("a", "1")],), (None,)], "cf array<struct<id:string,value:string>>")
    got = [len(r[0]) for r in df.select(X.append_custom_field("cf", "_x", "v")).collect()]
    assert got == [2, 1]


def test_json_key_presence(spark):
    df = spark.createDataFrame([('{"Lead":{"Id":1,"Phone":null}}',), ('{"Lead":{"Id":1}}',)], "raw string")
    got = [r[0] for r in df.select(X.json_key_present("raw", "$.Lead", "Phone")).collect()]
    assert got == [True, False]


def test_main_contact_flag(spark):
    df = spark.createDataFrame([([(1, "true"), (2, "false")],)], "c array<struct<id:int,mainContact:string>>")
    got = df.select(X.main_contact_flag("c", 1).alias("a"), X.main_contact_flag("c", 2).alias("b"),
                    X.main_contact_flag("c", 3).alias("c")).first()
    assert (got.a, got.b, got.c) == ("S", "N", "N")
