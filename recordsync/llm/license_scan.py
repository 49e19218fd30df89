"""License scan by ordered signature rules (operator 13, native).

A text's words pass a keyword prefilter: only at a word that some rule names as its keyword are that rule's pattern and
the words around looked at.  A pattern that fits gives a detection: an interval of words, a label and a priority.  Of
overlapping detections, one that lies within another of the same or a better priority is suppressed (of equal intervals
the rule first in the table stays).  Everything up to the detections is row by row in the JVM, without a shuffle of
texts; only detections are sorted, text by text, to suppress.

Defined cases: a null text is empty; without words, or without detections, counts are 0, labels empty strings, places
null and the score 0.0; equal rows give equal result rows; an empty table gives no rows; a very long text is read whole,
its detections are what it adds to memory; columns with the names of new ones are replaced.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, small, without, written
from .license_rules import CONFIDENCE, REACH, rules
from .winnowing import words_of

MADE = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
#: Summaries of so many texts with detections are broadcast (some 100 bytes each); beyond, Spark shuffles.
BROADCAST_TEXTS = 200_000


def _rule_map() -> Column:
    """Keyword to its rules, a constant that Spark folds."""
    by_word: dict[str, list] = {}
    for r in rules():
        by_word.setdefault(r.keyword, []).append({"order": r.order, "pattern": r.pattern, "level": r.level, "label": r.label,
                                                  "base": r.base})
    return F.from_json(F.lit(json.dumps(by_word)),
                       "map<string, array<struct<order:int, pattern:string, level:int, label:string, base:boolean>>>")


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _around(words: Column, at: Column) -> Column:
    """' ' + the words around place ``at``, the one there marked, + ' '."""
    before = F.slice(words, F.greatest(at - REACH, F.lit(0)) + 1, F.least(at, F.lit(REACH)))
    after = F.slice(words, at + 2, F.lit(REACH))
    marked = F.array(F.concat(F.lit(">"), F.get(words, at)))
    return F.concat(F.lit(" "), F.array_join(F.concat(before, marked, after), " "), F.lit(" "))


def spans(words: Column) -> Column:
    """Detections of an array of words, unsuppressed: array of (start, end, level, order, label, base)."""
    table = _rule_map()
    keywords = sorted({r.keyword for r in rules()})

    def fits(said: Column, at: Column, rule: Column) -> Column:
        found = F.call_function("regexp_extract", said, rule["pattern"], F.lit(0))
        start = at - F.least(at, F.lit(REACH)) + _spaces(F.substring(said, F.lit(1), F.instr(said, found))) - 1
        return F.struct(start.alias("start"), (start + _spaces(found) - 1).alias("end"), rule["level"].alias("level"),
                        rule["order"].alias("order"), rule["label"].alias("label"), rule["base"].alias("base"))

    def tried(said: Column, at: Column) -> Column:
        fitting = F.filter(F.element_at(table, F.get(words, at)),
                           lambda rule: F.call_function("regexp_like", said, rule["pattern"]))
        return F.transform(fitting, lambda rule: fits(said, at, rule))

    places = F.filter(F.transform(words, lambda w, i: F.when(w.isin(keywords), i)), lambda i: i.isNotNull())
    hits = F.transform(places, lambda at: F.flatten(F.transform(F.array(_around(words, at)), lambda said: tried(said, at))))
    none = F.array().cast("array<struct<start:int,end:int,level:int,order:int,label:string,base:boolean>>")
    return F.when(F.arrays_overlap(words, F.array(*[F.lit(k) for k in keywords])), F.flatten(hits)).otherwise(none)


def suppressed(found: DataFrame, row: str = "__row") -> DataFrame:
    """``found`` (row, start, end, level, order, ...) with ``kept``: whether no detection suppresses it."""
    before = Window.partitionBy(row).orderBy("start", F.desc("end"), "level", "order").rowsBetween(
        Window.unboundedPreceding, -1)
    levels = range(len(CONFIDENCE))
    reach = [F.max(F.when(F.col("level") <= level, F.col("end"))).over(before).alias(f"__reach{level}") for level in levels]
    hidden = reduce(lambda rest, level: F.when(F.col("level") == level, F.col(f"__reach{level}") >= F.col("end")).otherwise(rest),
                    levels, F.lit(False))
    seen = found.select("*", *reach).withColumn("kept", ~F.coalesce(hidden, F.lit(False)))
    return seen.drop(*[f"__reach{level}" for level in levels])


def detected(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without their texts, a number ``__row``, n_words and ``__spans`` (see spans()); written out once."""
    rest = without(docs, text, *MADE)
    cols = [F.col(f"`{c}`") for c in rest.columns]
    worded = docs.select(*cols, words_of(F.col(f"`{text}`")).alias("__words"))
    return written(worded.select(*cols, F.monotonically_increasing_id().alias("__row"),
                                 F.size("__words").cast("long").alias("n_words"), spans(F.col("__words")).alias("__spans")))


def detections(rows: DataFrame) -> DataFrame:
    """Of detected() rows: (__row, start, end, level, order, label, base, confidence, kept), one per detection."""
    sure = F.element_at(F.array(*[F.lit(c) for c in CONFIDENCE]), F.col("level") + 1)
    return suppressed(rows.select("__row", F.inline("__spans"))).withColumn("confidence", sure)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its columns but the text, and n_words, n_base, first_word, last_word, base_labels,
    labels and score (the surest detection that stays)."""
    rows = detected(docs, text)
    cols = [F.col(f"`{c}`") for c in rows.columns if c not in ("__row", "__spans", "n_words")]
    kept = detections(rows).where("kept").groupBy("__row").agg(
        F.collect_set("label").alias("__labels"), F.max("confidence").alias("__score"))  # at most the labels of the table
    joined = rows.join(small(kept, BROADCAST_TEXTS), "__row", "left")
    base = F.filter("__spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["start"].cast("long"))
    named = F.array_distinct(F.transform(base, lambda s: s["label"]))
    every = F.array_union(named, F.coalesce("__labels", F.array().cast("array<string>")))
    return joined.select(*cols, "n_words", F.size(base).cast("long").alias("n_base"),
                         F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                         F.array_join(F.array_sort(named), ",").alias("base_labels"),
                         F.array_join(F.array_sort(every), ",").alias("labels"),
                         F.coalesce("__score", F.lit(0.0)).alias("score"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_sql() -> str:
    told = ",\n            ".join(f"({r.order}, '{r.keyword}', '{r.pattern}', {r.level}, '{r.label}', {r.base})" for r in rules())
    sure = " ".join(f"WHEN {level} THEN {c}" for level, c in enumerate(CONFIDENCE))
    return rf"""
    WITH rules(ord, keyword, pattern, level, label, base) AS (VALUES
            {told}
    ), texts AS (
        SELECT doc_id, row_number() OVER () AS r,
               list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
        FROM documents
    ), placed AS (
        SELECT r, place, words[place + 1] AS keyword, words FROM (SELECT r, words, unnest(range(len(words))) AS place FROM texts)
        WHERE words[place + 1] IN (SELECT keyword FROM rules)
    ), hits AS (
        SELECT r, place, keyword, ' ' || array_to_string(list_concat(words[greatest(place - {REACH}, 0) + 1:place], ['>' || keyword],
            words[place + 2:place + 1 + {REACH}]), ' ') || ' ' AS said
        FROM placed
    ), fits AS (
        SELECT r, place, ord, level, label, base, said, regexp_extract(said, pattern) AS found FROM hits JOIN rules USING (keyword)
    ), spans AS (
        SELECT r, ord, level, label, base, place - least(place, {REACH})
                   + len(substr(said, 1, strpos(said, found))) - len(replace(substr(said, 1, strpos(said, found)), ' ', '')) - 1 AS s,
               len(found) - len(replace(found, ' ', '')) - 1 AS n
        FROM fits WHERE found <> ''
    ), kept AS (
        SELECT r, label, CASE level {sure} END::DOUBLE AS sure FROM spans a
        WHERE NOT EXISTS (SELECT 1 FROM spans b WHERE b.r = a.r AND b.s <= a.s AND b.s + b.n >= a.s + a.n AND b.level <= a.level
            AND (b.n > a.n OR b.level < a.level OR b.ord < a.ord))
    ), counted AS (
        SELECT r, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word FROM spans WHERE base GROUP BY r
    ), base_named AS (
        SELECT r, string_agg(label, ',' ORDER BY label) AS base_labels FROM (SELECT DISTINCT r, label FROM spans WHERE base) GROUP BY r
    ), named AS (
        SELECT r, string_agg(label, ',' ORDER BY label) AS labels
        FROM (SELECT r, label FROM kept UNION SELECT r, label FROM spans WHERE base) GROUP BY r
    ), scored AS (SELECT r, max(sure) AS score FROM kept GROUP BY r)
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
           last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
           coalesce(score, 0.0)::DOUBLE AS score
    FROM texts LEFT JOIN counted USING (r) LEFT JOIN base_named USING (r) LEFT JOIN named USING (r) LEFT JOIN scored USING (r)
"""
