"""Mixing sources to target weights by iterative proportional fitting (operator 5).

Documents fall into cells (source, language, topic).  The cells' tokens are
raked: each round scales them so that the sources meet their target shares,
then the languages, then the topics.  A cell's weight is its raked tokens over
its own.  Sampling probabilities are the weights times one factor, at most 1,
with the factor such that the expected tokens are ``rate`` of all; a document
is drawn if a uniform number made from its id is below its probability.

Targets are tables (value, share); ``tempered`` makes them from the shares of
the data to a power below 1, which lifts small groups.  Cells, margins and
factors stay in Spark; the driver sees sums and counts only.

Defined cases: null source, language or id count as the empty string; a topic
is the marker pattern with most matches, ties go to the first, none is
``prose``; a value without a target gets share 0 and is not drawn; documents
without tokens take their cell's probability; rows of one id are drawn alike in
a cell; an empty table gives no rows; columns with the names of new ones are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, without, written

DIMS = ("source", "lang", "topic")
ROUNDS = 10
#: Up to so many cells (some 100 bytes each) are raked as one partition; more are shuffled at each step.
ONE_PARTITION = 100_000
ALPHA = 0.8
RATE = 0.8
SEED = "mix-1"
#: Topics by the marks of their texts, in order of precedence.
TOPICS = {"tabular": r"\|", "symbols": r"[#$%&*]{3}", "contact": r"@[a-z]|https?://", "legal": r"[Ll]icense|[Cc]opyright"}
OTHER_TOPIC = "prose"
WORD = r"[^\x20\x09-\x0D]+"


def topic_of(counts: dict[str, Column]) -> Column:
    most = F.greatest(*counts.values()) if len(counts) > 1 else next(iter(counts.values()))
    out = F.when(most == 0, OTHER_TOPIC)
    for name, n in counts.items():
        out = out.when(n == most, name)
    return out


def described(docs: DataFrame, text: str = "text", topics: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with topic and n_tokens, both from the whole text."""
    topics = TOPICS if topics is None else topics
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    marks = [f"__mark{i}" for i in range(len(topics))]
    kept = without(docs, "topic", "n_tokens")
    counted = docs.select(*[F.col(f"`{c}`") for c in kept.columns], F.regexp_count(body, F.lit(WORD)).cast("long").alias("n_tokens"),
                          *[F.regexp_count(body, F.lit(p)).alias(m) for m, p in zip(marks, topics.values())])
    return counted.select(*[F.col(f"`{c}`") for c in kept.columns], "n_tokens",
                          topic_of({t: F.col(m) for t, m in zip(topics, marks)}).alias("topic"))


def tempered(cells: DataFrame, dim: str, alpha: float = ALPHA) -> DataFrame:
    """(dim, share): the data's token shares to the power ``alpha``, scaled to 1."""
    margin = cells.groupBy(dim).agg((F.sum("tokens").cast("double") ** alpha).alias("lifted"))
    return margin.crossJoin(F.broadcast(margin.agg(F.sum("lifted").alias("all")))).select(  # one row beside
        dim, F.when(F.col("all") > 0, F.col("lifted") / F.col("all")).otherwise(F.lit(0.0)).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (the dimensions and tokens) with ``raked``: tokens fitted to the targets' shares."""
    total, n = cells.agg(F.sum("tokens"), F.count("*")).first()
    total = total or 0

    def gathered(df: DataFrame) -> DataFrame:
        return df.coalesce(1) if n <= ONE_PARTITION else df  # one partition needs no shuffle at any step

    targets = {d: gathered(t) for d, t in targets.items()}
    now = gathered(cells).withColumn("raked", F.col("tokens").cast("double"))
    for _ in range(rounds):
        for dim, target in targets.items():
            margin = now.groupBy(dim).agg(F.sum("raked").alias("__sum"))
            factor = margin.join(target.hint("shuffle_hash"), dim, "left").select(dim, F.when(F.col("__sum") > 0, F.coalesce("share", F.lit(0.0))
                                                             * F.lit(float(total)) / F.col("__sum")).otherwise(0.0).alias("__f"))
            # Written each time: the margin and its use read one small table, and no plan holds earlier steps twice.
            now = gathered(written(now.join(factor.hint("shuffle_hash"), dim).withColumn(
                "raked", F.col("raked") * F.col("__f")).drop("__f")))
    return now


def calibrated(raked: DataFrame, rate: float = RATE) -> DataFrame:
    """``raked`` with weight and probability: weights scaled so that ``rate`` of the tokens are expected."""
    weighed = raked.withColumn("weight", F.when(F.col("tokens") > 0, F.col("raked") / F.col("tokens")).otherwise(0.0))
    wanted = rate * (raked.agg(F.sum("tokens")).first()[0] or 0)
    factor, capped = 0.0, None
    while True:  # a cell that reaches 1 stays there as the factor grows, so this ends after as many rounds as cells do
        full = F.col("weight") * F.lit(factor) >= 1
        taken, rest, n = weighed.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)),
                                     F.sum(F.when(full, 0.0).otherwise(F.col("raked"))), F.count_if(full)).first()
        if n == capped or not rest:
            break
        factor, capped = (wanted - taken) / rest, n
    return weighed.withColumn("probability", F.least(F.lit(1.0), F.col("weight") * F.lit(float(factor))))


def uniform(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the md5 of seed and id."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, rate: float = RATE, alpha: float = ALPHA,
        rounds: int = ROUNDS, doc_id: str = "doc_id") -> DataFrame:
    """``docs`` (source, lang, topic, n_tokens and others) with weight, probability and selected."""
    named = [F.coalesce(F.col(f"`{d}`"), F.lit("")).alias(d) for d in DIMS]
    cells = written(docs.select(*named, "n_tokens").groupBy(*DIMS).agg(F.sum("n_tokens").alias("tokens")))
    targets = {d: written(tempered(cells, d, alpha)) for d in DIMS} if targets is None else targets
    fitted = written(calibrated(rake(cells, targets, rounds), rate).select(
        *[F.col(d).alias(f"__{d}") for d in DIMS], F.col("weight").alias("__weight"), F.col("probability").alias("__p")))
    kept = without(docs, "weight", "probability", "selected").columns
    on = [F.coalesce(F.col(f"`{d}`"), F.lit("")) == F.col(f"__{d}") for d in DIMS]
    joined = docs.join(fitted, on[0] & on[1] & on[2])  # cells are few; Spark broadcasts them or splits hot ones
    return joined.select(*[F.col(f"`{c}`") for c in kept], F.col("__weight").alias("weight"), F.col("__p").alias("probability"),
                         (uniform(F.col(f"`{doc_id}`")) < F.col("__p")).alias("selected"))


def op5_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    return mix(written(described(docs).drop("text"))).select(
        "doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "selected")


def op5_sql(rounds: int = ROUNDS, alpha: float = ALPHA, rate: float = RATE) -> str:
    """The same by one query: every raking step a table, the factor by a running sum over the cells."""
    counts = ", ".join(f"len(regexp_extract_all(body, '{p}')) AS m{i}" for i, p in enumerate(TOPICS.values()))
    most = f"greatest({', '.join(f'm{i}' for i in range(len(TOPICS)))})"
    topic = f"CASE WHEN {most} = 0 THEN '{OTHER_TOPIC}' " + " ".join(
        f"WHEN m{i} = {most} THEN '{t}'" for i, t in enumerate(TOPICS)) + " END"
    steps, now = [], "cells"
    for i in range(rounds):
        for d in DIMS:
            steps.append(f"""r{i}_{d} AS MATERIALIZED (
                SELECT source, lang, topic, tokens,
                       CASE WHEN sum(raked) OVER w > 0 THEN raked * share * total / sum(raked) OVER w ELSE 0 END AS raked
                FROM {now} JOIN target_{d} USING ({d}), whole WINDOW w AS (PARTITION BY {d}))""")
            now = f"r{i}_{d}"
    target = ", ".join(f"""target_{d} AS MATERIALIZED (
        SELECT {d}, CASE WHEN sum(lifted) OVER () > 0 THEN lifted / sum(lifted) OVER () ELSE 0 END AS share
        FROM (SELECT {d}, pow(sum(tokens)::DOUBLE, {alpha}) AS lifted FROM cells GROUP BY {d}))""" for d in DIMS)
    return f"""
        WITH counted AS (
            SELECT doc_id, source, lang, coalesce(source, '') AS s, coalesce(lang, '') AS l, coalesce(text, '') AS body FROM documents
        ), marked AS (
            SELECT *, len(regexp_extract_all(body, '{WORD}'))::BIGINT AS n_tokens, {counts} FROM counted
        ), docs AS MATERIALIZED (
            SELECT doc_id, source, lang, s, l, n_tokens, {topic} AS topic FROM marked
        ), cells AS MATERIALIZED (
            SELECT s AS source, l AS lang, topic, sum(n_tokens)::DOUBLE AS tokens, sum(n_tokens)::DOUBLE AS raked
            FROM docs GROUP BY ALL
        ), whole AS (SELECT sum(tokens) AS total FROM cells), {target}, {", ".join(steps)},
        weighed AS (
            SELECT source, lang, topic, tokens, raked, CASE WHEN tokens > 0 THEN raked / tokens ELSE 0 END AS weight FROM {now}
        ), ranked AS (
            SELECT *, sum(tokens) OVER w - tokens AS above, sum(raked) OVER () - (sum(raked) OVER w - raked) AS rest
            FROM weighed WINDOW w AS (ORDER BY weight DESC, source, lang, topic ROWS UNBOUNDED PRECEDING)
        ), factors AS (
            -- The first cell, by falling weight, that the factor of the cells from it on leaves below 1.
            SELECT min_by(({rate} * total - above) / rest, above) AS factor
            FROM ranked, whole WHERE rest > 0 AND weight * ({rate} * total - above) / rest < 1
        ), fitted AS (
            SELECT source AS s, lang AS l, topic, weight, least(1.0, weight * coalesce(factor, 0)) AS probability
            FROM weighed, factors
        )
        SELECT doc_id, source, lang, topic, n_tokens, weight, probability,
               ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / pow(2, 52) < probability AS selected
        FROM docs JOIN fitted USING (s, l, topic)
    """
