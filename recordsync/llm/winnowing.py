"""Benchmark decontamination by winnowing (operator 2, native).

A text's fingerprints are the smallest hash of every window of ``window``
consecutive ``k``-grams of words.  Two texts that share ``k + window - 1``
words in a row share a full window, so they pick the same k-gram of it: with
``k + window - 1 <= span`` no shared span of ``span`` words is missed.  The
fingerprints of documents and benchmark are joined; each meeting gives a
diagonal (document position less item position) on which the item is compared
with the document word by word, which finds the hits' full extent and drops
meetings by chance.  Items shorter than ``span`` words are one window of their
own length, found by the hash of the whole item at every position.

Defined cases: null or wordless texts have no words, no windows and no hits;
a null item_id counts as the empty string; items of equal id count once;
equal document rows give equal result rows; an empty benchmark marks nothing;
an item of many words has a fingerprint for some words of it, each of a fixed
size, so work and memory grow with its length, not with its square.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, read, row_key, written

SPAN = 10
K = 5
#: The benchmark is broadcast up to so many fingerprints (16 bytes each); beyond, Spark shuffles for the join.
BROADCAST_FINGERPRINTS = 500_000
#: A fingerprint packs a hash of 36 bits over a word position of 28; a text of 2**28 words is beyond a row's 2 GB.
POSITION_BITS = 28
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def _packed(hashed: Column, position: Column) -> Column:
    kept = hashed.bitwiseAND(F.lit((1 << (64 - POSITION_BITS)) - 1))
    return F.shiftleft(kept, POSITION_BITS).bitwiseOR(position.cast("long"))


def _grams(hashes: Column, length: int) -> Column:
    """Packed hash of the ``length`` words from each position on; null where the text ends before."""
    def gram(h: Column, i: Column) -> Column:
        rest = [F.get(hashes, i + j) for j in range(1, length)]
        last = rest[-1] if rest else h
        return F.when(last.isNotNull(), _packed(F.xxhash64(F.lit(length), h, *rest), i))
    return F.transform(hashes, gram)


def _least_of_windows(grams: Column, window: int) -> Column:
    """The least packed gram of every full window, each once."""
    def least(g: Column, i: Column) -> Column:
        rest = [F.get(grams, i + j) for j in range(1, window)]
        return F.when((rest[-1] if rest else g).isNotNull(), F.least(g, *rest))
    return F.array_distinct(F.transform(grams, least))


def fingerprints(df: DataFrame, names: list[str], k: int, window: int, short: list[int]) -> DataFrame:
    """(names, hash, pos): winnowed fingerprints of the text and, for each length of ``short``,
    the hash of every run of that many words.  ``df`` has the column ``words``."""
    hashed = df.select(*names, F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    grams = hashed.select(*names, "hashes", _grams(F.col("hashes"), k).alias("grams"))
    kinds = [_least_of_windows(F.col("grams"), window)] + [_grams(F.col("hashes"), m) for m in short]
    packed = grams.select(*names, F.explode(F.concat(*kinds) if short else kinds[0]).alias("packed"))
    return packed.where(F.col("packed").isNotNull()).select(
        *names, F.shiftrightunsigned("packed", POSITION_BITS).alias("hash"),
        F.col("packed").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).cast("int").alias("pos"))


def hits(docs: DataFrame, bench: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """(k1, k2, item, first, last): every occurrence of a window of the benchmark in a document.

    docs: k1, k2, text; bench: item, text.
    """
    window = span - k + 1
    items = written(bench.select("item", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
                    .withColumn("n", F.size("words")).distinct())
    lengths = sorted(r.n for r in items.where(F.col("n") < span).select("n").distinct().collect())  # below span
    # A fingerprint's row carries 128 bits that name the item's words, not the words: they'd be as long again for each.
    named = items.select("*", *row_key(F.to_json("words"))).withColumnsRenamed({"k1": "w1", "k2": "w2"})
    names = ["item", "w1", "w2"]
    prints = fingerprints(named.where(F.col("n") >= span), names, k, window, [])
    for m in lengths:
        whole = named.where(F.col("n") == m).select(*names, F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
        prints = prints.unionByName(whole.select(*names, F.get(_grams(F.col("hashes"), m), F.lit(0)).alias("packed")).select(
            *names, F.shiftrightunsigned("packed", POSITION_BITS).alias("hash"), F.lit(0).alias("pos")))
    prints = written(prints)
    bounded = prints.count() <= BROADCAST_FINGERPRINTS
    wanted = prints.select("hash", F.col("pos").alias("item_pos"), *names)
    wanted = F.broadcast(wanted) if bounded else wanted
    found = fingerprints(docs.select("k1", "k2", words_of(F.col("text")).alias("words")), ["k1", "k2"], k, window,
                         lengths).join(wanted, "hash")
    diagonals = found.select("k1", "k2", *names, (F.col("pos") - F.col("item_pos")).alias("shift"))
    diagonals = written(diagonals.distinct())

    met = docs.join(diagonals.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    texts = met.select("k1", "k2", words_of(F.col("text")).alias("doc_words"))
    known = named.select(*names, "words", "n")
    known = F.broadcast(known) if bounded else known
    side = diagonals.join(known, names).join(texts, ["k1", "k2"])
    same = F.transform("words", lambda w, j: F.coalesce(
        F.when(F.col("shift") + j >= 0, F.get(F.col("doc_words"), F.col("shift") + j) == w), F.lit(False)))
    compared = side.select("k1", "k2", "item", "shift", "n", F.least("n", F.lit(span)).alias("width"), same.alias("same"))
    starts = F.filter(F.sequence(F.lit(0), F.col("n") - F.col("width")),
                      lambda s: F.forall(F.slice("same", s + 1, F.col("width")), lambda x: x))
    return compared.select("k1", "k2", "item", "shift", "width", F.explode(starts).alias("start")).select(
        "k1", "k2", "item", (F.col("shift") + F.col("start")).alias("first"),
        (F.col("shift") + F.col("start") + F.col("width")).alias("last"))


def summary(found: DataFrame) -> DataFrame:
    """Per document that is hit: n_hit (words under any window), n_items and items_sha256."""
    from pyspark.sql import Window

    before = Window.partitionBy("k1", "k2").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.select("k1", "k2", "first", "last").distinct()
    fresh = spans.withColumn("reach", F.coalesce(F.max("last").over(before), F.lit(0))).select(
        "k1", "k2", F.greatest(F.lit(0), F.col("last") - F.greatest("first", "reach")).alias("fresh"))
    n_hit = fresh.groupBy("k1", "k2").agg(F.sum("fresh").alias("n_hit"))
    per_item = found.groupBy("k1", "k2").agg(F.array_sort(F.collect_set("item")).alias("items"))  # at most the benchmark
    return n_hit.join(per_item, ["k1", "k2"]).select(
        "k1", "k2", "n_hit", F.size("items").cast("long").alias("n_items"), F.array_join("items", ",").alias("joined"))


def decontaminate(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_text: str = "text", item_id: str = "item_id", span: int = SPAN, k: int = K) -> DataFrame:
    """``docs`` (all rows, all columns but clashing ones) with n_words, n_hit, n_items, items_sha256, contaminated."""
    made = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    key = row_key(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))  # with the id, copies of one text spread over the tasks
    sides = docs.select(*key, F.col(f"`{text}`").alias("text")).where(F.col("text").isNotNull())
    asked = bench.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("item"),
                         F.col(f"`{item_text}`").alias("text"))
    marks = summary(hits(sides, asked, span, k)).select(
        F.col("k1").alias("__m1"), F.col("k2").alias("__m2"), F.col("n_hit").alias("__hit"),
        F.col("n_items").alias("__items"), F.col("joined").alias("__joined"))
    kept = [c for c in docs.columns if c.lower() not in made]
    counted = docs.select(*[F.col(f"`{c}`") for c in kept], key[0].alias("__k1"), key[1].alias("__k2"),
                          F.size(words_of(F.col(f"`{text}`"))).cast("long").alias("n_words"))
    joined = counted.join(marks, (F.col("__k1") == F.col("__m1")) & (F.col("__k2") == F.col("__m2")), "left")
    n_hit = F.coalesce("__hit", F.lit(0)).cast("long")
    return joined.select(*[F.col(f"`{c}`") for c in kept], "n_words", n_hit.alias("n_hit"),
                         F.coalesce("__items", F.lit(0)).cast("long").alias("n_items"),
                         F.sha2(F.coalesce("__joined", F.lit("")).cast("binary"), 256).alias("items_sha256"),
                         (n_hit > 0).alias("contaminated"))


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate(docs, read(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP2_SQL = r"""
    WITH lowered AS (
        SELECT doc_id, row_number() OVER () AS r,
               list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
        FROM documents
    ), asked AS (
        SELECT coalesce(item_id::VARCHAR, '') AS item,
               list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
        FROM benchmark
    ), windows AS (
        SELECT DISTINCT item, least(len(words), 10) AS width, array_to_string(words[i:i + least(len(words), 10) - 1], ' ') AS said
        FROM (SELECT item, words, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i FROM asked WHERE len(words) > 0)
    ), runs AS (
        SELECT r, i, width, array_to_string(words[i:i + width - 1], ' ') AS said
        FROM (SELECT r, words, width, unnest(range(1, len(words) - width + 2)) AS i
              FROM lowered, (SELECT DISTINCT width FROM windows) WHERE len(words) >= width)
    ), found AS (
        SELECT r, i, width, item FROM runs JOIN windows USING (width, said)
    ), covered AS (
        SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + width)) AS p FROM found) GROUP BY r
    ), named AS (
        SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
        FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
    )
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM lowered LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""
