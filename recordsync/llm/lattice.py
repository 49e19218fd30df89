"""Subword lattice likelihood of texts (operator 10).

The vocabulary of a public tokenizer gives the pieces and, by the order of its
scores, their first weights (rank r weighs as 1 / (r + 3), Zipf's law).  The
training texts then re-estimate the weights by expected counts over all
segmentations (``ROUNDS`` of expectation-maximisation over their distinct
words).  A text is a run of pieces and an end; a word starts with the space
mark, so no piece spans two words and the marginal of a text is the product of
its words' marginals and the end's.  Each distinct word's marginal is one
log-space forward recursion over its lattice; documents sum the logarithms.
A word met in training has one more arc, which spans it whole: it weighs as
the word's share of the training tokens, times the share of tokens that are
not singletons (Good and Turing's mass of the seen words); the pieces' arcs
share the rest.  ``word_arcs=False`` leaves the vocabulary's arcs alone.
Characters outside the vocabulary are spelled by its byte pieces, so every
text has a probability above 0.

The base score is the word-unigram model of the contract, from the same counts.

Defined cases: a null or empty text is its end alone; rows with equal values
get equal scores; without training rows all counts are 0 and the first
weights hold; an empty table gives no rows; a very long text is read whole, and
a very long word is joined by its hash; columns with the names of new ones are
replaced.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, written
from .piece_counts import MODEL, _library
from .token_sums import cut, each, sums

ROUNDS = 2
#: Weight that a piece has besides its expected count, so that unseen pieces stay possible.
PRIOR = 0.05
SPACE = 0x2581
_CELLS = 400_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Vocabulary:
    """Pieces by the hash of their characters; byte pieces; first weights by score order."""

    def __init__(self, name: str):
        lib = _library(name)
        ids = [i for i in range(lib.get_piece_size()) if not (lib.is_control(i) or lib.is_unknown(i))]
        order = sorted(ids, key=lambda i: (lib.is_byte(i), -lib.get_score(i), i))
        weights = np.zeros(lib.get_piece_size() + 1)  # the last is the end's
        weights[order] = 1 / (np.arange(len(order)) + 3.0)
        weights[-1] = 1e-3
        self.first = np.log(np.maximum(weights / weights.sum(), 1e-300))
        self.bytes = np.zeros(256, np.int64)
        spelled: list[list[int]] = []
        self.ids: list[int] = []
        for i in ids:
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            else:
                spelled.append([ord(c) for c in piece])
                self.ids.append(i)
        self.longest = max(map(len, spelled))
        hashes = np.array([self._hash(x) for x in spelled], np.uint64)
        at = np.argsort(hashes)
        self.hashes, self.ids = hashes[at], np.array(self.ids)[at]

    @staticmethod
    def _hash(codes: list[int]) -> int:
        h = 0
        for c in codes:
            h = (h * int(_BASE) + c + 1) % (1 << 64)
        return int(_mixed(np.array([h], np.uint64))[0])

    def lookup(self, codes: np.ndarray) -> list[np.ndarray]:
        """For each length l, the piece (or -1) that codes[:, i:i + l] spells, of shape (words, positions)."""
        n = codes.shape[1]
        found, h = [], np.zeros_like(codes, dtype=np.uint64)
        for length in range(1, min(self.longest, n) + 1):
            h = h[:, :n - length + 1] * _BASE + codes[:, length - 1:].astype(np.uint64) + np.uint64(1)
            mixed = _mixed(h)
            at = np.minimum(np.searchsorted(self.hashes, mixed), len(self.hashes) - 1)
            found.append(np.where(self.hashes[at] == mixed, self.ids[at], -1))
        return found


@functools.lru_cache(2)
def vocabulary(name: str) -> Vocabulary:
    return Vocabulary(name)


def _groups(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, characters with the space mark before) of words of one length, a block at a time."""
    lengths = np.array([len(w) for w in words], np.int64)
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        step = max(1, _CELLS // int(n + 1))
        for k in range(0, len(rows), step):
            part = rows[k:k + step]
            codes = np.frombuffer("".join(words[i] for i in part).encode("utf-32-le", "surrogatepass"), np.uint32)
            codes = codes.reshape(len(part), n).astype(np.int64)
            yield part, np.concatenate([np.full((len(part), 1), SPACE, np.int64), codes], axis=1)


def _byte_sum(vocab: Vocabulary, code: int, logs: np.ndarray) -> float:
    return float(logs[vocab.bytes[list(chr(code).encode("utf-8", "surrogatepass"))]].sum())


def _edges(vocab: Vocabulary, codes: np.ndarray, logs: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Piece numbers and log weights by length; characters outside the vocabulary weigh as their bytes."""
    pieces = vocab.lookup(codes)
    weights = [np.where(p >= 0, logs[p], -np.inf) for p in pieces]
    missing = pieces[0] < 0
    if missing.any():
        kinds, at = np.unique(codes[missing], return_inverse=True)
        weights[0][missing] = np.array([_byte_sum(vocab, int(c), logs) for c in kinds])[at]
    return pieces, weights


def _forward(weights: list[np.ndarray], n: int) -> np.ndarray:
    alpha = np.full((len(weights[0]), n + 1), -np.inf)
    alpha[:, 0] = 0
    for j in range(1, n + 1):
        into = [alpha[:, j - k] + weights[k - 1][:, j - k] for k in range(1, min(len(weights), j) + 1)]
        alpha[:, j] = functools.reduce(np.logaddexp, into)
    return alpha


def word_scores(words: list[str], vocab: Vocabulary, logs: np.ndarray) -> np.ndarray:
    """Log marginal of each word over all its segmentations."""
    out = np.zeros(len(words))
    for rows, codes in _groups(words):
        _, weights = _edges(vocab, codes, logs)
        out[rows] = _forward(weights, codes.shape[1])[:, -1]
    return out


def expected_counts(words: list[str], times: np.ndarray, vocab: Vocabulary, logs: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece in ``words``, each met ``times`` times (forward-backward)."""
    counts = np.zeros(len(logs))
    for rows, codes in _groups(words):
        n = codes.shape[1]
        pieces, weights = _edges(vocab, codes, logs)
        alpha = _forward(weights, n)
        beta = np.full_like(alpha, -np.inf)
        beta[:, n] = 0
        for i in range(n - 1, -1, -1):
            out = [weights[k - 1][:, i] + beta[:, i + k] for k in range(1, min(len(weights), n - i) + 1)]
            beta[:, i] = functools.reduce(np.logaddexp, out)
        scale = (np.log(times[rows]) - alpha[:, n])[:, None]
        for k, (piece, weight) in enumerate(zip(pieces, weights), 1):
            used = np.exp(alpha[:, :n - k + 1] + weight + beta[:, k:] + scale)
            known = piece >= 0
            counts += np.bincount(piece[known], used[known], minlength=len(counts))
            if k == 1 and not known.all():
                for code, u in zip(codes[~known].tolist(), used[~known].tolist()):
                    np.add.at(counts, vocab.bytes[list(chr(code).encode("utf-8", "surrogatepass"))], u)
    return counts


def words_of() -> Callable[[str], list[bytes]]:
    """Cuts a text into its words: of bytes, ``lower`` touches A-Z and ``split`` cuts at the white space of ASCII alone."""
    return lambda text: text.encode("utf-8", "surrogatepass").lower().split()


def fit(words: DataFrame, ends: int, name: str, rounds: int) -> np.ndarray:
    """Log weights of the pieces and (last) the end; words: token, c (count in the training texts)."""
    logs = vocabulary(name).first

    for _ in range(rounds):
        def expect(batches: Iterator[pd.DataFrame], logs: np.ndarray = logs) -> Iterator[pd.DataFrame]:
            vocab, counts = vocabulary(name), np.zeros(len(logs))
            for rows in batches:
                counts += expected_counts(rows.token.tolist(), rows.c.to_numpy().astype(float), vocab, logs)
            used = np.flatnonzero(counts)
            yield pd.DataFrame({"piece": used, "uses": counts[used]})

        uses = words.where("c > 0 AND token <> ''").mapInPandas(expect, "piece long, uses double").groupBy("piece").agg(
            F.sum("uses").alias("uses")).collect()  # as many rows as the vocabulary at most
        if not uses:
            return logs
        weights = np.where(logs > math.log(1e-299), PRIOR, 0.0)
        for r in uses:
            weights[r.piece] += r.uses
        weights[-1] = ends + PRIOR
        logs = np.log(np.maximum(weights / weights.sum(), 1e-300))
    return logs


def score(docs: DataFrame, held_out: Column, keep: list[str], text: str = "text", name: str = MODEL,
          rounds: int = ROUNDS, word_arcs: bool = True) -> DataFrame:
    """The columns ``keep`` of ``docs`` with held_out, n_tokens, n_known, train_tokens, base_score and score."""
    made = ["held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kept = [f"`{c}`" for c in keep if c.lower() not in made]
    listed = docs.select(*kept, held_out.alias("held_out"), F.col(f"`{text}`").alias("__text"),
                         F.monotonically_increasing_id().alias("__row"))
    parts = cut(listed, words_of)
    trains = F.when(F.col("held_out"), 0).otherwise(1)
    met = each(parts, "held_out").groupBy("token").agg(F.sum("times").alias("freq"), F.sum(F.col("times") * trains).alias("c"))
    ends = parts.agg(F.count("*").alias("freq"), F.coalesce(F.sum(trains), F.lit(0)).alias("c")).select(F.lit("").alias("token"), "freq", "c")
    words = written(met.unionByName(ends.where("freq > 0")))
    of = words.agg(F.sum("c").alias("n"), F.sum(F.when(F.col("c") > 0, 1).otherwise(0)).alias("v"),
                   F.max(F.when(F.col("token") == "", F.col("c"))).alias("ends"),
                   F.sum(F.when(F.col("c") == 1, 1).otherwise(0)).alias("once")).first()
    n, v, ends, once = (x or 0 for x in of)
    seen = 1 - once / n if n and word_arcs else 0.0
    logs = fit(words.select("token", "c"), ends, name, rounds)

    def marginal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab = vocabulary(name)
        for rows in batches:
            logged = word_scores(rows.token.tolist(), vocab, logs)
            logged[(rows.token == "").to_numpy()] = logs[-1]
            with np.errstate(divide="ignore"):
                whole = np.log(seen * rows.c.to_numpy() / max(n, 1))
                logged = np.logaddexp(whole, np.log(1 - seen) + logged)
            base = np.log10((rows.c + 0.5) / (n + 0.5 * (v + 1)))
            yield pd.DataFrame({"token": rows.token, "freq": rows.freq, "n_tokens": 1, "n_known": (rows.c > 0).astype(int),
                                "base_score": base, "score": logged / math.log(10)})

    names = ["n_tokens", "n_known", "base_score", "score"]
    values = written(words.mapInPandas(
        marginal, "token string, freq long, n_tokens long, n_known long, base_score double, score double"))
    end = values.where("token = ''").first()  # of every text, once
    summed = sums(parts, values.where("token <> ''"), names).select("__row", *[F.col(x).alias(f"__{x}") for x in names])
    joined = parts.join(summed, "__row", "left")
    total = {x: F.coalesce(f"__{x}", F.lit(0)) + F.lit(end[x] if end else 0) for x in names}
    return joined.select(*kept, "held_out", total["n_tokens"].cast("long").alias("n_tokens"),
                         total["n_known"].cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
                         total["base_score"].cast("double").alias("base_score"), total["score"].cast("double").alias("score"))


def op10_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1
    return score(docs, held_out, ["doc_id"])
