"""Toxicity scores by a bidirectional gated recurrent network (operator 3).

A text is cut into windows of ``WINDOW`` words that overlap by half; every
window of the whole text is scored.  Each word enters as a word vector and a
character vector (the mean over its character runs of 3 to 5, with marks for
its ends), both hashed tables, and three evidence values: the log-odds of the
word and of its character runs (largest, mean) between toxic and clean
training texts.  A forward and a backward gated recurrent pass read the
window, attention pools their states, and a logistic unit scores it.  A
document scores as its worst window.

Training is numpy in one task, on a sample of ``PER_CLASS`` labelled rows of
each class with texts of up to ``TRAIN_BYTES`` (the documented bound; chosen
by a hash of doc_id).  A class without such texts is learned from its shortest
ones, up to ``PER_CLASS * TRAIN_BYTES`` bytes of text.  Labels are given to texts, not to windows, so every
epoch trains on the window that scores worst at the time, and for clean texts
on another one besides.  A quarter of the sample is kept back.

The threshold is a statistic of all labelled rows outside the held-out ones,
whole texts of any length (``calibrate``).  They are scored in Spark and
counted by class, by whether they were learned, by level (the binary logarithm
of their number of windows) and by bins of their worst logit.  The worst of
many windows is larger by chance, so a level takes ``slope`` off the logit; the
slope and the threshold are those of best F1, and the threshold is mapped to
the score 0.3.  Of each class and level the rows that were not learned are
judged, and stand for the learned ones too; if all were learned, those are.

Defined cases: texts without a word score 0; rows without a label are scored
like others; several labels of one doc_id count as the largest; without
labels of both classes every score is the share of toxic labels (0 if none); a
very long text is scored in all its windows, a few at a time; equal texts get
equal scores; an empty table gives no rows; columns with the names of new ones
are replaced.  To learn from, at most ``4 * PER_CLASS`` rows of a class are
taken, should the hash draw more than expected.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytespans import LOWER, chunks, hashes, mixed, spans
from .common import read, small, without

WINDOW, STRIDE = 24, 12
HIDDEN, WIDTH = 8, 4
BITS = 18
RUNS = (3, 4, 5)
EPOCHS, BATCH, RATE = 8, 128, 0.01
#: Bounds of the training sample.
PER_CLASS = 1200
TRAIN_BYTES = 12_000
THRESHOLD = 0.3
#: Rows of each class that the part kept back needs; else the whole sample is learned.
FEW = 10
#: Bins of logits in the statistic of the threshold, and the slopes tried, in bins a level.
BIN, BINS = 0.05, 800
SLOPES = range(41)
#: Labels that are broadcast to the documents at most (16 bytes each).
BROADCAST_LABELS = 500_000
_BATCH_WINDOWS = 4096
_BATCH_WORDS = 20_000

WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Words:
    """The words of some texts: text and distinct word of each, and the character runs of the distinct."""
    row: np.ndarray
    of: np.ndarray
    bucket: np.ndarray
    runs: np.ndarray  # buckets, word after word
    first: np.ndarray  # first run of each word, and the end


def read_words(offsets: np.ndarray, data: np.ndarray) -> Words:
    data = LOWER[data]
    row, starts, ends = spans(offsets, data, WORD)
    hashed = hashes(data, starts, ends)
    distinct, at, of = np.unique(hashed, return_index=True, return_inverse=True)
    lengths = (ends - starts)[at]
    # The distinct words side by side, each between the marks 1 and 2.
    begin = np.concatenate([[0], np.cumsum(lengths + 2)])
    padded = np.empty(begin[-1], np.uint8)
    padded[begin[:-1]] = 1
    padded[begin[1:] - 1] = 2
    inner = np.ones(len(padded), bool)
    inner[begin[:-1]] = inner[begin[1:] - 1] = False
    padded[inner] = data[np.repeat(starts[at] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
                         + np.arange(lengths.sum())] if len(at) else 0
    word = np.repeat(np.arange(len(at)), lengths + 2)
    parts, owners = [], []
    rolled = np.zeros(len(padded), np.uint64)
    for n in range(1, max(RUNS) + 1):
        if len(padded) < n:
            break
        rolled = rolled[:len(padded) - n + 1] * np.uint64(1_000_003) + padded[n - 1:] + np.uint64(1)
        if n in RUNS:
            whole = word[:len(rolled)] == word[n - 1:]
            parts.append(mixed(rolled[whole] + np.uint64(n << 40)) >> np.uint64(64 - BITS))
            owners.append(word[:len(rolled)][whole])
    runs, owner = (np.concatenate(parts), np.concatenate(owners)) if parts else (np.zeros(0, np.uint64), np.zeros(0, int))
    order = np.argsort(owner, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(at)))])
    return Words(row, of.reshape(-1), (distinct >> np.uint64(64 - BITS)).astype(np.int64), runs[order].astype(np.int32), first)


def windows(row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, length) of the windows over words that are sorted by text."""
    texts, begin, n = np.unique(row, return_index=True, return_counts=True)
    each = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
    nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    start = np.repeat(begin, each) + nth * STRIDE
    return np.repeat(texts, each), start, np.minimum(WINDOW, np.repeat(begin + n, each) - start)


def levels(n: np.ndarray) -> np.ndarray:
    """Binary logarithm of numbers of windows, rounded down."""
    return np.frexp(np.maximum(1, n))[1].astype(np.int64) - 1


def bins(logit: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(logit / BIN), -BINS, BINS).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    odds_word: np.ndarray
    odds_run: np.ndarray
    table_word: np.ndarray
    table_run: np.ndarray
    dense: dict[str, np.ndarray] = field(default_factory=dict)
    scale: float = 1.0
    middle: float = 0.0
    slope: float = 0.0

    @classmethod
    def new(cls, odds_word: np.ndarray, odds_run: np.ndarray, rng: np.random.Generator) -> Network:
        def draw(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        inputs = 2 * WIDTH + 3
        dense = {"inputs": draw(inputs, 6 * HIDDEN), "bias": np.zeros(6 * HIDDEN, np.float32),
                 "ask": draw(2 * HIDDEN), "out": draw(2 * HIDDEN), "base": np.zeros(1, np.float32)}
        for side in "fb":
            dense |= {f"gates_{side}": draw(HIDDEN, 2 * HIDDEN), f"state_{side}": draw(HIDDEN, HIDDEN)}
        tables = [(rng.standard_normal((1 << BITS, WIDTH)) * 0.1).astype(np.float32) for _ in range(2)]
        return cls(odds_word, odds_run, *tables, dense)

    def features(self, words: Words) -> np.ndarray:
        """Inputs of the distinct words.  Every word has runs: with its marks it has 3 bytes."""
        out = np.empty((len(words.bucket), 2 * WIDTH + 3), np.float32)
        out[:, :WIDTH] = self.table_word[words.bucket]
        out[:, -3] = self.odds_word[words.bucket]
        for k in range(0, len(out), _BATCH_WORDS):
            bounds = words.first[k:k + _BATCH_WORDS + 1]
            runs, at = words.runs[bounds[0]:bounds[-1]], bounds[:-1] - bounds[0]
            part, n, odds = slice(k, k + len(at)), np.diff(bounds), self.odds_run[runs]
            out[part, WIDTH:2 * WIDTH] = np.add.reduceat(self.table_run[runs], at) / n[:, None]
            out[part, -2] = np.maximum.reduceat(odds, at)
            out[part, -1] = np.add.reduceat(odds, at) / n
        return out

    def _pass(self, side: str, given: list[np.ndarray], mask: np.ndarray) -> list[tuple]:
        gates, state = self.dense[f"gates_{side}"], self.dense[f"state_{side}"]
        h, trace = np.zeros((len(mask), HIDDEN), np.float32), []
        for t in range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1):
            zr = _sigmoid(given[t][:, :2 * HIDDEN] + h @ gates)
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = np.tanh(given[t][:, 2 * HIDDEN:] + (r * h) @ state)
            new = np.where(mask[:, t:t + 1], h + z * (c - h), h)
            trace.append((t, h, z, r, c, new))
            h = new
        return trace

    def forward(self, projected: np.ndarray, of: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple:
        """Logits of windows, and what the backward pass needs.  projected: inputs of the distinct words."""
        mask = np.arange(WINDOW) < length[:, None]
        at = of[np.minimum(start[:, None] + np.arange(WINDOW), len(of) - 1)]
        given = projected[at.T]
        half = 3 * HIDDEN
        trace = {"f": self._pass("f", list(given[:, :, :half]), mask), "b": self._pass("b", list(given[:, :, half:]), mask)}
        states = np.empty((WINDOW, len(start), 2 * HIDDEN), np.float32)
        for side, place in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            for t, *_, new in trace[side]:
                states[t, :, place] = new
        asked = np.where(mask.T, states @ self.dense["ask"], -np.inf)
        weight = np.exp(asked - asked.max(0))
        weight /= weight.sum(0)
        pooled = np.einsum("tb,tbh->bh", weight, states)
        return pooled @ self.dense["out"] + self.dense["base"][0], (mask, at, trace, states, weight, pooled)

    def backward(self, wrong: np.ndarray, kept: tuple) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the dense parameters but the input layer's, and of the projected inputs (time, window, -)."""
        mask, at, trace, states, weight, pooled = kept
        d = self.dense
        grad = {"out": pooled.T @ wrong, "base": wrong.sum(keepdims=True)}
        to_pooled = wrong[:, None] * d["out"]
        to_weight = np.einsum("bh,tbh->tb", to_pooled, states)
        to_asked = weight * (to_weight - (weight * to_weight).sum(0))
        grad["ask"] = np.einsum("tb,tbh->h", to_asked, states)
        to_states = weight[:, :, None] * to_pooled + to_asked[:, :, None] * d["ask"]
        to_given = np.zeros((*at.T.shape, 6 * HIDDEN), np.float32)
        for side, place, given in (("f", slice(0, HIDDEN), 0), ("b", slice(HIDDEN, None), 3 * HIDDEN)):
            gates, state = d[f"gates_{side}"], d[f"state_{side}"]
            g_gates, g_state = np.zeros_like(gates), np.zeros_like(state)
            back = np.zeros((len(wrong), HIDDEN), np.float32)
            for t, h, z, r, c, _ in reversed(trace[side]):
                back = back + to_states[t, :, place]
                live = back * mask[:, t:t + 1]
                to_c = live * z * (1 - c * c)
                to_rh = to_c @ state.T
                to_zr = np.concatenate([live * (c - h) * z * (1 - z), to_rh * h * r * (1 - r)], axis=1)
                g_state += (r * h).T @ to_c
                g_gates += h.T @ to_zr
                back = back - live + live * (1 - z) + to_rh * r + to_zr @ gates.T
                to_given[t, :, given:given + 3 * HIDDEN] = np.concatenate([to_zr, to_c], axis=1)
            grad |= {f"gates_{side}": g_gates, f"state_{side}": g_state}
        return grad, to_given

    def logits(self, words: Words, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        projected = self.features(words) @ self.dense["inputs"] + self.dense["bias"]
        out = np.empty(len(start), np.float32)
        for k in range(0, len(start), _BATCH_WINDOWS):
            part = slice(k, k + _BATCH_WINDOWS)
            out[part] = self.forward(projected, words.of, start[part], length[part])[0]
        return out

    def worst(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Largest logit (-inf without words) and level of every text of an Arrow column."""
        worst, n = np.full(len(column), -np.inf), np.zeros(len(column), np.int64)
        for row, offsets, data in chunks(column):
            words = read_words(offsets, data)
            if len(words.row):
                text, start, length = windows(words.row)
                np.maximum.at(worst, row + text, self.logits(words, start, length))
                np.add.at(n, row + text, 1)
        return worst, levels(n)

    def scores(self, column: pa.Array) -> np.ndarray:
        """Score of every text of an Arrow column."""
        worst, level = self.worst(column)
        mapped = _sigmoid(self.scale * (worst - self.slope * level - self.middle) + np.log(THRESHOLD / (1 - THRESHOLD)))
        return np.where(np.isneginf(worst), 0.0, mapped)


def log_odds(words: Words, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed log-odds, toxic against clean texts, of each word bucket and each bucket of character runs."""
    size = 1 << BITS
    met = np.zeros((2, 2, size), np.int32)  # words and runs, clean and toxic
    texts, begin = np.unique(words.row, return_index=True)
    for text, a, b in zip(texts, begin, np.append(begin[1:], len(words.row))):
        own = np.unique(words.of[a:b])
        n = np.diff(words.first)[own]
        runs = words.runs[np.repeat(words.first[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        for kind, bucket in enumerate((words.bucket[own], runs)):
            met[kind, int(toxic[text]), np.unique(bucket)] += 1
    prior, share = 4.0, toxic.mean()
    rate = (met[:, 1] + prior * share) / (met.sum(axis=1) + prior)
    odds = (np.log(rate / (1 - rate)) - np.log(share / (1 - share))).astype(np.float32)
    return odds[0], odds[1]


def enough(toxic: np.ndarray, kept_back: np.ndarray) -> bool:
    """Whether the part kept back has FEW rows of each class."""
    return min(toxic[kept_back].sum(), (~toxic[kept_back]).sum()) >= FEW


def train(texts: list[str], toxic: np.ndarray, kept_back: np.ndarray | None = None, seed: int = 7) -> Network:
    """A network for texts of both classes, with the threshold that fits these texts.  kept_back: rows not to
    learn (a random quarter, if None)."""
    rng = np.random.default_rng(seed)
    drawn = rng.random(len(texts)) < 0.25
    kept_back = drawn if kept_back is None else kept_back.copy()
    if not enough(toxic, kept_back):
        kept_back[:] = False
    learn = np.flatnonzero(~kept_back)
    column = pa.array(texts, pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[:len(texts) + 1]
    words = read_words(offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8))
    chosen = ~kept_back[words.row]
    learned = Words(words.row[chosen], words.of[chosen], words.bucket, words.runs, words.first)
    net = Network.new(*log_odds(learned, toxic), rng)
    text, start, length = windows(words.row)
    mine = ~kept_back[text]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.dense.items()}
    squares = [np.full(1 << BITS, 1e-3, np.float32) for _ in range(2)]
    step = 0
    for epoch in range(EPOCHS):
        scored = net.logits(words, start, length) if epoch else np.add.reduceat(
            net.features(words)[words.of, -2], start)  # first by the strongest character run
        order = np.lexsort((scored, text))
        worst = order[np.append(text[order][1:] != text[order][:-1], True)]
        other = rng.permutation(np.flatnonzero(mine & ~toxic[text]))[:len(learn)]
        picked = rng.permutation(np.concatenate([worst[mine[worst]], other]))
        features = net.features(words)
        for k in range(0, len(picked), BATCH):
            part = picked[k:k + BATCH]
            step += 1
            seen, inverse = np.unique(words.of[np.minimum(start[part][:, None] + np.arange(WINDOW), len(words.of) - 1)],
                                      return_inverse=True)
            place = np.zeros(len(words.bucket), np.int64)
            place[seen] = np.arange(len(seen))
            small = features[seen]
            logit, kept = net.forward(small @ net.dense["inputs"] + net.dense["bias"], place[words.of], start[part], length[part])
            wrong = ((_sigmoid(logit) - toxic[text[part]]) / len(part)).astype(np.float32)
            grad, to_given = net.backward(wrong, kept)
            summed = np.zeros((len(seen), 6 * HIDDEN), np.float32)
            np.add.at(summed, kept[1].T.reshape(-1), to_given.reshape(-1, 6 * HIDDEN))
            grad |= {"inputs": small.T @ summed, "bias": summed.sum(0)}
            to_words = summed @ net.dense["inputs"].T
            for name, g in grad.items():
                m, v = moments[name]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                net.dense[name] -= (RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            _learn_tables(net, words, seen, to_words, squares)
    worst = np.full(len(toxic), -np.inf)
    np.maximum.at(worst, text, net.logits(words, start, length))
    read = np.isfinite(worst)
    calibrate(net, toxic[read], ~kept_back[read], levels(np.bincount(text, minlength=len(toxic)))[read], bins(worst[read]),
              np.ones(read.sum()))
    return net


def _learn_tables(net: Network, words: Words, seen: np.ndarray, to_words: np.ndarray, squares: list[np.ndarray]) -> None:
    """One step of Adagrad on the vectors of the words of a batch and of their character runs."""
    n = np.diff(words.first)[seen]
    runs = words.runs[np.repeat(words.first[seen] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    shared = np.repeat(to_words[:, WIDTH:2 * WIDTH] / n[:, None], n, axis=0)
    for table, square, bucket, grad in ((net.table_word, squares[0], words.bucket[seen], to_words[:, :WIDTH]),
                                        (net.table_run, squares[1], runs, shared)):
        at, inverse = np.unique(bucket, return_inverse=True)
        summed = np.stack([np.bincount(inverse, grad[:, j], len(at)) for j in range(WIDTH)], 1)
        square[at] += (summed**2).mean(1)
        table[at] -= (0.05 * summed / np.sqrt(square[at])[:, None]).astype(np.float32)


def calibrate(net: Network, toxic: np.ndarray, learned: np.ndarray, level: np.ndarray, logit: np.ndarray,
              n: np.ndarray) -> None:
    """Slope and threshold of best F1.  n: texts of a class, learned or not, of a level and a bin of logits."""
    _, cell = np.unique(np.stack([toxic, level]), axis=1, return_inverse=True)
    cell = cell.reshape(-1)
    every, fresh = np.bincount(cell, n), np.bincount(cell, n * ~learned)
    stands = np.where(fresh > 0, every / np.maximum(1, fresh), 1.0)[cell]  # texts that a judged one stands for
    judged = ~learned | (fresh == 0)[cell]
    toxic, level, logit, n = toxic[judged], level[judged], logit[judged], (n * stands)[judged]
    best = -1.0
    for slope in SLOPES if len(n) else []:
        at, of = np.unique(-(logit - slope * level), return_inverse=True)  # highest first
        of = of.reshape(-1)
        caught, wrong = (np.cumsum(np.bincount(of, n * x, len(at))) for x in (toxic, ~toxic))
        bad = caught[-1]
        f1 = 2 * caught / (caught + wrong + np.maximum(1e-9, bad))
        f1[caught + wrong > 2 * bad] = 0  # a network that learned nothing isn't to flag everything
        k = int(np.argmax(f1))
        if f1[k] > best:
            best = f1[k]
            below = -at[k + 1] + 1 if k + 1 < len(at) else -at[k]  # upper end of the next bin
            net.slope, net.middle = slope * BIN, (below - at[k]) / 2 * BIN


def sample(docs: DataFrame, labels: DataFrame, learns: Column, text: str) -> tuple[DataFrame | None, DataFrame | None, float]:
    """(sample, rows, share of toxic labels): a bounded sample of the labelled rows that ``learns`` allows (doc_id,
    text, toxic, kept_back), and all of these rows (and taken: whether the sample has them); None without labels of
    both classes."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        (F.max("toxic") == 1).alias("toxic")).where(learns)
    n = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    total = sum(n.values())
    share = n.get(True, 0) / total if total else 0.0
    if len(n) < 2:
        return None, None, share
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    drawn = draw < F.when(F.col("toxic"), PER_CLASS / n[True]).otherwise(PER_CLASS / n[False])  # 2 * PER_CLASS expected
    marked = small(known.select("doc_id", "toxic", drawn.alias("drawn"),
                                (F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(4)) == 0).alias("kept_back")), BROADCAST_LABELS)
    given = docs.select("doc_id", F.col(f"`{text}`").alias("text"))
    short = F.coalesce(F.octet_length("text").between(1, TRAIN_BYTES), F.lit(False))
    taken = given.where(short).join(F.broadcast(marked.where("drawn").drop("drawn")), "doc_id")
    return taken, given.join(marked, "doc_id").withColumn("taken", F.col("drawn") & short), share


def longer(taken: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What ``sample`` gives, with texts beyond TRAIN_BYTES for a class that has no others: the shortest, as many as
    PER_CLASS such texts weigh (one of more is cut to that)."""
    room = PER_CLASS * TRAIN_BYTES
    ids = []
    for toxic in {True, False} - {r.toxic for r in taken.select("toxic").distinct().collect()}:
        sized = rows.where((F.col("toxic") == toxic) & (F.octet_length("text") > 0)).select(
            "doc_id", F.octet_length("text").alias("size"))
        used = 0
        for r in sized.orderBy("size", "doc_id").limit(PER_CLASS).collect():
            if not used or used + r.size <= room:
                ids.append(r.doc_id)
                used += r.size
    marked = rows.withColumn("taken", F.col("taken") | F.col("doc_id").isin(ids) & (F.octet_length("text") > 0))
    cut = marked.where("taken").select("doc_id", F.substring("text", 1, room).alias("text"), "toxic", "kept_back")
    return cut, marked


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learn_sample(rows: DataFrame) -> tuple[Network, bool] | None:
    """The network, trained in one task on the sample, and whether some of its rows were kept back; None if it
    lacks a class."""
    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: list[pd.DataFrame] = []
        for batch in batches:
            room = 4 * PER_CLASS - sum(len(p) for p in parts)  # only repeated rows of sampled ids can come near
            parts.append(batch.iloc[:room])
        given = pd.concat(parts) if parts else None
        if given is not None and given.toxic.nunique() == 2:
            toxic, back = given.toxic.to_numpy(bool), given.kept_back.to_numpy(bool)
            yield pd.DataFrame({"network": [pickle.dumps((train(given.text.tolist(), toxic, back), enough(toxic, back)))]})
    ordered = rows.repartition(1).sortWithinPartitions("doc_id", "text")
    made = ordered.mapInPandas(learn, "network binary").collect()
    return pickle.loads(made[0].network) if made else None


def counted(rows: DataFrame, network: Network) -> DataFrame:
    """(toxic, learned, level, logit, n): the labelled rows with words, by class, level and bin of their worst logit."""
    shared = rows.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            worst, level = shared.value.worst(batch.column(2))
            kept = np.isfinite(worst)
            known = [batch.column(i).filter(pa.array(kept)) for i in range(2)]
            yield pa.RecordBatch.from_arrays([*known, pa.array(level[kept]), pa.array(bins(worst[kept]))],
                                             ["toxic", "learned", "level", "logit"])
    met = rows.select("toxic", "learned", "text").mapInArrow(run, "toxic boolean, learned boolean, level long, logit long")
    return met.groupBy("toxic", "learned", "level", "logit").agg(F.count(F.lit(1)).alias("n"))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text") -> tuple[Network | None, float]:
    """The network, trained on the bounded sample and with the threshold of all labelled rows, and the share of
    toxic labels."""
    taken, rows, share = sample(docs, labels, ~held_out(), text)
    made = learn_sample(taken) if taken is not None else None
    if made is None and rows is not None:  # a class has no text within the bound
        taken, rows = longer(taken, rows)
        made = learn_sample(taken)
    if made is None:
        return None, share
    network, holds = made
    seen = F.col("taken") & ~F.col("kept_back") if holds else F.col("taken")
    found = counted(rows.withColumn("learned", seen), network).toPandas()  # a bounded number of bins
    calibrate(network, found.toxic.to_numpy(bool), found.learned.to_numpy(bool), found.level.to_numpy(), found.logit.to_numpy(),
              found.n.to_numpy(float))
    return network, share


def score(docs: DataFrame, network: Network | None, share: float = 0.0, text: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all, if None) with score and predicted."""
    spark = docs.sparkSession
    kept = without(docs if keep is None else docs.select(*[f"`{c}`" for c in keep]), "score", "predicted")
    names = kept.columns
    given = docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`").alias("__text"))
    schema = kept.select("*", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema
    shared = spark.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            text_at = batch.num_columns - 1
            found = net.scores(batch.column(text_at)) if net else np.full(batch.num_rows, share)
            columns = [batch.column(i) for i in range(text_at)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found, pa.float64()), pa.array((found >= THRESHOLD).astype(np.int32))],
                [*names, "score", "predicted"])
    return given.mapInArrow(run, schema)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    network, share = fit(docs, read(spark, sf_dir, "labels"))
    marked = docs.select("doc_id", held_out().alias("held_out"), "text")
    return score(marked, network, share, keep=["doc_id", "held_out"])
