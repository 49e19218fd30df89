"""Token counts, lattice scores, toxicity, mixing, nearest neighbours, pages and the pipeline."""

import math
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recordsync.llm import dom_model, lattice, lsh_forest, piece_counts, raking, token_sums, toxicity, winnowing
from recordsync.llm.bytespans import BLANK, chunks, hashes, spans

SMOKE = "/root/testdata/sf0.001"

EDGE_TEXTS = ["", " ", "  ", "a", " a", "a  b", "a b ", "a\nb", "\n", "\n\n a", "a\xa0b", "ﬁ", "<s>", "</s> x", "<0x41>", "▁a",
              "a▁b", "a▁ b", " ▁ b▁", "\t", "é", "\x00a", "​", "a\r\nb", "﻿a", "x" * 5000, "don't.stop—”.x’, y»...",
              "a.\r b!”c?", None, "日本語 テスト。", "--------- ====\n\n   x", "a'b\"c(d)e", "word " * 3000]


def test_token_counts_are_the_library_s(spark, monkeypatch):
    lib = piece_counts._library(piece_counts.MODEL)
    real = [r.text for r in spark.read.parquet(f"{SMOKE}/documents.parquet").limit(60).collect()]
    texts = EDGE_TEXTS + real + [real[0]]
    df = spark.createDataFrame(list(enumerate(texts)) + [(0, ""), (0, "")], "doc_id long, text string")
    monkeypatch.setattr(token_sums, "HEAD", 100)  # so that most tokens take the other path
    monkeypatch.setattr(token_sums.sums, "__defaults__", (100,))
    got = piece_counts.count_tokens(df).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        want = len(lib.encode(texts[r.doc_id] or ""))
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (want, len((texts[r.doc_id] or "").encode()), want > 4096), r.doc_id
    assert piece_counts.count_tokens(df.where("false")).collect() == []


@pytest.mark.parametrize("head", [200_000, 3])
def test_token_counts_of_long_texts_without_spaces(spark, monkeypatch, head):
    """Each is one pre-token of its own, joined by a key of bounded length; clashing columns are replaced."""
    monkeypatch.setattr(token_sums, "HEAD", head)
    lib = piece_counts._library(piece_counts.MODEL)
    rnd = random.Random(1)
    texts = ["".join(chr(rnd.randrange(0x4E00, 0x4E80)) for _ in range(400)) for _ in range(1000)]
    texts = texts[:40] * 25 + texts[40:]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    want = {t: len(lib.encode(t)) for t in set(texts)}
    out = piece_counts.count_tokens(df)
    assert out.columns == ["doc_id", "text", "n_bytes", "n_tokens", "over_limit"]
    assert all(r.n_tokens == want[r.text] and r.n_bytes == 1200 for r in out.collect())
    keys = df.select(token_sums.join_key(F.col("text")).alias("key")).distinct()
    assert keys.count() == len(want) and keys.agg(F.max(F.octet_length("key"))).first()[0] <= token_sums.KEY_BYTES + 32


def brute_marginal(word, vocab, logs):
    """Sum over all segmentations, one by one."""
    pieces = {}
    lib = piece_counts._library(piece_counts.MODEL)
    for i in vocab.ids:
        pieces[lib.id_to_piece(int(i))] = logs[i]
    text = "▁" + word

    def rest(at):
        if at == len(text):
            return 1.0
        total = 0.0
        for end in range(at + 1, len(text) + 1):
            piece = text[at:end]
            if piece in pieces:
                total += math.exp(pieces[piece]) * rest(end)
            elif end == at + 1:
                total += math.exp(sum(logs[vocab.bytes[b]] for b in piece.encode())) * rest(end)
        return total
    return math.log(rest(0))


def test_lattice_forward_is_the_sum_over_segmentations():
    vocab = lattice.vocabulary(lattice.MODEL)
    words = ["a", "the", "there", "zqxj", "né", "①b", "12,3"]
    got = lattice.word_scores(words, vocab, vocab.first)
    assert np.allclose(got, [brute_marginal(w, vocab, vocab.first) for w in words])
    counts = lattice.expected_counts(["there"], np.array([3.0]), vocab, vocab.first)
    lib = piece_counts._library(piece_counts.MODEL)
    spelled = sum(c * len(lib.id_to_piece(i)) for i, c in enumerate(counts[:-1]) if c)
    assert math.isclose(spelled, 3 * len("▁there"))


def test_lattice_scores(spark):
    rows = [(i, f"the cat sat on the mat number {i % 7} again") for i in range(40)] + [
        (50, None), (51, ""), (52, "zzqy unheard"), (53, "Cat the THE"), (53, "Cat the THE")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in lattice.score(df, F.col("doc_id") >= 50, ["doc_id"]).collect()}
    counts, n = {}, 0
    for d, t in rows:
        if d < 50:
            for w in [*(t or "").translate({i: i + 32 for i in range(65, 91)}).split(), None]:
                counts[w] = counts.get(w, 0) + 1
                n += 1
    for d, t in rows:
        tokens = [*(t or "").translate({i: i + 32 for i in range(65, 91)}).split(), None]
        base = sum(math.log10((counts.get(w, 0) + 0.5) / (n + 0.5 * (len(counts) + 1))) for w in tokens)
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(w in counts for w in tokens), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    assert got[53].score > got[52].score
    assert lattice.score(df.where("false"), F.lit(False), ["doc_id"]).collect() == []
    clash = lattice.score(df.withColumn("Score", F.lit("own")), F.col("doc_id") >= 50, ["doc_id", "Score"])
    assert clash.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert {r.doc_id: r.score for r in clash.collect()} == {d: r.score for d, r in got.items()}


def test_lattice_learns(spark):
    """The trained weights give the texts of the smoke table a better likelihood than the first ones."""
    df = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    score = {r: lattice.score(df, held, ["doc_id"], rounds=r, word_arcs=False).where("held_out").agg(
        F.sum("score") / F.sum("n_tokens")).first()[0] for r in (0, 2)}
    assert score[2] > score[0] + 1


def test_byte_words():
    texts = ["Ab  cé\n", "", None, "x", "ab cé"]
    found = []
    for row, offsets, data in chunks(pa.array(texts)):
        text, start, end = spans(offsets, data, ~BLANK)
        h = hashes(data, start, end)
        found += [(row + t, bytes(data[s:e]).decode(), int(v)) for t, s, e, v in zip(text, start, end, h)]
    assert [x[:2] for x in found] == [(0, "Ab"), (0, "cé"), (3, "x"), (4, "ab"), (4, "cé")]
    assert found[1][2] == found[4][2] and len({x[2] for x in found}) == 4


def toxic_texts(n, seed):
    rng = np.random.default_rng(seed)
    stems = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]
    bad = ["idiot", "moron", "scum"]
    texts, labels = [], []
    for i in range(n):
        w = ["".join(rng.choice(stems, rng.integers(1, 4))) for _ in range(rng.integers(5, 120))]
        if i % 3 == 0:
            w[rng.integers(len(w))] = rng.choice(bad) if i % 2 else "vorqu" + rng.choice(stems)
        texts.append(" ".join(w))
        labels.append(i % 3 == 0)
    return texts, np.array(labels)


def test_toxicity_learns_words_and_stems():
    net = toxicity.train(*toxic_texts(900, 1))
    texts, labels = toxic_texts(400, 2)
    scores = net.scores(pa.array(texts + ["", None, "vorquxyz", "x" * 50_000]))
    flagged = scores[:400] >= toxicity.THRESHOLD
    assert (flagged == labels).mean() > 0.95
    assert scores[400] == scores[401] == 0 and scores[402] >= toxicity.THRESHOLD and np.isfinite(scores).all()


def test_toxicity_threshold_of_all_labels():
    """Long clean texts whose worst window scores as high as that of short toxic ones raise the threshold of long texts."""
    rng = np.random.default_rng(4)
    net = toxicity.Network(*[np.zeros(1, np.float32)] * 4)
    toxic = np.repeat([False, True, False], [3000, 300, 900])
    level = np.repeat([2, 2, 12], [3000, 300, 900])
    logit = np.concatenate([rng.normal(-6, 1, 3000), rng.normal(0, 1, 300), rng.normal(0, 1, 900)])
    fresh = np.ones(len(toxic), bool)
    toxicity.calibrate(net, toxic, ~fresh, level, toxicity.bins(logit), fresh.astype(float))
    flagged = logit - net.slope * level >= net.middle
    assert net.slope > 0 and flagged[toxic].mean() > 0.95 and flagged[~toxic].mean() < 0.02
    assert np.array_equal(toxicity.levels(np.array([0, 1, 2, 3, 4, 1023, 1024])), [0, 0, 1, 1, 2, 9, 10])
    # Learned rows count through the others of their class and level.
    toxicity.calibrate(net, toxic, toxic & (logit < 0), level, toxicity.bins(np.where(toxic & (logit < 0), -50, logit)), fresh.astype(float))
    assert (logit - net.slope * level >= net.middle)[toxic & (logit >= 0)].mean() > 0.95


def test_toxicity_judges_long_texts(spark):
    """Texts beyond the bound of the training sample take part in the threshold."""
    texts, labels = toxic_texts(300, 8)
    clean = [t for t, x in zip(*toxic_texts(1200, 9)) if not x]
    long = [" ".join(clean[i::20] * 2) for i in range(20)]
    assert min(len(t) for t in long) > toxicity.TRAIN_BYTES
    docs = spark.createDataFrame(list(enumerate(texts + long)), "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i < 300 and labels[i])) for i in range(320)], "doc_id long, toxic int")
    taken, rows, _ = toxicity.sample(docs, marks, ~toxicity.held_out(), "text")
    assert taken.where("doc_id >= 300").isEmpty() and not rows.where("doc_id >= 300").isEmpty()
    net, _ = toxicity.fit(docs, marks)
    found = toxicity.counted(rows.withColumn("learned", F.lit(False)), net).collect()
    assert sum(r.n for r in found) == docs.where(~toxicity.held_out()).count()
    assert sum(r.n for r in found if r.level >= 6) >= rows.where("doc_id >= 300").count()


def test_toxicity_without_a_network(spark, monkeypatch, tmp_path):
    """A class of long texts alone is learned from them; with nothing to learn from, the pipeline rejects nothing."""
    import corpus_pipeline as cp

    texts, labels = toxic_texts(300, 6)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(x)) for i, x in enumerate(labels)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "TRAIN_BYTES", 60)
    long = docs.where(F.octet_length("text") > 60)
    net, share = toxicity.fit(long, marks.where("toxic = 1").unionByName(marks.where("toxic = 0").limit(60)))
    assert net is not None and 0 < share < 1
    flagged = {r.doc_id: r.predicted for r in toxicity.score(long, net, share).collect()}
    assert 0 < sum(flagged.values()) < len(flagged)
    marks.where("toxic = 1").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.drop_toxic(spark, docs, str(tmp_path)).count() == docs.count()


def test_toxicity_gradients():
    rng = np.random.default_rng(3)
    net = toxicity.Network.new(np.zeros(1 << toxicity.BITS, np.float32), np.zeros(1 << toxicity.BITS, np.float32), rng)
    net.dense = {k: v.astype(float) for k, v in net.dense.items()}
    projected, of = rng.standard_normal((9, 6 * toxicity.HIDDEN)), rng.integers(0, 9, 30)
    start, length, weigh = np.array([0, 5, 28]), np.array([24, 7, 2]), np.array([0.3, -0.7, 1.1])
    _, kept = net.forward(projected, of, start, length)
    grad, to_given = net.backward(weigh, kept)
    for name in ("ask", "out", "gates_f", "state_b"):
        at = tuple(0 for _ in net.dense[name].shape)
        values = []
        for step in (1e-3, -1e-3):
            net.dense[name][at] += step
            values.append((net.forward(projected, of, start, length)[0] * weigh).sum())
            net.dense[name][at] -= step
        assert math.isclose((values[0] - values[1]) / 2e-3, grad[name][at], rel_tol=0.02, abs_tol=1e-4), name


def plain_toxicity(net, text):
    """The network's score of a text, window by window, step by step and number by number."""
    H, W = toxicity.HIDDEN, toxicity.WIDTH
    data = np.frombuffer(text.encode(), np.uint8)
    words = toxicity.read_words(np.array([0, len(data)]), data)
    if not len(words.of):
        return 0.0
    d = {k: v.astype(float).tolist() for k, v in net.dense.items()}

    def sig(v):
        return 1 / (1 + math.exp(-v))

    def entered(i):
        """A word's inputs, times the input layer."""
        runs = words.runs[words.first[i]:words.first[i + 1]].tolist()
        odds = [float(net.odds_run[r]) for r in runs]
        x = [float(v) for v in net.table_word[words.bucket[i]]]
        x += [sum(float(net.table_run[r][j]) for r in runs) / len(runs) for j in range(W)]
        x += [float(net.odds_word[words.bucket[i]]), max(odds), sum(odds) / len(odds)]
        return [d["bias"][j] + sum(x[k] * d["inputs"][k][j] for k in range(len(x))) for j in range(6 * H)]
    inputs = {i: entered(i) for i in set(words.of.tolist())}

    def passed(given, side):
        gates, state, h, states = d[f"gates_{side}"], d[f"state_{side}"], [0.0] * H, []
        for x in given:
            zr = [sig(x[j] + sum(h[k] * gates[k][j] for k in range(H))) for j in range(2 * H)]
            c = [math.tanh(x[2 * H + j] + sum(zr[H + k] * h[k] * state[k][j] for k in range(H))) for j in range(H)]
            h = [h[j] + zr[j] * (c[j] - h[j]) for j in range(H)]
            states.append(h)
        return states
    worst, begin, of = -math.inf, 0, words.of.tolist()
    count = 0
    while True:
        window = [inputs[i] for i in of[begin:begin + toxicity.WINDOW]]
        forward = passed([x[:3 * H] for x in window], "f")
        backward = passed([x[3 * H:] for x in window[::-1]], "b")[::-1]
        states = [a + b for a, b in zip(forward, backward)]
        asked = [math.exp(sum(a * b for a, b in zip(s, d["ask"]))) for s in states]
        pooled = [sum(w * s[j] for w, s in zip(asked, states)) / sum(asked) for j in range(2 * H)]
        worst = max(worst, sum(a * b for a, b in zip(pooled, d["out"])) + d["base"][0])
        count += 1
        if begin + toxicity.WINDOW >= len(of):
            break
        begin += toxicity.STRIDE
    level = math.floor(math.log2(count))
    return sig(net.scale * (worst - net.slope * level - net.middle) + math.log(toxicity.THRESHOLD / (1 - toxicity.THRESHOLD)))


def test_toxicity_scores_are_the_plain_recurrence():
    rng = np.random.default_rng(5)
    size = 1 << toxicity.BITS
    net = toxicity.Network.new(rng.standard_normal(size).astype(np.float32), rng.standard_normal(size).astype(np.float32), rng)
    net.scale, net.middle, net.slope = 1.3, 0.2, 0.1
    rnd = random.Random(1)
    vocab = ["you", "fool", "kind", "é", "x1", "a", "wordy"]
    texts = ["", " .", "You", "you FOOL", *[" ".join(rnd.choices(vocab, k=n)) for n in (
        toxicity.WINDOW - 1, toxicity.WINDOW, toxicity.WINDOW + 1, 2 * toxicity.WINDOW + 5)]]
    got = net.scores(pa.array([*texts, None]))
    assert np.allclose(got, [*[plain_toxicity(net, t) for t in texts], 0.0], atol=2e-5)


def test_toxicity_query_edges(spark):
    texts, labels = toxic_texts(240, 5)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(900, None, "x"), (901, "", "x"), (None, "he he", "x")],
                                 "doc_id long, text string, score string")
    marks = spark.createDataFrame([(i, int(x)) for i, x in enumerate(labels)] + [(0, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    net, share = toxicity.fit(docs, marks)
    got = toxicity.score(docs, net, share).collect()
    assert len(got) == 243 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    none, share = toxicity.fit(docs, marks.where("toxic = 0"))
    assert none is None and share == 0 and toxicity.score(docs, none, share).agg(F.max("score")).first()[0] == 0
    assert toxicity.score(docs.where("false"), net, share).collect() == []


def test_raking_meets_its_targets(spark):
    rng = np.random.default_rng(0)
    cells = spark.createDataFrame([(f"s{a}", f"l{b}", f"t{c}", int(rng.integers(50, 5000)))
                                   for a in range(4) for b in range(3) for c in range(2)],
                                  "source string, lang string, topic string, tokens long")
    targets = {d: raking.tempered(cells, d, 0.5) for d in raking.DIMS}
    done = raking.rake(cells, targets, 25)
    total = cells.agg(F.sum("tokens")).first()[0]
    for d, t in targets.items():
        got = {r[0]: r[1] / total for r in done.groupBy(d).agg(F.sum("raked")).collect()}
        assert all(math.isclose(got[r[0]], r.share, rel_tol=1e-6) for r in t.collect())
    fit = raking.calibrated(done, 0.8)
    expected = fit.agg(F.sum(F.col("tokens") * F.col("probability")), F.max("probability")).first()
    assert math.isclose(expected[0], 0.8 * total, rel_tol=1e-9) and expected[1] <= 1


def test_mix_edges(spark):
    rows = [(1, "a | b", "en", "s"), (1, "a | b", "en", "s"), (None, None, None, None), (3, "", "de", "s"), (4, "x@y https://z", "en", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("topic", F.lit("clash"))
    got = raking.mix(raking.described(docs)).collect()
    assert len(got) == 5 and {r.topic for r in got} == {"tabular", "prose", "contact"}
    assert all(0 <= r.probability <= 1 for r in got)
    assert raking.mix(raking.described(docs.where("false"))).collect() == []


def test_nearest_recall_and_edges(spark):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((1500, 24)) * rng.uniform(0.2, 3, (1500, 1))
    x[100:400] = x[100] + 0.01 * rng.standard_normal((300, 24))  # near copies
    x[400:500] = x[400]  # equal ones
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(5000, None), (5020, [0.0] * 24), (5040, [float("nan")] * 24), (5060, [1.0, None] * 12), (5080, [1.0] * 3), (None, [1.0] * 24),
           (0, x[0].tolist())]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1))
    got = {}
    for r in lsh_forest.nearest(df, F.col("id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(range(0, 1500, 20))
    hit = 0
    for q, found in got.items():
        score = x @ x[q]
        want = [i for i in np.lexsort((np.arange(1500), -score)) if i != q][:20]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert all(math.isclose(f[2], score[f[1]], rel_tol=1e-12) for f in found)
        assert [f[1] for f in found] == [f[1] for f in sorted(found, key=lambda f: (-f[2], f[1]))]
        hit += len({f[1] for f in found} & set(want))
    assert hit / (20 * len(got)) >= 0.9
    few = lsh_forest.nearest(df.where("vec_id < 3"), F.col("id") == 0).collect()
    assert [r.vec_id for r in sorted(few, key=lambda r: r["rank"])] == sorted([1, 2], key=lambda i: -(x[i] @ x[0]))


@pytest.fixture(scope="module")
def page_model(spark):
    return dom_model.fit(spark.read.parquet(f"{SMOKE}/pages.parquet"))


def test_pages_main_text(spark, page_model):
    rows = spark.read.parquet(f"{SMOKE}/pages.parquet").collect()
    import html
    for r in rows:
        inside = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", " ", b))).strip() for b in re.split(r"</?(?:p|h1)>", inside)]
        assert page_model.extract(r.html) == "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("html,lines", [
    ("<p>x <math><mi>E</mi><mo>=</mo><mi>mc</mi></math> y</p>", ["x E=mc y"]),
    ("<p>a <my-word>b</my-word> <nobr>c</nobr><picture><img></picture> d</p>", ["a b c d"]),
    ("<p>a<svg><title>t</title><text>label</text></svg> b<script>var p='<p>';</script> c<button>ok</button> d</p>", ["a b c d"]),
    ("<p>a<template><p>never</p><div>no</div></template> b</p><p>c</p>", ["a b", "c"]),
    ("<p>a<div>b<p>c<ul><li>d<li>e</ul>f", ["a", "b", "c", "d", "e", "f"]),
    ("<table><tr><td>1<td>2<tr><td><p>3</table>4", ["1", "2", "3", "4"]),
    ("<p>a <span hidden>b</span> c</p><div hidden><p>d</p></div>", ["a b c", "d"]),
    ("<div>a<button>never closed</div>b<select><option>x</select> c</p>d", ["a", "b c", "d"]),
    ("<head><title>t</title><style>p{}</style><body>a<br>b<hr>c", ["a b", "c"]),
    ("a</div></p>b<custom-card><p>c</p></custom-card>", ["a", "b", "c"])])
def test_page_blocks(html, lines):
    assert [text for _, text in dom_model.Page(html).blocks] == lines


@pytest.mark.parametrize("shape", ["<div>" * 8000 + "x</b></i>" * 8000, "<blockquote>" * 8000 + "x" + "</blockquote>" * 8000,
                                   "<p><li>" + "<blockquote>x</p>" * 8000, "<ul><li>" * 8000 + "x" + "</section>" * 8000])
def test_page_time_is_linear_in_depth(shape):
    started = time.perf_counter()
    page = dom_model.Page(shape)
    assert len(page.nodes) > 8000 and time.perf_counter() - started < 2


def test_page_beliefs_are_brute_force():
    page = dom_model.Page("<div><p>a</p><ul><li>b<li>c</ul></div><footer>d</footer>")
    n, rng = len(page.nodes), np.random.default_rng(1)
    unary, pair = rng.standard_normal(n), rng.standard_normal((2, 2))
    weight, total = np.zeros(n), 0.0
    for code in range(1 << n):
        y = [(code >> i) & 1 for i in range(n)]
        p = math.exp(sum(u for u, v in zip(unary, y) if v) + sum(pair[y[x.parent], y[i]] for i, x in enumerate(page.nodes) if i))
        total += p
        weight += p * np.array(y)
    assert np.allclose(dom_model.beliefs(page, unary, pair)[0], weight / total)


def test_page_edges(spark, page_model):
    t = "A sentence that is long enough to be read, and a second one. It goes on for a while, and then it ends."
    page = (f"<body><nav><a href='/'>Home</a></nav><article><h1>T &amp; U</h1><p>{t}\n  <b>bold</b>&nbsp;x<p>{t}<script>var a='</p>';</script>"
            f"<p style='display:none'>hidden</p><p>{t}</p></article><div id='comments'><p>{t}</p></div><footer>F</footer></body>")
    got = page_model.extract(page)
    assert got.split("\n") == ["T & U", f"{t} bold x", t, t]
    assert page_model.extract(None) == page_model.extract("") == page_model.extract("<div>") == ""
    df = spark.createDataFrame([(1, "u", page, "x"), (None, None, None, None), (1, "u", page, "x")],
                               "page_id long, url string, html string, text string")
    rows = dom_model.extract(df, page_model).collect()
    assert sorted(r.n_chars for r in rows) == [0, len(got), len(got)]


def test_near_copies_of_repeated_and_missing_ids(spark):
    import corpus_pipeline as cp

    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(1, a, "s"), (1, b, "s"), (2, a + " more", "s"), (3, b + " more", "s"), (3, c, "s"), (4, c, "s"), (4, c, "s"),
            (None, a, "s"), (None, d, "t"), (None, d, "s"), (5, "", "s"), (5, "", "s"), (6, "", "s"), (None, None, "s"), (None, None, "s")]
    for n in (1, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(n)
        got = [tuple(r) for r in cp.drop_near_copies(spark, docs, "").collect()]
        want = [(1, a, "s"), (1, b, "s"), (3, c, "s"), (None, d, "s"), (5, "", "s"), (6, "", "s"), (None, None, "s")]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_stages_keep_the_documents_own_columns(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").withColumns(
        {"score": F.lit("mine"), "Predicted": F.lit(7), "n_words": F.lit(-1), "contaminated": F.lit("own")})
    for stage in (cp.drop_toxic, cp.drop_contaminated):
        kept = stage(spark, docs, SMOKE)
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
        assert {tuple(r) for r in kept.select("score", "Predicted", "n_words", "contaminated").collect()} == {("mine", 7, -1, "own")}


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    from recordsync.llm import jaccard_join
    rows = docs
    for name, stage in cp.STAGES[:-1]:
        kept = stage(spark, rows, SMOKE)
        assert kept.columns == docs.columns
        before, after = {r.doc_id for r in rows.collect()}, {r.doc_id for r in kept.collect()}
        assert after <= before and len(after) > len(before) / 2, name
        if name == "near_copies":
            part = {r.doc_id: r.component_id for r in jaccard_join.join(rows, k=5, ratio=(80, 100)).collect()}
            assert after == set(part.values())
        if name == "decontamination":
            bench = spark.read.parquet(f"{SMOKE}/benchmark.parquet")
            assert after == {r.doc_id for r in winnowing.decontaminate(rows, bench).where("n_hit = 0").collect()}
        rows = spark.createDataFrame(kept.collect(), docs.schema)
    placed = cp.STAGES[-1][1](spark, rows, SMOKE)
    assert placed.count() == rows.count() and {"slot", "shard_id"} <= set(placed.columns)


def test_pipeline_run_is_brute_force(spark, tmp_path):
    """run() over planted copies, benchmark passages and toxic texts against plain Python (with the network's scores)
    and the SQL of mixing and sharding."""
    import corpus_pipeline as cp
    import duckdb
    from recordsync.llm import maglev

    texts, labels = toxic_texts(240, 11)
    rng = np.random.default_rng(12)
    passages = [" ".join(f"q{i}w{j}" for j in range(14)) for i in range(3)]
    clean = [t for t, x in zip(texts, labels) if not x]
    near = [t + " tail" for t in clean[:25]] + clean[25:35]
    leaks = [f"{clean[40 + i]} {passages[i % 3][: 40 + 10 * i]} end{i}" for i in range(9)]
    rows = [(i, t, str(rng.choice(["en", "de"])), str(rng.choice(["web", "book", "wiki"]))) for i, t in enumerate(texts + near + leaks)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(labels[i])) for i in range(240)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(passages)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    net, _ = toxicity.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    scores = net.scores(pa.array([r[1] for r in rows]))
    left = [r for r, s in zip(rows, scores) if s < toxicity.THRESHOLD]
    assert 100 < len(left) < len(rows) - 40

    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
    sets, group = [shingles(r[1]) for r in left], list(range(len(left)))
    for i in range(len(left)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and group[i] != group[j]:
                a, b = sorted((group[i], group[j]))
                group = [a if g == b else g for g in group]
    kept = [r for i, r in enumerate(left) if group[i] == i]
    assert len(kept) < len(left)

    def tens(t):
        w = t.split()
        return {tuple(w[i:i + 10]) for i in range(len(w) - 9)}
    asked = set().union(*map(tens, passages))
    pure = [r for r in kept if not tens(r[1]) & asked]
    assert 0 < len(kept) - len(pure) <= 9

    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", pure)
    mixed = {r[0] for r in con.execute(f"SELECT doc_id FROM ({raking.op5_sql()}) WHERE selected").fetchall()}
    slots = {r[0]: r[1:] for r in con.execute(f"SELECT doc_id, slot, shard_id FROM ({maglev.op7_sql()})").fetchall()}
    want = sorted((*r, *slots[r[0]]) for r in pure if r[0] in mixed)
    got = sorted(tuple(r) for r in cp.run(spark, str(tmp_path)).select("doc_id", "text", "lang", "source", "slot", "shard_id").collect())
    assert got == want and want


def test_driver_is_tidied_before_each_table(spark, monkeypatch):
    """The plans, broadcasts and generated classes of earlier steps are dropped before each table, not every fourth one."""
    from recordsync.llm import common
    times = []
    monkeypatch.setattr(common, "release", lambda s: times.append(s))
    for n in range(3):
        assert common.written(spark.range(n)).count() == n
    assert len(times) == 3
