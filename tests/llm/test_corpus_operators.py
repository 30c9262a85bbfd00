"""Classifier, Jaccard join, mixing, Brown classes and the pipeline against brute force."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_text_operators import NASTY, WORD, frame

import corpus_pipeline
from tsforge.llm import brown, jaccard, mixing, pu_classifier, queries
from tsforge.llm.components import components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def nasty(spark):
    queries.prepare(spark)
    return frame(spark, NASTY)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [], 1)


# ---- classifier -------------------------------------------------------------------------------------

def auc(pos, neg):
    return np.mean([(p > neg).mean() + 0.5 * (p == neg).mean() for p in pos])


def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.registered()["op4_pu_classifier"](spark, sf).toPandas()
    lab = pd.read_parquet(f"{sf}/labels.parquet")
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id]).all()
    assert out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.3)).all()
    m = out[out.held_out].merge(lab, on="doc_id")
    assert auc(m[m.quality == 1].score.to_numpy(), m[m.quality == 0].score.to_numpy()) > 0.97
    assert (m.predicted == m.quality).mean() > 0.93


def test_nn_risk_recovers_the_prior_and_ignores_negative_labels():
    rnd = np.random.default_rng(0)

    def texts(n, bad):
        return [" ".join(rnd.choice(["spam%%%", "buy$$$", "x"] if bad else ["alpha", "beta", "gamma", "x"], 60)) for _ in range(n)]
    pos, unl = pu_classifier.Rows(texts(300, False)), pu_classifier.Rows(texts(420, False) + texts(180, True))
    model, prior = pu_classifier.fit(pos, unl)
    assert 0.5 < prior < 0.75
    good, bad = model.margin(pu_classifier.Rows(texts(50, False))), model.margin(pu_classifier.Rows(texts(50, True)))
    assert (good > 0).mean() > 0.95 and (bad < 0).mean() > 0.95


def test_classifier_nasty(spark, nasty, empty):
    none = spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int")
    assert pu_classifier.learn(nasty, none, queries.fifth) is None
    s = pu_classifier.score(nasty, None)
    assert s.count() == len(NASTY) and {r["score"] for r in s.collect()} == {0.5}
    some = spark.createDataFrame([(i, 1, 0) for i in range(1, 30)], "doc_id long, quality int, toxic int")
    model = pu_classifier.learn(nasty, some, queries.fifth)
    rows = pu_classifier.score(nasty, model).collect()
    assert len(rows) == len(NASTY) and all(0 <= r["score"] <= 1 for r in rows)
    assert pu_classifier.score(empty, model).count() == 0 and pu_classifier.learn(empty, some, queries.fifth) is None
    assert pu_classifier.with_score(nasty, model).columns == [*nasty.columns, "pu_score"]


# ---- Jaccard join ------------------------------------------------------------------------------------

def brute_components(rows):
    """doc -> (set size, smallest id reachable); rows (id, text), ids unique."""
    sets = {}
    for i, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    par = {i: i for i in sets}

    def root(x):
        while par[x] != x:
            x = par[x]
        return x
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            k = len(sets[a] & sets[b])
            if sets[a] and 100 * k >= 75 * (len(sets[a]) + len(sets[b]) - k) and root(a) != root(b):
                lo, hi = sorted((root(a), root(b)))
                par[hi] = lo
    return {i: (len(s), root(i)) for i, s in sets.items()}


def near_copies(n=260, seed=2):
    rnd = np.random.default_rng(seed)
    vocab = [f"v{i}" for i in range(400)]
    base = [list(rnd.choice(vocab, k)) for k in (60, 61, 200, 8, 5, 30)]
    passage = list(rnd.choice(vocab, 70))
    rows = []
    for i in range(n):
        w = list(base[rnd.integers(0, len(base))])
        for _ in range(int(rnd.integers(0, 1 + len(w) // 12))):
            w[int(rnd.integers(0, len(w)))] = str(rnd.choice(vocab))
        if i % 7 == 0:
            w = w[: len(w) - int(rnd.integers(0, 1 + len(w) // 6))]
        if i % 5 == 0:
            w = list(rnd.choice(vocab, 25)) + passage
        rows.append((i, " ".join(w).upper() if i % 11 == 0 else " ".join(w)))
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n "), (n + 3, "two words"), (n + 4, "TWO  words"), (n + 5, "two words more")]


@pytest.mark.parametrize("tile, sample", [(1024, 32), (8, 1)])
def test_jaccard_components(spark, empty, monkeypatch, tile, sample):
    queries.prepare(spark)
    monkeypatch.setattr(jaccard, "HOT_SAMPLE", sample)
    monkeypatch.setattr(jaccard, "TILE", tile)
    if tile == 8:
        monkeypatch.setattr(jaccard, "BROADCAST_ROWS", -1)
        small = jaccard._tiles  # tasks import the module afresh, so the tile size travels by value

        def tiles(it, t=tile):
            jaccard.TILE = t
            yield from small(it)
        monkeypatch.setattr(jaccard, "_tiles", tiles)
    rows = near_copies()
    want = brute_components(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(frame(spark, rows)).collect()}
    assert got == want
    if tile == 8:
        assert jaccard.jaccard_components(empty).count() == 0


def test_jaccard_nasty_rows(spark, nasty):
    got = jaccard.jaccard_components(nasty).collect()
    assert len(got) == len(NASTY)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"]))
    assert by[6] == [(1, 6), (1, 6)] and by[7] == [(1, 6)] and by[8] == [(1, 6)]
    assert by[1] == [(0, 1)] and by[2] == [(0, 2)] and by[3] == [(0, 3)]
    assert by[None] == [(1, None), (1, None)]


def test_bitmaps_bound_the_overlap():
    rnd = np.random.default_rng(4)
    for _ in range(60):
        a = np.unique(rnd.integers(0, 1 << 62, rnd.integers(1, 900)).astype(np.uint64))
        b = np.unique(np.concatenate([rnd.choice(a, rnd.integers(0, len(a) + 1), False), rnd.integers(0, 1 << 62, rnd.integers(1, 300)).astype(np.uint64)]))
        d = jaccard._differ([jaccard.bitmap(a).tobytes(), jaccard.bitmap(b).tobytes()], np.array([0]), np.array([1]))[0]
        assert d <= len(np.setxor1d(a, b))
        k = len(np.intersect1d(a, b))
        if 100 * k >= 75 * (len(a) + len(b) - k):
            assert jaccard._may_link(np.array([len(a)]), np.array([len(b)]), np.array([d]), 75)[0]


def test_prefix_size():
    for n in range(1, 400):
        assert jaccard._prefix_size(n, 75) == n - math.ceil(0.75 * n) + 1 + n // 40


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (102, 100), (200, 200), (300, 299)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100, 102: 100, 299: 299, 300: 299}


# ---- mixing -----------------------------------------------------------------------------------------------

def test_period_keeps_every_share_within_a_block():
    rnd = np.random.default_rng(6)
    for _ in range(40):
        parts = mixing.apportion(list(rnd.random(rnd.integers(1, 12)) ** 3 + 1e-3), 200)
        assert sum(parts) == 200 and min(parts) >= 1
        order, done = mixing.period(parts), np.zeros(len(parts))
        for t, i in enumerate(order, 1):
            done[i] += 1
            assert (np.abs(done - t * np.array(parts) / 200) < 1).all()
        assert done.tolist() == parts


def test_mix(spark, nasty, empty):
    queries.prepare(spark)
    rows = [(i, "x", s) for i, s in enumerate(["a"] * 333 + ["b"] * 150 + ["c"] * 40 + [None] * 17)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("mix_slot", F.lit("old"))
    out = mixing.mix(docs, {"a": 0.2, "b": 0.5, "c": 0.2}, block_rows=4, grain=100).toPandas()
    assert sorted(out.doc_id) == list(range(540)) and out.columns.tolist()[:3] == ["doc_id", "text", "source"]
    slots = out.groupby("mix_slot").agg(src=("source", lambda s: s.fillna("-").nunique()), n=("doc_id", "size"), ph=("mix_phase", "first"))
    assert (slots.src == 1).all() and slots.index.tolist() == list(range(len(slots))) and slots.n.max() == 4
    one = out[out.mix_phase == 0].drop_duplicates("mix_slot").sort_values("mix_slot")
    w = {"a": 0.2, "b": 0.5, "c": 0.2, None: 0.1}
    done = Counter()
    for t, s in enumerate(one.source.where(one.source.notna(), None), 1):
        done[s] += 1
        assert all(abs(done[k] - v * t) < 1 for k, v in w.items())
    first = one.mix_slot.min()
    assert (one.mix_slot - first >= one.mix_release).all() and (one.mix_slot - first < one.mix_deadline).all()
    assert mixing.mix(nasty).count() == len(NASTY) and mixing.mix(empty).count() == 0
    again = mixing.mix(docs.repartition(7), {"a": 0.2, "b": 0.5, "c": 0.2}, block_rows=4, grain=100).toPandas()
    key = ["doc_id", "mix_slot", "mix_pos"]
    assert out[key].sort_values("doc_id").to_numpy().tolist() == again[key].sort_values("doc_id").to_numpy().tolist()


def test_schedule_stays_within_a_block_of_the_exact_weights():
    rows = [333_333] + [35_087] * 10 + [35_087 + 997 * k for k in range(9)]
    for share in ([float(n) ** 0.5 for n in rows], [0.6999, 0.3, 0.0001]):
        w = np.array(share) / sum(share)
        made = mixing.schedule([math.ceil(n / 16) for n in rows[:len(w)]], mixing.exact_parts(share))
        one = made[made[:, 2] == 0, 0]
        assert len(one) > 7_000
        done = np.cumsum(one[:, None] == np.arange(len(w)), axis=0)
        assert np.abs(done - np.arange(1, len(one) + 1)[:, None] * w).max() < 1 + 1e-6


def test_mix_takes_any_number_of_sources(spark):
    queries.prepare(spark)
    docs = spark.range(3_000).selectExpr("id AS doc_id", "concat('s', id % 700) AS source")
    out = mixing.mix(docs, block_rows=2).toPandas()
    assert sorted(out.doc_id) == list(range(3_000))
    slots = out.groupby("mix_slot").source.nunique()
    assert (slots == 1).all() and slots.index.tolist() == list(range(len(slots)))


# ---- Brown classes -----------------------------------------------------------------------------------------

def brute_unigrams(rows, held):
    toks = [WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) + [None] for _, t in rows]
    c = Counter(w for ws, h in zip(toks, held, strict=True) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return n, [(len(ws), sum(c[w] > 0 for w in ws), sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for ws in toks]


def test_brown_scores(spark, nasty, empty):
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i, _ in NASTY]
    n, want = brute_unigrams(NASTY, held)
    got = brown.score_texts(nasty, queries.seventh, top_words=40, classes=4, rounds=2).collect()
    key = sorted((i if i is not None else -1, *w[:2], round(w[2], 6)) for (i, _), w in zip(NASTY, want, strict=True))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == key
    assert {r["train_tokens"] for r in got} == {n} and all(r["score"] < 0 for r in got)
    assert brown.score_texts(empty, queries.seventh).count() == 0


def test_brown_beats_unigrams_on_held_out_text(spark):
    out = queries.registered()["op9_brown"](spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > out[1]


def test_move_gain_is_the_change_in_likelihood():
    rnd = np.random.default_rng(8)
    words, nc, first = 12, 6, 2
    big = rnd.integers(0, 6, (words, words)).astype(float)
    cls = np.concatenate([[0, 1], rnd.integers(2, 6, words - 2)])

    def matrix(cls):
        m = np.zeros((nc, nc))
        np.add.at(m, (cls[:, None], cls[None, :]), big)
        return m
    m = matrix(cls)
    for w in range(2, words):
        other = np.arange(words) != w
        out = np.bincount(cls[other], big[w, other], nc)
        into = np.bincount(cls[other], big[other, w], nc)
        gains = brown.move_gains(m, int(cls[w]), out, into, big[w, w], first)
        for b in range(first, nc):
            moved = cls.copy()
            moved[w] = b
            assert gains[b - first] - gains[cls[w] - first] == pytest.approx(brown.likelihood(matrix(moved)) - brown.likelihood(m), abs=1e-8)


def test_gains_of_many_words_equal_those_of_each():
    rnd = np.random.default_rng(9)
    words, nc, first = 40, 9, 3
    big = rnd.integers(0, 3, (words, words)) * (rnd.random((words, words)) < 0.3).astype(float)
    cls = np.concatenate([[0, 1, 2], rnd.integers(first, nc, words - 3)])
    m = np.zeros((nc, nc))
    np.add.at(m, (cls[:, None], cls[None, :]), big)
    ids = np.arange(3, words)
    other = [np.arange(words) != w for w in ids]
    out = np.array([np.bincount(cls[o], big[w, o], nc) for w, o in zip(ids, other, strict=True)])
    into = np.array([np.bincount(cls[o], big[o, w], nc) for w, o in zip(ids, other, strict=True)])
    every = np.tile(np.arange(first, nc), (len(ids), 1))
    got = brown.gains_of(m, cls[ids], out, into, big[ids, ids], every)
    want = [brown.move_gains(m, int(cls[w]), o, i, big[w, w], first) for w, o, i in zip(ids, out, into, strict=True)]
    assert np.allclose(got, want, atol=1e-8)
    short = brown.shortlist(m, cls[ids], out, into, first, 4)
    assert all(len(set(t)) == 4 and c in t for t, c in zip(short.tolist(), cls[ids], strict=True))
    rows = np.arange(len(ids))[:, None]
    assert np.allclose(brown.gains_of(m, cls[ids], out, into, big[ids, ids], short), np.array(want)[rows, short - first], atol=1e-8)
    assert (np.array(want)[rows, short - first].max(1) >= np.sort(want, axis=1)[:, -2] - 1e-9).mean() > 0.8  # the best is mostly among them


def test_brown_clusters_every_word_above_the_floor(spark):
    queries.prepare(spark)
    rnd = np.random.default_rng(10)
    # 5,000 words of 12 tokens and one ending; the a follow rare words in "one", the b rare words in "two"
    left, right = [rnd.permutation([f"{side}{i:04d}x" for i in range(2_500)] * 12) for side in "ab"]
    words = [w for k, (x, y) in enumerate(zip(left, right, strict=True)) for w in (f"{k}one", x, f"{k}two", y)]
    rows = [(i, " ".join(words[i * 300:i * 300 + 300])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    chunks = brown.chunked(brown.reuse_input(docs), "doc_id", "text", lambda c: F.col(c) < 0)
    vocab, base = brown.numbered(brown.count_words(chunks), 10)
    words = vocab.where("lead").select("word", "c", "id").collect()
    assert all((r["id"] is not None) == (r["c"] >= 10) for r in words)
    ids = [r["id"] for r in words if r["id"] is not None]
    assert len(ids) == 5_000 and len(set(ids)) == len(ids) and 2 <= min(ids) and max(ids) == base - 1
    model = brown.train(chunks, vocab, base, classes=2)
    side = Counter((bytes(r["word"])[:1], int(model.cls[r["id"]])) for r in words if r["id"] is not None)
    assert max(side[b"a", k] + side[b"b", j] for k, j in ((66, 67), (67, 66))) > 0.95 * len(ids)


def test_brown_model_sums_to_one():
    m = np.array([[0, 0, 0, 0], [1, 0, 4, 2], [3, 0, 2, 5], [2, 0, 6, 1.0]])
    cls = np.array([0, 1, 3, 3])
    model = brown.Model({b"p": 2, b"q": 3}, cls, m, np.array([6.0, 2.0]), np.zeros(brown.OPEN), np.zeros(brown.OPEN), 8, 2, 1)
    assert np.allclose((10 ** model.log_step).sum(1), 1) and np.isclose((10 ** model.log_word).sum(), 1)


# ---- the pipeline -----------------------------------------------------------------------------------------

def test_pipeline_stages(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols = docs.columns
    text = {r["doc_id"]: r["text"] for r in docs.collect()}

    good = stages["quality_classifier"](spark, docs, SF)
    assert good.columns == cols
    good.write.mode("overwrite").parquet(base := queries.dedup.shared_dir(spark, "pipe-test"))
    good = spark.read.parquet(base)
    lab = pd.read_parquet(f"{SF}/labels.parquet").set_index("doc_id").quality
    kept = {r["doc_id"] for r in good.collect()}
    judged = [(i in kept) == bool(q) for i, q in lab.items() if i in text]
    assert np.mean(judged) > 0.95

    once = stages["exact_dedup"](spark, good, SF)
    assert once.columns == cols
    first = {}
    for i in sorted(kept):
        first.setdefault(re.sub("[\x20\x09-\x0D]+", " ", text[i]), i)
    assert sorted(r["doc_id"] for r in once.collect()) == sorted(first.values())

    apart = stages["jaccard_join"](spark, once, SF)
    want = brute_components([(i, text[i]) for i in first.values()])
    assert apart.columns == cols and sorted(r["doc_id"] for r in apart.collect()) == sorted({c for _, c in want.values()})

    mixed = stages["mix_sources"](spark, apart, SF)
    assert mixed.columns == cols and sorted(r["doc_id"] for r in mixed.collect()) == sorted({c for _, c in want.values()})
    assert {r["doc_id"] for r in stages["packing"](spark, mixed, SF).collect()} == {c for _, c in want.values()}


def test_pipeline_run_and_repeats(spark, nasty):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"] and out.count() > 0
    stages = dict(corpus_pipeline.STAGES)
    once = stages["exact_dedup"](spark, nasty, SF)
    assert once.columns == nasty.columns
    assert once.count() == len({re.sub("[\x20\x09-\x0D]+", " ", t or "") for _, t in NASTY})
    assert stages["jaccard_join"](spark, once, SF).count() <= once.count()
    assert stages["mix_sources"](spark, once, SF).count() == once.count()
