"""Special tokens, access to stored codes, the classifier's risk, near copies by row, terms that disclose."""

import math
import os
import types
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_corpus_operators import brute_components
from tests.llm.test_text_operators import NASTY, frame
from tsforge.llm import brown, dac, dedup, jaccard, packing, pii, pu_classifier, queries
from tsforge.llm.tokens import PieceEncoder


@pytest.fixture(scope="module")
def nasty(spark):
    queries.prepare(spark)
    return frame(spark, NASTY)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [], 1)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_with_special_tokens_equal_the_librarys(name):
    from tokenizers import Tokenizer
    t, e = Tokenizer.from_file(queries.tokenizer(name)), PieceEncoder(queries.tokenizer(name), special=True)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|startoftext|>y z", "<|ENDOFTEXT|> <| |>", "plain words", "", "a  <|endoftext|>\n\n b"]
    ids, at = e.encode(pa.array(texts * 2), 7)
    for i, x in enumerate(texts * 2):
        assert ids[at[i]:at[i + 1]].tolist() == t.encode(x, add_special_tokens=False).ids + [7], x


def test_stored_codes_are_read_where_asked(spark, nasty):
    made = dac.write_codes(nasty, queries.tokenizer("byte_bpe_50k.json"), 0, segment_ids=3_000).collect()
    for row in made:
        f = dac.CodeFile(row["path"])
        whole = [f.segment(k) for k in range(len(f.dir))]
        ids = np.concatenate([r.span(0, r.n) for r in whole])
        pos = np.random.default_rng(1).integers(0, len(ids), 400)
        read, counted = f.f, []

        class Spy:
            def read_at(self, n, at):
                counted.append(n)
                return read.read_at(n, at)
        f.f = Spy()
        assert np.array_equal(f.get(pos), ids[pos].astype(np.uint64))
        counted.clear()
        assert f.get([int(pos[0])])[0] == ids[pos[0]] and sum(counted) < 400  # bytes read for one id
        docs = [(int(d), r.document(i).tolist()) for r in whole for i, d in enumerate(np.asarray(r.doc_ids))]
        assert [(d, x.tolist()) for d, x in (f.document(i) for i in range(len(docs)))] == docs


def test_temporary_index_is_deleted_and_a_named_one_stays(spark, nasty, tmp_path):
    before = {t.name for t in spark.catalog.listTables() if t.name.startswith("digest_index")}
    n = dedup.exact_dedup(nasty).count()
    assert n == len(NASTY) and {t.name for t in spark.catalog.listTables() if t.name.startswith("digest_index")} == before
    path = f"file://{tmp_path}/index"
    for _ in range(2):
        assert dedup.exact_dedup(nasty, path=path).count() == n
    assert dedup.DigestIndex(spark, path).plain().count() == dedup.digests(nasty).select("digest").distinct().count()


# ---- classifier --------------------------------------------------------------------------------------

def test_risk_is_the_formula_and_its_gradient():
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choice(words, rng.integers(1, 40))) for _ in range(60)]
    pos, unl = pu_classifier.Rows(texts[:20]), pu_classifier.Rows(texts[20:])
    model = pu_classifier.Model(unl.dense.mean(0), unl.dense.std(0) + 1e-6)
    for prior in (0.3, 1.5):  # the second (no share) puts the part of the negatives below zero
        model.w = 0.3 * rng.standard_normal(len(model.w))
        gp, gu = model.margin(pos), model.margin(unl)

        def loss(z):
            return math.log1p(math.exp(-z))
        plus = prior * np.mean([loss(z) for z in gp])
        minus = np.mean([loss(-z) for z in gu]) - prior * np.mean([loss(-z) for z in gp])
        value, grad = pu_classifier.risk(model, pos, unl, prior)
        assert value == pytest.approx(plus + max(0.0, minus)) and (minus < 0) == (prior > 1)
        w = model.w.copy()

        def part(w, negative):
            model.w = w
            a = prior * np.logaddexp(0, -model.margin(pos)).mean()
            b = np.logaddexp(0, model.margin(unl)).mean() - prior * np.logaddexp(0, model.margin(pos)).mean()
            return -b if negative else a + b
        for k in rng.choice(np.flatnonzero(grad), 25, False):
            up, down = w.copy(), w.copy()
            up[k] += 1e-6
            down[k] -= 1e-6
            assert (part(up, minus < 0) - part(down, minus < 0)) / 2e-6 == pytest.approx(grad[k], abs=1e-6)
        model.w = w


def test_moments_cover_all_texts(spark, nasty, empty):
    mean, std = pu_classifier.moments(nasty)
    x = np.array([pu_classifier.features(t or "")[0] for _, t in NASTY])
    assert np.allclose(mean, x.mean(0)) and np.allclose(std, x.std(0) + 1e-6, atol=1e-5)
    assert pu_classifier.moments(empty) is None


# ---- near copies by row ---------------------------------------------------------------------------------

def test_one_row_of_each_component_stays(spark):
    rng = np.random.default_rng(2)
    base = " ".join(rng.choice([f"v{i}" for i in range(300)], 80))
    rows = [(1, base), (2, base + " x"), (2, "another text that shares the id of a near copy"), (3, "so does this one, which is alone"),
            (None, base + " y"), (None, "a text without an id and without copies"), (4, ""), (5, None), (None, base + " z"), (3, base.upper() + " q")]
    kept = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in jaccard.one_of_each(frame(spark, rows)).collect()), key=str)
    want = [r for r in rows if not (r[1] or "").lower().startswith(base) or r[0] == 1]
    assert kept == sorted(((i is None, i or 0, t) for i, t in want), key=str)


def test_groups_in_many_tiles_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP", 8)
    monkeypatch.setattr(jaccard, "SMALL", 3)
    rng = np.random.default_rng(5)
    vocab = [f"v{i}" for i in range(200)]
    base, rows = list(rng.choice(vocab, 60)), []
    for i in range(240):  # one dense group: some pairs link, most nearly do
        w = list(base)
        for _ in range(int(rng.integers(0, 3))):
            w[int(rng.integers(0, 60))] = str(rng.choice(vocab))
        rows.append((i, " ".join(w[: 60 - int(rng.integers(0, 14))])))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(frame(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_names_of_classes_are_the_same_in_tasks_and_in_sql(spark):
    from xxhash import xxh3_64_intdigest
    raw = [bytes([i]) * 8 for i in range(40)]
    rows = [(xxh3_64_intdigest(x) - (1 << 63), xxh3_64_intdigest(x, seed=1) - (1 << 63)) for x in raw]
    df = spark.createDataFrame(rows, "cls long, cls2 long")
    for turn in (0, 9, 63):
        got = [r[0] for r in df.coalesce(1).select(jaccard._renamed(turn)).collect()]
        assert sorted(got) == sorted(jaccard._class_name(turn)(x) for x in raw)
    # sets that share the first hash part under the next name
    two = spark.createDataFrame([(5, 1), (5, 2)], "cls long, cls2 long").select(jaccard._renamed(9).alias("c"))
    assert two.distinct().count() == 2


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_empty_and_nasty_rows(spark, nasty, empty, name, tmp_path):
    stage, sf = dict(corpus_pipeline.STAGES)[name], str(tmp_path)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 30)], "doc_id long, quality int, toxic int")
    labels.write.parquet(os.path.join(sf, "labels.parquet"))
    assert stage(spark, empty, sf).count() == 0
    out = stage(spark, nasty, sf)
    if name == "packing":
        assert {r["doc_id"] for r in out.collect()} == {i for i, _ in NASTY}
    else:
        assert out.columns == nasty.columns and 0 < out.count() <= len(NASTY)


# ---- terms that disclose -----------------------------------------------------------------------------------

def brute_terms(rows, alpha=0.9, support=2):
    """(doc, term, start) of the spans that are added, by definition."""
    fold = lambda t: t.encode("utf-8", "surrogatepass").translate(pii._FOLD)
    docs = [(i, t or "", {x for x in fold(t or "").split() if len(x) >= 3}, pii.base_spans(t or "")) for i, t in rows]
    ents = [{x for k, a, b in s for x in (f"{k}:{t[a:b].lower()}", *pii.parts_of(k, t[a:b]))} for _, t, _, s in docs]
    n, c_t, c_e, c_et, te, tet = len(docs), defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(set), defaultdict(set)
    for (_, t, terms, _), es in zip(docs, ents, strict=True):
        for x in terms:
            c_t[x] += 1
        for e in es:
            c_e[e] += 1
            te[e].add(t)
            for x in terms:
                c_et[e, x] += 1
                tet[e, x].add(t)
    out = set()
    for (i, t, terms, spans), es in zip(docs, ents, strict=True):
        for e in es:
            for x in terms:
                named = e == "name:" + x.decode("utf-8", "replace")
                ic = -math.log2(c_e[e] / n)
                pmi = math.log2(n * c_et[e, x] / (c_e[e] * c_t[x]))
                value = e.split(":")[0] in pii.KINDS
                if ic > 0 and pmi >= alpha * ic and (named or (value and len(te[e]) >= support and len(tet[e, x]) >= support)):
                    for m in pii._TERM.finditer(t):
                        if fold(m.group()) == x and all(m.end() <= a or m.start() >= b for _, a, b in spans):
                            out.add((i, m.start(), m.end()))
    return out


def test_added_terms_against_every_pair(spark):
    rng = np.random.default_rng(8)
    vocab = [f"{a}{b}" for a in ("lo", "mi", "ra", "té", "日本") for b in ("n", "rs", "val", "x")]
    rows = []
    for i in range(160):
        w = list(rng.choice(vocab, 12))
        if i % 5 == 0:
            who = int(rng.integers(0, 4))
            w += [f"Anton{who}", f"mail to anton{'abcd'[who]}.{who}@host{who}.example.org", ("王芳", "李明", "张伟", "陈静")[who]]
        if i % 9 == 0:
            w += ["antonb", f"10.{i % 3}.0.{i % 7}", f"rack{i % 3}"]
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
    rows += [(900, rows[0][1]), (901, None), (902, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = pii.find(docs).collect()
    got = {(r["doc_id"], s["start"], s["end"]) for r in found for s in r["spans"] if s["kind"] == "term"}
    want = brute_terms(rows)
    assert got == want and len(got) > 30
    text = dict(rows)
    assert any(text[i][a:b] in ("王芳", "李明", "张伟", "陈静") for i, a, b in got)  # two characters, six bytes


def test_names_in_addresses(spark):
    rows = [(i, f"filler words number {i % 4} and more") for i in range(40)] + [
        (50, "Write to Marlene, at marlene.the@x.example.com, or call"), (51, "and the words the and more")]
    found = {r["doc_id"]: [s for s in r["spans"] if s["kind"] == "term"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(s["start"], s["end"], s["action"]) for s in found[50]] == [(9, 16, "remove")] and not any(v for k, v in found.items() if k != 50)


# ---- Brown classes -------------------------------------------------------------------------------------------

def test_scores_by_definition(spark):
    queries.prepare(spark)
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice([f"w{k}" for k in range(25)], 30))) for i in range(60)] + [(100, "w1 unseen w2"), (101, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    held = lambda c: F.col(c) % 7 == 2
    chunks = brown.chunked(brown.reuse_input(docs), "doc_id", "text", held)
    vocab, base = brown.numbered(brown.count_words(chunks), 10)
    model = brown.train(chunks, vocab, base, classes=3)
    words = {bytes(r["word"]): r for r in vocab.where("lead").collect()}
    m, want = np.zeros((2 + brown.OPEN + 3,) * 2), {}
    path = {}
    for i, t in rows:
        ws = brown.words_of(t or "")
        cls = [int(model.cls[words[w]["id"]]) if words[w]["id"] is not None else 2 + words[w]["open"] for w in ws]
        path[i] = [brown.START, *cls, brown.END]
        if i % 7 != 2:
            for a, b in zip(path[i][:-1], path[i][1:], strict=True):
                m[a, b] += 1
    to = m.sum(0) + 1.0
    to[brown.START] = 0
    step = (m + to / to.sum()) / (m.sum(1, keepdims=True) + 1)
    open_n, open_v = np.zeros(brown.OPEN), np.zeros(brown.OPEN)
    for r in words.values():
        if r["id"] is None and r["c"] > 0:
            open_n[r["open"]] += r["c"]
            open_v[r["open"]] += 1
    for i, t in rows:
        s = sum(math.log10(step[a, b]) for a, b in zip(path[i][:-1], path[i][1:], strict=True))
        for w in brown.words_of(t or ""):
            r = words[w]
            s += math.log10(r["c"] / m.sum(0)[model.cls[r["id"]]]) if r["id"] is not None else math.log10((r["c"] + 1) / (open_n[r["open"]] + open_v[r["open"]] + 1))
        want[i] = s
    run = brown._score(model)
    out = chunks.groupBy("chunk").cogroup(vocab.select("chunk", "word", "c", "open", "id").groupBy("chunk")).applyInArrow(
        lambda a, b: run(a, b), brown._OUT_DDL).collect()
    assert len(out) == len(rows) and all(r["score"] == pytest.approx(want[r["doc_id"]]) for r in out)


def test_packed_neighbours_hold_every_pair(spark):
    queries.prepare(spark)
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(rng.choice([f"w{k}" for k in range(40)], 50))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    chunks = brown.chunked(brown.reuse_input(docs), "doc_id", "text", lambda c: F.col(c) % 9 == 2)
    vocab, base = brown.numbered(brown.count_words(chunks), 3)
    near = brown.neighbours(chunks, vocab, base).collect()
    ids = {bytes(r["word"]): (r["id"] if r["id"] is not None else base + r["open"]) for r in vocab.where("lead").collect()}
    want = defaultdict(int)
    for i, t in rows:
        if i % 9 != 2:
            s = [brown.START, *(ids[w] for w in brown.words_of(t)), brown.END]
            for a, b in zip(s[:-1], s[1:], strict=True):
                want[a, b] += 1
    for col, turn in (("after", False), ("before", True)):
        got = {}
        for r in near:
            for a, b, n in zip(*(x.tolist() for x in brown._unpack(r[col])), strict=True):
                assert ((b, a) if turn else (a, b)) not in got
                got[(b, a) if turn else (a, b)] = n
        assert got == dict(want)


def test_open_windows_do_not_hold_the_ids_of_a_whole_call(monkeypatch):
    """A view of a call's ids would keep them all for as long as its window is open."""
    seen, put = [], packing.Windows.put

    def noted(self, size, item):
        seen.append(item[2].base is None)
        return put(self, size, item)
    monkeypatch.setattr(packing.Windows, "put", noted)
    monkeypatch.setattr(packing, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": ["one two three", None, "four " * 3000]})
    for chars in (10, 4_000_000):
        out = list(packing._pack_partition(queries.tokenizer("word_bpe_49k.json"), 2, 1024, 4, call_chars=chars)(iter([batch])))
        got = sorted((r["doc_id"], r["start"], r["ids"]) for b in out for r in b.to_pylist())
        assert [g[0] for g in got][:2] == [1, 2] and got[1][2] == np.array([2], "<u4").tobytes()
        assert sum(len(g[2]) for g in got if g[0] == 3) == 4 * next(r["doc_tokens"] for b in out for r in b.to_pylist() if r["doc_id"] == 3)
    assert seen and all(seen)


def test_pairs_are_packed_a_bounded_number_of_tokens_at_a_time(monkeypatch):
    texts = pa.table({"text": ["a b a b c"] * 20 + [None, "c"]})
    words = pa.table({"word": pa.array([b"a", b"b", b"c"]), "open": pa.array([1, 2, 3], pa.int32()), "id": pa.array([2, 3, None], pa.int32())})

    def counted(tokens):
        monkeypatch.setattr(brown, "PAIR_TOKENS", tokens)
        most, dealt = [], brown._dealt
        monkeypatch.setattr(brown, "_dealt", lambda i, v, n, parts: (most.append(int(n.sum())), dealt(i, v, n, parts))[1])
        out = brown._pairs(4, 1)(texts, words)
        monkeypatch.setattr(brown, "_dealt", dealt)
        return max(most), [x.tolist() for x in brown._added(out.column("after").to_pylist())]
    (few, a), (whole, b) = counted(10), counted(1_000_000)
    assert few <= 16 and whole == 20 * 6 + 3 and a == b and sum(a[2]) == whole


def test_writers_of_token_files_remember_more_pieces():
    """Beyond the bound a worker holds a piece for one call only and encodes it again in the next."""
    from tsforge.llm import token_files, tokens
    path = queries.tokenizer("byte_bpe_50k.json")
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, None], "text": ["one two three", "one  two"]})
    (docs, ids, at), = token_files.segments(iter([batch]), path, 0)
    enc = tokens._ENCODERS[path, False, token_files.PIECES]
    assert enc.pieces.room == token_files.PIECES > tokens.CACHE_PIECES and docs.tolist() == [1, token_files.NULL_ID]
    small = PieceEncoder(path, pieces=2)  # nothing fits, so all is learned call by call: the same ids
    assert [small.encode(batch.column(1), 0)[0].tolist() for _ in range(2)] == [ids.tolist()] * 2
