"""Language identification, conversation trie and periodic runs against brute-force versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_text_operators import NASTY, frame
from tsforge.llm import conversation_trie as ct
from tsforge.llm import language_id, periodic_runs, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def nasty(spark):
    queries.prepare(spark)
    return frame(spark, NASTY)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [], 1)


def crc(x):
    return zlib.crc32(b"" if x is None else str(x).encode())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- periodic runs -----------------------------------------------------------------------------------

def brute_runs(w):
    """(start, length, period) of every run, sorted by start and period."""
    found, n = {}, len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i > start and i - start + q >= max(12, 2 * q):
                found.setdefault((start, i + q), q)
            i += i == start
    return sorted((s, e - s, q) for (s, e), q in found.items())


def sequences(seed, count):
    rnd = random.Random(seed)
    for k in range(count):
        n, a = rnd.randint(0, 150), rnd.choice([1, 2, 3, 5, 50])
        if k % 5 == 0:
            yield [rnd.randrange(a) for _ in range(n)]
        elif k % 5 == 1:  # one period with a few faults
            w = ([rnd.randrange(a) for _ in range(rnd.randint(1, 40))] * 20)[:n]
            for _ in range(rnd.randint(0, 3)):
                if w:
                    w[rnd.randrange(len(w))] = rnd.randrange(a)
            yield w
        elif k % 5 == 2:  # repeats of repeats
            u = [rnd.randrange(2) for _ in range(2)] * rnd.randint(1, 15) + [rnd.randrange(3) for _ in range(rnd.randint(0, 3))]
            yield u * rnd.randint(1, 5) + [rnd.randrange(3) for _ in range(rnd.randint(0, 5))]
        elif k % 5 == 3:  # blocks in the order of a Fibonacci word
            x, y = ([rnd.randrange(a) for _ in range(rnd.randint(1, 8))] for _ in range(2))
            y = x + y
            while len(y) < n:
                x, y = y, y + x
            yield y[:n]
        else:
            w = []
            while len(w) < n:
                w += [rnd.randrange(a) for _ in range(rnd.randint(1, 6))] * rnd.randint(1, 8)
            yield w


def test_runs_of_sequences():
    for w in sequences(1, 1_500):
        got = [(s, e - s, q) for s, e, q in periodic_runs.runs_of(np.array(w, np.int64)).tolist()]
        assert got == brute_runs(w), w


def test_runs_of_several_documents_at_once():
    texts = [[f"w{x}".encode() for x in w] for w in sequences(2, 60)]
    for words, (runs, collapsed) in zip(texts, periodic_runs._search(texts), strict=True):
        want = brute_runs(words)
        drop = {i for s, n, q in want for i in range(s + q, s + n)}
        assert [(s, e - s, q) for s, e, q in runs.tolist()] == want
        assert collapsed == b" ".join(x for i, x in enumerate(words) if i not in drop)


def test_runs_of_long_repeats_take_few_pairs(monkeypatch):
    seen = []
    partners = periodic_runs._Index.partners

    def counted(self, *args):
        out = partners(self, *args)
        seen.append(len(out[0]))
        return out
    monkeypatch.setattr(periodic_runs._Index, "partners", counted)
    for w in (np.zeros(20_000, np.int64), np.tile(np.arange(17), 1_200), np.tile(np.arange(3_000), 9)):
        seen.clear()
        assert len(periodic_runs.runs_of(w)) == 1
        assert sum(seen) < 60 * len(w)


def repeating(doc_id, text):
    w, h = WORD.findall(text or ""), crc(doc_id)
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    return w


def digest_row(doc_id, text):
    w = repeating(doc_id, text)
    runs = brute_runs(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


def test_runs_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = {r["doc_id"]: digest_row(*r) for r in docs if len(r["text"] or "") < 9_000}
    got = {r["doc_id"]: tuple(r) for r in queries.registered()["op13_runs"](spark, SF).collect()}
    assert len(got) == len(docs) and len(short) > 150 and sum(x[1] > 0 for x in short.values()) > 15
    assert all(got[i] == want for i, want in short.items())


def test_runs_nasty(spark, nasty, empty):
    rows = periodic_runs.find_runs(nasty).collect()
    assert len(rows) == len(NASTY) and {r["n_words"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0}
    assert all(r["runs"] == [] and r["collapsed"] == " ".join(WORD.findall(dict(NASTY)[r["doc_id"]] or "")) for r in rows if r["doc_id"] not in (6, None, 9))
    assert periodic_runs.find_runs(empty).count() == 0
    loop = frame(spark, [(1, " a b c " * 9_000), (1, "x\n" * 12), (None, "x " * 11)])
    got = [(r["runs"][0].asDict() if r["runs"] else None, r["collapsed"]) for r in periodic_runs.find_runs(loop).orderBy("n_words").collect()]
    assert got == [(None, " ".join("x" * 11)), ({"start": 0, "length": 12, "period": 1}, "x"), ({"start": 0, "length": 27_000, "period": 3}, "a b c")]
    tails = {r["doc_id"]: r["text"] for r in queries.repeating_tails(nasty).where("doc_id IS NOT NULL").collect()}
    assert all(WORD.findall(tails[i] or "") == repeating(i, t) for i, t in NASTY if i is not None)


# ---- conversation trie -------------------------------------------------------------------------------

def brute_trie(paths):
    """paths: conv_id -> list of turns. Rows as the operator's, by definition."""
    members = defaultdict(list)
    for c, path in sorted(paths.items()):
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    nodes = {}
    for k, cs in members.items():
        ends = [c for c in cs if len(paths[c]) == len(k)]
        nodes[k] = [cs[0], len(k), members[k[:-1]][0] if k else None, len(cs), 0, 0, 0, sha(",".join(map(str, ends)))]
    for k in nodes:
        if k:
            nodes[k[:-1]][4] += 1
    for k, x in list(nodes.items()):
        for d in range(len(k) + 1):
            up = nodes[k[:d]]
            up[5] += x[4] == 0
            up[6] += (x[3] - 1) * (len(WORD.findall(k[-1][1])) if k else 0)
    return sorted((tuple(x) for x in nodes.values()), key=lambda x: (x[1], x[0]))


def ordered(rows):
    """conv_id -> turns in order, of rows (conv_id, turn, role, text) without equal turn numbers."""
    out = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if c is not None:
            out[c].append((role or "", text or ""))
    return dict(out)


def spliced(own):
    out = {}
    for c, turns in own.items():
        h = crc(c) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def collected(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=lambda x: (x[1], x[0]))


def talk(seed, convs=120, width=3, longest=9):
    rnd = random.Random(seed)
    rows = [(None, 0, "user", "no conversation")]
    for c in rnd.sample(range(400), convs):
        for t in range(rnd.randint(1, longest)):
            turn = None if t == 0 and rnd.random() < 0.2 else 10 * t
            text = None if rnd.random() < 0.05 else " ".join(["say"] * rnd.randint(1, width))
            rows.append((c, turn, rnd.choice(["user", "user", None]), text))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("queue, bits", [(1 << 20, 12), (2, 6), (3, 1), (1, 0)])
def test_trie(spark, queue, bits):
    rows = talk(bits)
    turns, convs = ct.digest_turns(spark.createDataFrame(rows, SCHEMA).withColumn("depth", F.lit("clash")).repartition(5))
    assert collected(ct.prefix_trie(turns, convs, queue, bits)) == brute_trie(ordered(rows))


def test_trie_of_spliced_conversations(spark):
    rows = talk(7, 150)
    turns, convs = ct.digest_turns(spark.createDataFrame(rows, SCHEMA))
    got = ct.prefix_trie(ct.splice_heads(turns, convs, 20, 3), convs, block_bits=4)
    assert collected(got) == brute_trie(spliced(ordered(rows)))


def test_trie_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(queries.registered()["op12_trie"](spark, SF)) == brute_trie(spliced(ordered(rows)))


def test_trie_cuts_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(ct, "SEGMENT_BITS", 3)
    rows = [(c, t, "user", f"turn {t if t < 10 * c else c * 1000 + t}") for c in range(1, 6) for t in range(60)]
    rows += [(9, t, "user", f"turn {t}") for t in range(30)] + [(10, t, "user", f"turn {t}") for t in range(30)]
    turns, convs = ct.digest_turns(spark.createDataFrame(rows, SCHEMA))
    assert collected(ct.prefix_trie(turns, convs, 2, 1)) == brute_trie(ordered(rows))


def test_trie_cases(spark):
    def trie(rows):
        turns, convs = ct.digest_turns(spark.createDataFrame(rows, SCHEMA))
        return collected(ct.prefix_trie(ct.splice_heads(turns, convs, 20, 3), convs))
    assert trie([]) == [] and trie([(None, 1, "a", "b")]) == []
    # repeated rows are turns; a conversation all of whose turns fall away stays a member of the root
    twice = [(40, 1, "a", "b c"), (40, 1, "a", "b c"), (60, 1, "a", "b c")]
    assert trie(twice) == brute_trie(spliced({40: [("a", "b c")] * 2, 60: [("a", "b c")]}))
    short = next(c for c in range(100_001, 100_100) if crc(c) % 4 == 3)
    assert trie([(short, 0, "a", "x"), (short, 1, "a", "y")]) == [(short, 0, None, 1, 0, 1, 0, sha(str(short)))]


def test_queue_spills_and_keeps_order(tmp_path):
    rnd, want = random.Random(3), defaultdict(lambda: [0, 0])
    q = ct.MessageQueue(f"file://{tmp_path}/queue", limit=7)
    for _ in range(400):
        key = (-rnd.randint(0, 5), rnd.randint(-9, 9), rnd.randint(0, 3))
        q.push(key, 1, key[1])
        want[key][0] += 1
        want[key][1] += key[1]
        assert len(q.heap) <= 7
    assert len(q.runs) > 40
    for key in sorted(want):
        assert list(q.take(key)) == want[key]
    assert q.empty() and not list((tmp_path / "queue").iterdir())


# ---- language identification --------------------------------------------------------------------------

class BruteBackoff:
    def __init__(self, rows, floor):
        self.absent, self.freq, words = math.log10(floor) - 1, defaultdict(dict), Counter()
        for lang in {lang for _, lang in rows}:
            for n in range(language_id.LONGEST + 1):
                c = Counter(g for t, x in rows if x == lang for w in self.words(t) for g in self.grams(w, n))
                total = sum(c.values())
                words[lang] += total if n == 0 else 0
                for g, k in c.items():
                    if k >= floor * total:
                        self.freq[n, g][lang] = math.log10(k / total)
        self.langs = sorted(words, key=lambda x: (-words[x], x))

    @staticmethod
    def words(text):
        return [w for w in re.findall(r"[^\W\d_]+", (text or "").lower()) if w.isalpha()]

    @staticmethod
    def grams(w, n):
        s = f" {w} "
        return [w] if n == 0 else [g for g in (s[i:i + n] for i in range(len(s) - n + 1)) if g != " "]

    def word(self, w):
        for n in [0, *range(language_id.LONGEST, 0, -1)]:
            got = [self.freq[n, g] for g in self.grams(w, n) if (n, g) in self.freq]
            if got:
                return [sum(f.get(x, self.absent) for f in got) / len(got) for x in self.langs]
        return [self.absent] * len(self.langs)

    def __call__(self, text):
        ws = [self.word(w) for w in self.words(text)]
        if not ws or not self.langs:
            return "und", 0.0
        s = [sum(c) for c in zip(*ws, strict=True)]
        best = max(range(len(s)), key=lambda k: (round(s[k], 9), -k))
        return self.langs[best], 1 / sum(10 ** max(x - s[best], -300) for x in s)


@pytest.mark.parametrize("floor", [1e-5, 0.004])
def test_language_against_brute_force(spark, floor):
    queries.prepare(spark)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 2500")
    rows = docs.select("doc_id", "text", "lang").collect()
    brute = BruteBackoff([(r["text"], r["lang"]) for r in rows if crc(r["doc_id"]) % 5], floor)
    model = language_id.learn(docs.where(~queries.fifth("doc_id")), floor=floor)
    odd = [(f"o{i}", t, None) for i, t in enumerate(["Zqx jjvwk", "ß²³ Ωμέγα", "été 12", "ein the la", "日本", "THE"])]
    got = language_id.identify(docs.select("doc_id", "text"), model).collect()
    more = spark.createDataFrame([(i, t) for i, (_, t, _) in enumerate(odd)], "doc_id long, text string")
    assert model.langs == brute.langs and len(rows) > 100
    for r in got:
        lang, score = brute(next(x["text"] for x in rows if x["doc_id"] == r["doc_id"]))
        assert (r["lang"], round(r["score"], 6)) == (lang, round(score, 6))
    for r in language_id.identify(more, model).collect():
        lang, score = brute(odd[r["doc_id"]][1])
        assert (r["lang"], round(r["score"], 6)) == (lang, round(score, 6))


def test_language_held_out_accuracy(spark):
    out = queries.registered()["op11_language_id"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    r = out.join(truth, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a"), F.count("*").alias("n")).first()
    assert r["n"] > 150 and r["a"] > 0.98


def test_language_nasty(spark, nasty, empty):
    none = language_id.learn(nasty)  # no row has a language
    assert {(r["lang"], r["score"]) for r in language_id.identify(nasty, none).collect()} == {("und", 0.0)}
    tagged = nasty.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "aa").when(F.col("doc_id") > 2, "bb"))
    model = language_id.learn(tagged)
    rows = language_id.identify(tagged, model).collect()
    assert len(rows) == len(NASTY) and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["lang"] for r in rows if r["doc_id"] in (1, 2, 3)} == {"und"}
    assert {r["lang"] for r in rows if r["doc_id"] not in (1, 2, 3)} <= {"aa", "bb", "und"}
    assert language_id.identify(empty, model).count() == 0 and language_id.learn(empty).langs == []
    digits = spark.createDataFrame([(1, "12 34 _ ² ½ !?"), (2, "a")], "doc_id long, text string")
    assert {r["doc_id"]: r["lang"] == "und" for r in language_id.identify(digits, model).collect()} == {1: True, 2: False}
