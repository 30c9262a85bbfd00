"""Tokens, packing, token files, quality rules, exact dedup and sanitisation on small nasty tables."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsforge.llm import dac, dedup, packing, pii, quality_rules, queries, separator_scan
from tsforge.llm.tokens import PieceEncoder

WS = "[\x20\x09-\x0D]+"
WORD = re.compile("[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977} x{i}" for i in range(20_000))
NASTY = [
    (5, "Plain words, on one line.\nAnd, on the next: plain words."), (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "),
    (4, "a"), (9, LONG), (7, "same text here"), (8, "same  text\nhere"), (6, "same text here"), (6, "same text here"),
    (10, "mail me.at@x-y.example.com, or 10.0.0.255 and 300.1.1.1 now"), (11, "card 4111 1111 1111 1111 tel +44 (0)20 7946-0958"),
    (12, "café naïve 日本 한국 é  x  y \x1c z"), (13, "\x01 <|endoftext|> <| \x00"),
    (None, "row without an id"), (None, "row without an id"), (14, "x" * 50_000), (15, "it's we'll I'D 12 345 ١٢"),
]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                       *[T.StructField(c, T.StringType()) for c in ("ids", "part", "kept", "digest", "spans", "start", "n", "cls", "chunk")]])


def frame(spark, rows, parts=3):
    full = [(i, t, None, f"s{(i or 0) % 2}", None, *["clash"] * 9) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


@pytest.fixture(scope="module")
def nasty(spark):
    queries.prepare(spark)
    return frame(spark, NASTY)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [], 1)


def tok(name):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.tokenizer(name))
    t.encode_special_tokens = True
    return t


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_by_pieces_equal_ids_of_the_text(name):
    rnd = np.random.default_rng(3)
    texts = [t or "" for _, t in NASTY] + ["".join(rnd.choice(list("ab.'s1 \n\t\x01ÉΣ́<|ǅİ"), rnd.integers(0, 30))) for _ in range(400)]
    t, e = tok(name), PieceEncoder(queries.tokenizer(name))
    for _ in range(2):  # the second time from the cache
        ids, at = e.encode(pa.array(texts), 7)
        for i, x in enumerate(texts):
            assert ids[at[i]:at[i + 1]].tolist() == t.encode(x, add_special_tokens=False).ids + [7], x[:80]


def pieces_hold(rows, docs, seq_len):
    """Every id of every row in exactly one piece, sequences without gaps."""
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += len(r["ids"]) // 4
        assert at <= seq_len
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).append((r["start"], r["doc_tokens"], bytes(r["ids"])))
    for doc, want in docs.items():
        have = sorted(got.pop(doc))
        assert sum(len(x) for _, _, x in have) == sum(len(w) for w in want)
        if len(want) == 1:
            assert b"".join(x for _, _, x in have) == want[0] and {n for _, n, _ in have} == {len(want[0]) // 4}
        else:
            assert sorted(x for _, _, x in have) == sorted(want)
    assert not got


def test_packing(spark, nasty, empty):
    t = tok("word_bpe_49k.json")
    docs = {}
    for i, x in NASTY:
        docs.setdefault(i, []).append(np.array(t.encode(x or "", add_special_tokens=False).ids + [2], "<u4").tobytes())
    for seq_len, space, fan in ((4096, 64, 8), (4096, 2, 1)):
        rows = packing.pack(nasty, queries.tokenizer("word_bpe_49k.json"), 2, seq_len, space, fan).collect()
        pieces_hold(rows, docs, seq_len)
    assert packing.pack(empty, queries.tokenizer("word_bpe_49k.json"), 2).count() == 0


def test_open_windows_best_fit_and_fullest():
    w = packing.Windows(10, 2)
    assert w.put(6, "a") == [] and w.put(7, "b") == []
    assert w.put(3, "c") == [(1, ["b", "c"])]          # fills the window it fits best
    assert w.put(5, "d") == [] and w.put(9, "e") == [(0, ["a"])]  # none fits: the fullest goes
    assert sorted(x for _, xs in w.rest() for x in xs) == ["d", "e"]


def test_packing_query_fills_sequences(spark):
    out = queries.registered()["op1_packing"](spark, "/root/testdata/sf0.01").toPandas()
    n = out.sequence_id.nunique()
    assert out.length.sum() / (4096 * n) > 0.97
    assert out.groupby("doc_id").length.sum().eq(out.groupby("doc_id").doc_tokens.first()).all()


def test_dac_round_trip_and_access():
    rnd = np.random.default_rng(1)
    for width in (8, 16):
        for ids in ([], [0], [255, 256, 65_535, 65_536, (1 << 32) - 1], rnd.integers(0, 1 << 32, 5_000), rnd.integers(0, 50_257, 3_000), np.full(2_000, 300)):
            ids = np.array(ids, np.uint64)
            off = np.array([0, len(ids) // 3, len(ids)], np.int64)
            r = dac.Reader(b"".join(bytes(x) for x in dac.dump(np.array([4, 9]), off, ids, width)))
            pos = rnd.permutation(len(ids))
            assert (r.get(pos) == ids[pos]).all() and (r.span(0, len(ids)) == ids).all()
            assert (r.document(1) == ids[len(ids) // 3:]).all() and r.n == len(ids)
            for lo in (0, 1, 63, 64, 513, 1_999):
                if lo < len(ids):
                    assert (r.span(lo, len(ids)) == ids[lo:]).all() and r.get([lo])[0] == ids[lo]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))


def test_dac_files(spark, nasty, empty):
    t = tok("byte_bpe_50k.json")
    want, at = [], 0
    for i, x in order(NASTY):
        ids = np.array(t.encode(x or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    for shards in (1, 4):
        m = dac.write_codes(nasty, queries.tokenizer("byte_bpe_50k.json"), 0, shards=shards, segment_ids=1 if shards == 1 else 1 << 20)
        got = sorted((tuple(r) for r in dac.read_documents(m, 2).collect()), key=lambda r: r[1])
        assert got == want
    every = np.concatenate([np.array(t.encode(x or "", add_special_tokens=False).ids + [0]) for _, x in order(NASTY)])
    one = dac.write_codes(nasty, queries.tokenizer("byte_bpe_50k.json"), 0, shards=1, segment_ids=1).first()
    f = dac.CodeFile(one["path"])
    pos = np.random.default_rng(2).integers(0, len(every), 500)
    assert (f.get(pos) == every[pos]).all()
    assert dac.read_documents(dac.write_codes(empty, queries.tokenizer("byte_bpe_50k.json"), 0)).count() == 0


@pytest.mark.parametrize("block", [7, 1_000, 1 << 20])
def test_separator_scan(spark, nasty, empty, block):
    t = tok("byte_bpe_50k.json")
    want = sorted((i or -1, len(t.encode(x or "", add_special_tokens=False).ids) + 1) for i, x in NASTY[:9] + NASTY[10:13])
    docs = frame(spark, NASTY[:9] + NASTY[10:13]) if block == 1_000 else frame(spark, [r for r in NASTY[:9] + NASTY[10:13] if r[0] != 9])
    if block != 1_000:
        want = [w for w in want if w[0] != 9]
    out = separator_scan.token_counts(docs, queries.tokenizer("byte_bpe_50k.json"), 50256, block_ids=block)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in out.collect()) == want
    if block == 7:
        assert separator_scan.token_counts(empty, queries.tokenizer("byte_bpe_50k.json"), 50256).count() == 0


def rules_of(text):
    ws = WORD.findall(text)
    wins = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    seen, cover = {}, set()
    for w in wins:
        seen[w] = seen.get(w, 0) + 1
    for i, w in enumerate(wins):
        if seen[w] > 1:
            cover |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover))


def test_quality_rules(spark, nasty, empty):
    texts = [t or "" for _, t in NASTY] + ["a b c a b c", "a a a a", "x y\nx y\n\n \nx y", "# * $$ %\n|", "a b c d a b c e b c a"]
    for t in texts:
        assert quality_rules.measure_text(t.encode())[:5] == rules_of(t), t[:60]
    led = quality_rules.ledger(nasty)
    got = sorted((r["doc_id"] or -1, r["n_words"], r["word_chars"]) for r in led.collect())
    assert got == sorted((i or -1, *rules_of(t or "")[:2]) for i, t in NASTY)
    kept = quality_rules.apply_policy(led, "v1")
    n = led.count()
    for r in quality_rules.ablation(led, "v1").collect():
        bit = quality_rules.BIT[r["rule"]]
        rest = quality_rules.POLICIES["v1"] & ~bit
        rows = [x["failed"] for x in kept.collect()]
        assert r["fails"] == sum(bool(x & bit) for x in rows) and r["kept_without"] == sum(not x & rest for x in rows)
        assert r["only_this"] == sum(bool(x & bit) and not x & rest for x in rows) and n == len(rows)
    assert quality_rules.ledger(empty).count() == 0


def test_exact_dedup(spark, nasty, empty):
    norm = [(i, re.sub(WS, " ", t or "")) for i, t in NASTY]
    groups = {}
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    want = []
    for i, t in norm:
        ids = [x for x in groups[t] if x is not None]
        keep = min(ids) if ids else None
        want.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    for batches in (1, 3):
        got = [tuple(r) for r in dedup.exact_dedup(nasty, batches=batches, buckets=3).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert dedup.exact_dedup(empty).count() == 0


def test_digest_index_persists_and_appends(spark, nasty):
    path = queries.dedup.shared_dir(spark, "index-test")
    d = dedup.digests(nasty)
    dedup.DigestIndex(spark, path, 4).append(d.where("doc_id < 8"))
    again = dedup.DigestIndex(spark, path, 4)
    n = again.table().count()
    assert n == d.where("doc_id < 8").select("digest").distinct().count()
    again.append(d.where("doc_id < 8"))
    assert again.table().count() == n
    again.append(d)
    assert again.table().count() == again.plain().select("digest").distinct().count() == d.select("digest").distinct().count()
    plan = again.fresh(d)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and "Python" not in plan


PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute_spans(text):
    def fine(kind, s):
        d = re.sub("[^0-9]", "", s)
        luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
        return (kind == "email" or (kind == "ip" and all(int(p) <= 255 for p in s.split(".")))
                or (kind == "card" and 16 <= len(d) <= 19 and luhn) or (kind == "phone" and 8 <= len(d) <= 15))
    return [(k, m.start(), m.end()) for k, p in PATTERNS for m in re.finditer(p, text) if fine(k, m.group())]


def test_base_spans_equal_the_patterns():
    rnd = np.random.default_rng(5)
    texts = [t or "" for _, t in NASTY if t is None or len(t) < 1_000]
    texts += ["".join(rnd.choice(list("01259.@-+ ()aZ%_"), rnd.integers(0, 60))) for _ in range(4_000)]
    texts += ["a@b@c.de.f@g.h", "x.@.y@z.", "1.2.3.4.5.6.7.8", "0001.2.3.4", "1.2.3.0256", "4111-1111-1111-1111 4111 1111 1111 1111"]
    for t in texts:
        assert pii.base_spans(t) == brute_spans(t), t


def test_disclosing_terms(spark, empty):
    rows = [(i, f"Visit agent Zanzibarov at zz{k}@corp.example.com for the usual talk {i}") for k in range(2) for i in range(10 * k, 10 * k + 3)]
    rows = [(i, t.replace("Zanzibarov", f"Zanz{'ab'[i // 10]}rov")) for i, t in rows]
    rows += [(100 + i, f"Visit agent number {i} for the usual talk on rules and plans") for i in range(60)] + [(999, None), (998, "")]
    docs = frame(spark, rows)
    found = {r["doc_id"]: r["spans"] for r in pii.find(docs).collect()}
    assert len(found) == len(rows) and found[999] == [] and found[998] == []
    for i in (0, 1, 2, 10, 11, 12):
        text = dict(rows)[i]
        assert [text[s["start"]:s["end"]] for s in found[i] if s["kind"] == "email"] == [f"zz{i // 10}@corp.example.com"]
        assert [text[s["start"]:s["end"]] for s in found[i] if s["kind"] == "term"] == [f"Zanz{'ab'[i // 10]}rov"]
    assert not any(found[100 + i] for i in range(60))
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs, pii.find(docs)).collect()}
    assert clean[0] == "Visit agent  at [EMAIL] for the usual talk 0" and clean[105] == dict(rows)[105]
    assert pii.find(empty).count() == 0


def test_disclosing_terms_anywhere_in_the_document(spark):
    far = " ".join(["the usual talk on rules and plans"] * 40)
    long = "q" * 400
    rows = [(i, f"Quixotta wrote: {far} {i} {far} to zz@corp.example.com {far} {i} {long}") for i in range(3)]
    rows += [(100 + i, f"talk {i} on the rules: {far} to wrote") for i in range(60)]
    found = {r["doc_id"]: r["spans"] for r in pii.find(frame(spark, rows)).collect()}
    for i in range(3):
        assert [rows[i][1][s["start"]:s["end"]] for s in found[i] if s["kind"] == "term"] == ["Quixotta", long]
    assert not any(found[100 + i] for i in range(60))


def test_pii_nasty(spark, nasty):
    got = sorted((r["doc_id"] or -1, [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] != "term"]) for r in pii.find(nasty).collect())
    assert got == sorted((i or -1, brute_spans(t) if t and len(t) < 1_000 else []) for i, t in NASTY)


def test_queries_keep_all_rows(spark):
    q = queries.registered()
    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name in ("op2_quality_rules", "op3_exact_dedup", "op5_pii", "op8_token_counts", "op10_dac"):
        out = q[name](spark, sf)
        assert out.count() == n and out.select(F.countDistinct("doc_id")).first()[0] == n, name
