"""What encoding costs a worker: time for lists of words, memory for what it remembers."""

import time

import pyarrow as pa
import pyarrow.compute as pc
import pytest

from tests.llm.test_text_operators import NASTY
from tsforge.llm import common, queries, tokens


def test_lists_of_words_are_the_same_and_sooner():
    for col in (pa.array(["a", "é\n", "", "<|endoftext|>"] * 3), pa.array([b"a", b"\xff\x00", b""]), pa.array([], pa.large_string()),
                pa.array(["a", "b", "a"]).dictionary_encode().dictionary, pa.chunked_array([["a"], ["b", "c"]])):
        assert common.listed(col) == col.to_pylist()
    many = pc.cast(pa.array(range(200_000)), pa.string())

    def least(f):
        took = []
        for _ in range(5):
            t0 = time.process_time()
            f()
            took.append(time.process_time() - t0)
        return min(took)
    assert 2 * least(lambda: common.listed(many)) < least(many.to_pylist)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_new_pieces_are_searched_for_special_tokens_once(name):
    enc, calls = tokens.PieceEncoder(queries.tokenizer(name), special=True), []
    search = enc.special

    class Spy:
        def search(self, text):
            calls.append(text)
            return search.search(text)
    enc.special = Spy()
    words = [f"w{chr(97 + i % 26)}{i}" for i in range(500)]
    text = " ".join(words)
    ids, _ = enc.encode(pa.array([text]))
    assert len(calls) < 10  # not once for each piece
    whole = tokens.PieceEncoder(queries.tokenizer(name), special=True)
    assert ids.tolist() == whole._whole(text)
    for x in NASTY + ["a <|endoftext|> b", text + "<|endoftext|>" + text]:
        x = x[1] if isinstance(x, tuple) else x
        assert enc.encode(pa.array([x], pa.string()))[0].tolist() == whole._whole(x or "")


def test_the_pipelines_packing_remembers_less_and_packs_the_same(spark, monkeypatch):
    import corpus_pipeline
    from tests.llm.test_text_operators import frame
    from tsforge.llm import packing
    queries.prepare(spark)
    docs, given = frame(spark, NASTY), []
    real = packing.pack

    def pack(*a, **k):
        given.append(k)
        return real(*a, **k)
    monkeypatch.setattr(packing, "pack", pack)

    def rows(df):
        return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["start"], bytes(r["ids"]), r["doc_tokens"]) for r in df.collect())
    got = rows(corpus_pipeline.pack(spark, docs, ""))
    assert given[0]["cache"] <= tokens.CACHE_PIECES // 4  # beside an executor's heap that earlier stages filled
    path = queries.tokenizer("word_bpe_49k.json")
    assert got == rows(real(docs, path, end=2, special=True)) == rows(real(docs, path, end=2, special=True, cache=2))
    assert tokens.PieceEncoder(path, pieces=40_000).parts.room == 100_000
