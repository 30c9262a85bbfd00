"""Registered queries of the subpackage: each applies one operator, with production parameters, to
its whole table and derives the result columns from the operator's output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (brown, conversation_trie, dac, dedup, jaccard, language_id, mixing, packing, periodic_runs, pii, pu_classifier,
               quality_rules, separator_scan)
from .common import crc_id, crc_mod, documents, prepare, table


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file (the same on the driver and the executors)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = packing.pack(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"), end=2, special=True)
    return p.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
                    F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality_rules.ledger(documents(spark, sf_dir))
    out = quality_rules.apply_policy(quality_rules.apply_policy(led, "base", "base_kept"), "v1")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      (~F.col("base_kept")).alias("base_failed"), "kept", "failed")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup(documents(spark, sf_dir))


def fifth(col: str):
    """Rows held out of the quality classifier."""
    return crc_mod(col, 5) == 0


def seventh(col: str):
    """Rows held out of the language model."""
    return crc_mod(col, 7) == 2


def op4_pu_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    s = pu_classifier.score(docs, pu_classifier.learn(docs, table(spark, sf_dir, "labels"), fifth))
    return s.select("doc_id", fifth("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(documents(spark, sf_dir))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def of(kind):
        return F.filter("spans", lambda x: x["kind"] == kind)

    base = F.filter("spans", lambda x: x["kind"] != "term")
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, sf_dir))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir).select("doc_id", "source"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return separator_scan.token_counts(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"), end=50256)


def op9_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score_texts(documents(spark, sf_dir), seventh)


def op10_dac(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = dac.write_codes(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"), end=0, special=True)
    return dac.read_documents(made)


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = language_id.identify(docs, language_id.learn(docs.where(~fifth("doc_id"))))
    return out.select("doc_id", fifth("doc_id").alias("held_out"), F.col("lang").alias("lang_pred"), "score", "n_words")


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, convs = conversation_trie.digest_turns(table(spark, sf_dir, "conversations"))
    turns = conversation_trie.splice_heads(turns, convs, group=20, most=3)
    return conversation_trie.prefix_trie(turns, convs)


def repeating_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the text of one document in ten goes on with repeats of a piece of it:
    with h = crc32(id) divisible by 10 and n words, word i >= a becomes word a + (i - a) % p."""
    h = crc_id("doc_id")
    g = F.floor(h / 10)
    some = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))).alias("ws"))
    n = F.size("ws").cast("long")
    some = some.withColumn("n", n).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    some = some.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    word = F.transform(F.sequence(F.lit(0), (F.col("n") - 1).cast("int")), lambda i: F.get(
        "ws", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return some.select("doc_id", F.when(F.col("n") > 0, F.array_join(word, " ")).otherwise(F.col("text")).alias("text"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(repeating_tails(documents(spark, sf_dir)))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"), F.floor(-1000 * F.col("best.less") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


QUERIES = {f.__name__: f for f in (op1_packing, op2_quality_rules, op3_exact_dedup, op4_pu_classifier, op5_pii, op6_jaccard,
                                   op7_mixing, op8_token_counts, op9_brown, op10_dac, op11_language_id, op12_trie, op13_runs)}


def registered() -> dict:
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        return run
    return {k: wrap(f) for k, f in QUERIES.items()}
