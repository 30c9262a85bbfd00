"""The corpus pipeline: documents that pass the quality classifier, without exact and near copies,
in an order that mixes sources to target weights, packed into sequences.

``run`` writes each stage's result as parquet in the shared folder and rereads it as the next one's
documents. All stages but the last return the columns of documents.

Cases: an empty table gives an empty one in every stage; null and empty texts are documents with an
empty text (scored as such, one of them stays after exact dedup, none is a near copy); very long texts
are read whole; null and repeated ids are rows like others, told apart by their texts; equal texts, and
near copies, leave the row with the smallest id (null last, ties by the digest of the text); other
columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsforge.llm import dedup, jaccard, mixing, packing, pu_classifier
from tsforge.llm.common import parts_for, prepare, shared_dir, table
from tsforge.llm.queries import fifth, tokenizer

THRESHOLD = 0.3  # score from which a document is kept


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier accepts."""
    prepare(spark)
    model = pu_classifier.learn(docs, table(spark, sf_dir, "labels"), fifth)
    return pu_classifier.with_score(docs, model).where(F.col("pu_score") >= THRESHOLD).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text; the smallest id stays."""
    prepare(spark)
    kept = dedup.exact_dedup(docs).where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_digest")).distinct()
    keyed = docs.withColumn("row_digest", dedup.digest_of("text"))
    same = (F.col("row_digest") == F.col("kept_digest")) & F.col("doc_id").eqNullSafe(F.col("kept_id"))
    return keyed.join(kept, same, "left_semi").dropDuplicates(["row_digest", "doc_id"]).select(*docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies; the smallest id stays."""
    prepare(spark)
    return jaccard.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, ordered by the earliest-deadline-first schedule of their sources."""
    prepare(spark)
    mixed = mixing.mix(docs)
    return mixed.repartitionByRange(parts_for(docs), "mix_slot", "mix_pos").sortWithinPartitions("mix_slot", "mix_pos").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4,096 ids, with their sequence and place."""
    prepare(spark)
    return packing.pack(docs, tokenizer("word_bpe_49k.json"), end=2, special=True, call_chars=1_000_000,
                        cache=40_000)  # less at once and less remembered, beside what earlier stages left


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("jaccard_join", jaccard_join),
    ("mix_sources", mix_sources),
    ("packing", pack),
]

# The classifier cannot be stated in SQL; tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    base = shared_dir(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{base}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
