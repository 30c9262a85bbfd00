"""Quality rules: a ledger of failure bits and measurements, with policies applied afterwards.

Every rule is evaluated once for each document. The ledger keeps the measurements and one bit for
each failed rule; a policy is a versioned set of bits that reject a document, and an ablation
counts, by bitwise aggregation over the ledger, what each rule rejects alone or together.

Cases: a null or empty text has no words (all measurements 0, so the minimum-word rule fails);
very long texts are measured whole; repeated rows each get a row; an empty table gives an empty
ledger; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_caps"]
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

# name -> condition under which the rule fails; the position is the rule's bit. New rules go to
# the end, so that ledgers written before keep their meaning.
RULES = [
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "20 * n_symbols > 3 * n_words"),
    ("word_length_low", "word_chars < 2 * n_words"),
    ("word_length_high", "word_chars > 15 * n_words"),
    ("duplicate_lines", "n_lines > 1 AND 10 * n_dup_lines > 3 * n_lines"),
    ("capitals", "2 * n_caps > word_chars"),
]
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}


def mask(names) -> int:
    return sum(BIT[n] for n in names)


# Versioned policies: any of these bits rejects.
POLICIES = {
    "base": mask(["few_words", "repeated_words"]),
    "v1": mask(["few_words", "repeated_words", "symbols", "word_length_low", "word_length_high"]),
    "v2": mask(BIT),
}


def measure_text(raw: bytes) -> tuple[int, ...]:
    """The measurements of one UTF-8 text."""
    b = np.frombuffer(raw, np.uint8)
    words = raw.split()
    n = len(words)
    chars = int(np.count_nonzero((b & 0xC0) != 0x80)) - int(np.count_nonzero(_SPACE[b]))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    repeat = 0
    if n >= 4:
        code: dict[bytes, int] = {}
        w = np.fromiter((code.setdefault(x, len(code)) for x in words), np.int64, n)
        v = len(code)
        if v < n:  # else no window can occur twice
            pair = w[:-1] * v + w[1:]
            if v >= 1 << 20:  # keep the triple's code within 64 bits
                pair = np.unique(pair, return_inverse=True)[1]
                v = max(v, 1)
            key = pair[:-1] * v + w[2:]
            order = np.argsort(key, kind="stable")
            s = key[order]
            same = s[1:] == s[:-1]
            twice = np.zeros(n - 2, bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            cover = np.zeros(n, bool)
            for k in range(3):
                cover[k:n - 2 + k] |= twice
            repeat = int(np.count_nonzero(cover))
    return (n, chars, int(np.count_nonzero(_SYMBOLS[b])), len(lines) - len(set(lines)), repeat, len(lines),
            int(np.count_nonzero(_UPPER[b])))


def _measure(it):
    for b in it:
        ids = b.column(0)
        rows = [measure_text(t.encode("utf-8", "surrogatepass")) for t in batches(b.column(1))]
        m = np.array(rows, np.int64).reshape(len(rows), len(MEASURES))
        yield pa.RecordBatch.from_arrays([ids, *[pa.array(m[:, i]) for i in range(len(MEASURES))]],
                                         names=["doc_id", *MEASURES])


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the measurements and ``failed`` (bit i: rule i of ``RULES`` failed)."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    m = src.mapInArrow(_measure, "doc_id long, " + ", ".join(f"{c} long" for c in MEASURES))
    bits = [F.when(F.expr(cond), F.lit(BIT[name]).cast("long")).otherwise(F.lit(0).cast("long")) for name, cond in RULES]
    total = bits[0]
    for x in bits[1:]:
        total = total.bitwiseOR(x)
    return m.withColumn("failed", total)


def apply_policy(led: DataFrame, version: str, out: str = "kept") -> DataFrame:
    """The ledger with a verdict column: true where no bit of the policy is set."""
    return led.withColumn(out, F.col("failed").bitwiseAND(F.lit(POLICIES[version]).cast("long")) == 0)


def ablation(led: DataFrame, version: str) -> DataFrame:
    """For each rule of a policy: documents it fails, documents only it rejects, and how many the
    policy keeps without it. One aggregation over the bits; no rule is evaluated again."""
    pol = POLICIES[version]
    f = F.col("failed").bitwiseAND(F.lit(pol).cast("long"))
    aggs = []
    for name, bit in BIT.items():
        if pol & bit:
            rest = F.col("f").bitwiseAND(F.lit(pol & ~bit).cast("long"))
            has = F.col("f").bitwiseAND(F.lit(bit).cast("long")) != 0
            aggs.append(F.struct(F.lit(name).alias("rule"), F.sum(has.cast("long")).alias("fails"),
                                 F.sum((has & (rest == 0)).cast("long")).alias("only_this"),
                                 F.sum((rest == 0).cast("long")).alias("kept_without")))
    one = led.select(f.alias("f")).agg(F.array(*aggs).alias("a"), F.bit_or("f").alias("any_failed"))
    return one.select(F.explode("a").alias("a"), "any_failed").select("a.*", "any_failed")
