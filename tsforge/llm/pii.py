"""PII: information-theoretic sanitisation.

Values of fixed shape (e-mail, IP, card and phone numbers) are the protected entities, and so are the
names in an address. A corpus pass counts, over whole texts, in how many documents each term occurs, and
how often term and entity share a document, wherever they stand in it. From these,

    IC(e) = -log2 p(e),   PMI(t, e) = log2 p(t, e) / (p(t) p(e)),

and a term is disclosing if PMI >= ``alpha`` IC and the pair is seen in at least ``min_support``
different texts (copies of one text are one; entities of fewer texts are left out before pairs are
made). A name in an address is tried against the term that spells it without that support: shape, not
chance, ties the two. A second pass finds such terms in the texts that hold the entity, outside values; they become
spans of kind ``term``: ``remove`` where the term gives the entity away for certain (PMI = IC),
``generalise`` otherwise. The spans of fixed shape always stay.

Cases: a null or empty text has no spans; very long texts and words are scanned whole, in linear
time; rows that repeat an id or a text each get a result; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, materialize

KINDS = ["email", "ip", "card", "phone"]
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NAME = re.compile(r"[a-z]{3,}")
_TERM = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
# ASCII letters to lower case, all ASCII that is not a letter or digit to a space
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if c > 127 or chr(c).isalnum() else 32 for c in range(256))
LEAST_BYTES = 3      # of a term in UTF-8: three ASCII letters, or one sign of most other scripts
BROADCAST_ROWS = 1 << 20  # rows (text key, chosen terms) sent to every executor at most
MAX_TERMS = 300_000  # terms counted in a task before the counts are passed on


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str):
    pos, at = 0, text.find("@")
    last = 0
    while at >= 0:
        seg = text[max(pos, last):at]
        start = max(pos, last) + len(seg.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            pos = m.end()
        last = at + 1
        at = text.find("@", max(last, pos))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of fixed shape, by kind and start; offsets in code points, end exclusive."""
    out = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    if text.count(".") >= 3:
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text)
                if all(len(p.lstrip("0")) <= 3 and int(p[-3:] if len(p) > 3 else p) <= 255 for p in m.groups())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text)
                if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


def parts_of(kind: str, value: str) -> list[str]:
    """Entities that a value stands for beside itself: the names in the local part of an address."""
    return [f"name:{x}" for x in _NAME.findall(value.lower().partition("@")[0])] if kind == "email" else []


def _places(text: str, spans: list[tuple[str, int, int]], wanted: dict[str, str]) -> list[dict]:
    """Where the wanted terms (folded, with their actions) stand in a text, outside its spans."""
    starts, reach = [], []  # spans by start, with the farthest end up to each
    for _, x, y in sorted(spans, key=lambda s: s[1]):
        starts.append(x)
        reach.append(max(y, reach[-1] if reach else 0))
    out = []
    for m in _TERM.finditer(text):
        a, b = m.span()
        term = _fold(m.group())
        if len(term) >= LEAST_BYTES:
            action = wanted.get(term.decode("utf-8", "replace"))
            if action:
                k = bisect_right(starts, b - 1)
                if not k or reach[k - 1] <= a:
                    out.append(dict(start=a, end=b, action=action))
    return out


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_SCAN = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("spans", pa.list_(_SPAN)), ("entities", pa.list_(pa.string())),
                   ("terms", pa.list_(pa.string())), ("term", pa.string()), ("docs", pa.int64())])
_SCAN_DDL = ("doc_id long, text_key long, spans array<struct<kind:string,start:long,end:long>>, "
             "entities array<string>, terms array<string>, term string, docs long")
_PLACE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("action", pa.string())]))


def _fold(term: str) -> bytes:
    return term.encode("utf-8", "surrogatepass").translate(_FOLD)


def _term_rows(counts: Counter) -> pa.RecordBatch:
    n = len(counts)
    none = [pa.nulls(n, f.type) for f in _SCAN][:5]
    terms = pa.array([t.decode("utf-8", "replace") for t in counts], pa.string())
    return pa.RecordBatch.from_arrays([*none, terms, pa.array(list(counts.values()), pa.int64())], schema=_SCAN)


def _scan(it):
    """One row for each document, with its distinct entities and, if there are any, terms; beside
    them, the task's document counts of terms."""
    counts: Counter = Counter()
    for b in it:
        cols: list[list] = [[] for _ in range(3)]
        for text in batches(b.column(2)):
            terms = {t for t in text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if len(t) >= LEAST_BYTES}
            counts.update(terms)
            spans = base_spans(text)
            for c, v in zip(cols, ([dict(kind=k, start=s, end=e) for k, s, e in spans],
                                   sorted({x for k, s, e in spans for x in (f"{k}:{text[s:e].lower()}", *parts_of(k, text[s:e]))}),
                                   [t.decode("utf-8", "replace") for t in terms] if spans else []), strict=True):
                c.append(v)
            if len(counts) >= MAX_TERMS:
                yield _term_rows(counts)
                counts = Counter()
        n = b.num_rows
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(c, f.type) for c, f in zip(cols, list(_SCAN)[2:5], strict=True)],
                                          pa.nulls(n, pa.string()), pa.nulls(n, pa.int64())], schema=_SCAN)
    if counts:
        yield _term_rows(counts)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One pass over the texts, written to the shared folder: spans, entities and terms of each
    row, and document counts of terms (``term`` not null)."""
    return materialize(_keyed(docs, id_col, text_col).mapInArrow(_scan, _SCAN_DDL))


def disclosing(scanned: DataFrame, alpha: float = 0.9, min_support: int = 2) -> DataFrame:
    """(entity, term, pmi, ic, action) of the terms over the threshold."""
    rows = scanned.where("term IS NULL")
    n = float(rows.count())
    held = rows.where("size(entities) > 0").select("text_key", "terms", F.explode("entities").alias("entity"))
    names = F.col("entity").startswith("name:")
    ents = materialize(held.groupBy("entity", "text_key").agg(F.count(F.lit(1)).alias("c")).groupBy("entity")
                       .agg(F.sum("c").alias("c_e"), F.count(F.lit(1)).alias("texts")).where((F.col("texts") >= min_support) | names))
    seen = held.join(ents.where(~names).select("entity"), "entity", "left_semi").select("entity", "text_key", F.explode("terms").alias("term"))
    spelt = held.where(names).withColumn("term", F.expr("substring(entity, 6)")).where(F.array_contains("terms", F.col("term"))) \
        .select("entity", "text_key", "term")  # a row for each name, not for each term of its text
    texts = seen.unionByName(spelt).groupBy("entity", "term", "text_key").agg(F.count(F.lit(1)).alias("c"))
    both = materialize(texts.groupBy("entity", "term").agg(F.sum("c").alias("c_et"), F.count(F.lit(1)).alias("support"))
                       .where((F.col("support") >= min_support) | names))
    wanted = both.select("term").distinct()
    terms = scanned.where("term IS NOT NULL").groupBy("term").agg(F.sum("docs").alias("c_t")).join(wanted, "term", "left_semi")
    j = both.join(ents.select("entity", "c_e"), "entity").join(terms, "term")
    ic = -F.log2(F.col("c_e") / F.lit(n))
    pmi = F.log2(F.lit(n) * F.col("c_et") / (F.col("c_e") * F.col("c_t")))
    return j.withColumn("ic", ic).withColumn("pmi", pmi).where(F.col("pmi") >= alpha * F.col("ic")).where("ic > 0") \
        .select("entity", "term", "pmi", "ic", F.when(F.col("pmi") >= F.col("ic") - 1e-9, "remove").otherwise("generalise").alias("action"))


def _find(it):
    for b in it:
        places = [_places(t, base_spans(t), {x["term"]: x["action"] for x in w})
                  for t, w in zip(batches(b.column("text")), b.column("wanted").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("text_key"), pa.array(places, _PLACE)], names=["text_key", "t"])


def find(docs: DataFrame, alpha: float = 0.9, min_support: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: doc_id and ``spans`` (kind, start, end, action), by kind and
    start, disclosing terms last."""
    scanned = scan(docs, id_col, text_col)
    found = disclosing(scanned, alpha, min_support)
    rows = scanned.where("term IS NULL")
    texts = rows.where("size(entities) > 0").select("text_key", F.explode("entities").alias("entity")).distinct()
    chosen = materialize(texts.join(found, "entity").groupBy("text_key", "term").agg(F.max("action").alias("action"))
                         .groupBy("text_key").agg(F.collect_list(F.struct("term", "action")).alias("wanted")))
    few = F.broadcast(chosen) if chosen.count() <= BROADCAST_ROWS else chosen  # a row for each text to look at; no text is shuffled for few
    places = _keyed(docs, id_col, text_col).select("text_key", "text").join(few, "text_key") \
        .mapInArrow(_find, "text_key long, t array<struct<start:long,end:long,action:string>>")
    added = materialize(places.groupBy("text_key").agg(F.first("t").alias("t")))  # copies of a text have the same places
    none = "array<struct<kind:string,start:bigint,end:bigint,action:string>>"
    base = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                                                   F.lit("replace").alias("action")))
    more = F.transform("t", lambda s: F.struct(F.lit("term").alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                                               s["action"].alias("action")))
    return rows.join(added, "text_key", "left").select(
        "doc_id", F.concat(base, F.coalesce(more, F.array().cast(none))).alias("spans"))


def sanitise_text(text: str | None, spans) -> str:
    """The text with its spans replaced: values by their kind, generalised terms by the class of
    the word, removed terms by nothing. Where spans overlap, the first kind in order wins."""
    text = text or ""
    out, taken = [], []
    for s in spans or []:
        kind, a, b, action = s["kind"], s["start"], s["end"], s["action"]
        if not any(a < y and x < b for x, y, _ in taken):
            word = "number" if text[a:b].isdigit() else "name" if text[a:a + 1].isupper() else "word"
            taken.append((a, b, f"[{kind.upper()}]" if action == "replace" else "" if action == "remove" else f"[{word}]"))
    at = 0
    for a, b, new in sorted(taken):
        out += [text[at:a], new]
        at = b
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text sanitised by the spans of ``find`` (one row for each id)."""
    def run(it):
        for b in it:
            texts = [sanitise_text(t, s) for t, s in zip(b.column(text_col).to_pylist(), b.column("pii_spans").to_pylist(), strict=True)]
            cols = [pa.array(texts, pa.string()) if n == text_col else b.column(n) for n in b.schema.names if n != "pii_spans"]
            yield pa.RecordBatch.from_arrays(cols, names=[n for n in b.schema.names if n != "pii_spans"])
    f = found.select(F.col("doc_id").alias("pii_id"), F.col("spans").alias("pii_spans")).dropDuplicates(["pii_id"])
    return docs.join(f, docs[id_col].eqNullSafe(f["pii_id"]), "left").drop("pii_id").mapInArrow(run, docs.schema)
