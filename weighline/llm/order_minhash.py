"""Operator 6: Order MinHash fingerprints, sensitive to edit distance.

Every k-mer of code points gets its occurrence number in the text, so repeats count.  A hash of (k-mer, number) deals
them into ``BINS`` bins; of each bin the ``PICK`` smallest are taken, put back into text order, and their k-mers in
that order are hashed to one component.  Two texts' likeness is the share of equal components among those that either
has, so both the k-mers and their order must agree.

To compare every document with the next one by doc_id, rows are dealt into ranges of doc_id whose bounds come from
quantiles of that column; the first document of the following range travels along as a guest, so texts are moved once
and no task sees more than its range.

Defined results.  Null text is empty: no component, likeness 1 to another empty text and 0 to any other.  A text shorter
than k is one k-mer.  Rows with equal doc_id are ordered by text; a null doc_id comes first.  The document after the
last is the first (a lone document follows itself).  An empty table gives no rows.  Only the two named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

from weighline.llm import common as C

K, BINS, PICK = 7, 64, 2
#: Documents of one range of doc_id, about.
RANGE_ROWS = 20_000
_LOW = -(1 << 63)

_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                  ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
OUT_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")


def kmer_hashes(text: str, k: int) -> np.ndarray:
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if not len(x):
        return x
    k = min(k, len(x))
    h = np.zeros(len(x) - k + 1, np.uint64)
    for j in range(k):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += x[j:j + len(h)] + np.uint64(1)
    return C.mix64(h)


def fingerprint(text: str, k: int = K, bins: int = BINS, pick: int = PICK) -> np.ndarray:
    """``bins`` 16-bit components; 0 for a bin without a k-mer."""
    out = np.zeros(bins, np.uint16)
    h = kmer_hashes(text, k)
    n = len(h)
    if not n:
        return out
    at = np.argsort(h, kind="stable")  # by k-mer, then by place
    kmers = h[at]
    first = np.flatnonzero(np.concatenate(([True], kmers[1:] != kmers[:-1])))
    number = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    keyed = C.mix64(kmers + C.mix64(number.astype(np.uint64) + np.uint64(1)))  # whole hashes: a k-mer's key is the same in every text
    order = np.argsort(keyed, kind="stable")
    keyed, at = keyed[order], at[order]
    edges = np.searchsorted(keyed, (np.arange(bins, dtype=np.uint64) << np.uint64(64 - (bins - 1).bit_length())))
    ends = np.append(edges[1:], n)
    chosen = np.full((bins, pick), -1, np.int64)
    for p in range(pick):
        has = edges + p < ends
        chosen[has, p] = at[(edges + p)[has]]
    chosen.sort(axis=1)  # text order; missing picks come first
    code = np.zeros(bins, np.uint64)
    for p in range(pick):
        has = chosen[:, p] >= 0
        code[has] = C.mix64(code[has] * np.uint64(0x9E3779B97F4A7C15) + h[chosen[has, p]])
    filled = edges < ends
    out[filled] = (code[filled] >> np.uint64(48)).astype(np.uint16) % 65535 + 1
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal components among those that either text has; 1 for two empty texts."""
    either = (a != 0) | (b != 0)
    return float(((a == b) & either).sum() / either.sum()) if either.any() else 1.0


def shown(f: np.ndarray) -> str:
    return f.astype(">u2").tobytes().hex()


def compare_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text (last quarter exchanged for the next document's beginning),
    and the likeness of the text to both neighbours."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), C.text_of(text_col).alias("text"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(_LOW)).alias("at"))
    count = rows.count()
    n = C.partitions_for(spark, count, RANGE_ROWS)
    bounds = rows.where("doc_id IS NOT NULL").approxQuantile("at", [i / n for i in range(1, n)], 0.25 / n) if count else []
    splits = [float("-inf"), *(sorted({float(b) for b in bounds}) or [0.0]), float("inf")]
    rows = (Bucketizer(splits=splits, inputCol="key", outputCol="range").transform(rows.withColumn("key", F.col("at").cast("double")))
            .select("doc_id", "text", "at", F.col("range").cast("int").alias("part")))
    # the first doc_id of every range that has rows: one row per range
    firsts = sorted((r["part"], r["first"]) for r in rows.groupBy("part").agg(F.min("at").alias("first")).collect())
    follows = [(firsts[(i + 1) % len(firsts)][1], part) for i, (part, _) in enumerate(firsts)]
    guests = (rows.drop("part").join(F.broadcast(spark.createDataFrame(follows, "first long, part int")), F.col("at") == F.col("first"))
              .select("doc_id", "text", "at", "part", F.lit(True).alias("guest")))
    dealt = (rows.withColumn("guest", F.lit(False)).unionByName(guests).repartition(n, "part")
             .sortWithinPartitions("part", "guest", "at", "text").select("part", "guest", "doc_id", "text"))

    def run(batches):
        held, closed = None, None  # the document that waits for its next one; the range whose guest was seen

        def row(next_text, next_print):
            doc_id, text, own = held
            quarter = len(text) // 4
            edited = text[:len(text) - quarter] + next_text[:quarter]
            changed = fingerprint(edited) if edited != text else own
            return (doc_id, len(text), C.sha(edited.encode()), shown(own), shown(changed), likeness(own, changed), likeness(own, next_print))

        for b in batches:
            out = []
            for part, guest, doc_id, text in zip(*(c.to_pylist() for c in b.columns)):
                if guest and closed == part:
                    continue  # another row with the same first doc_id; the one before it is the next document
                own = fingerprint(text)
                if held is not None:
                    out.append(row(text, own))
                held = None if guest else (doc_id, text, own)
                closed = part if guest else closed
            if out:
                yield C.batch(_OUT, **dict(zip(_OUT.names, zip(*out))))

    return C.map_arrow(dealt, run, OUT_SCHEMA)
