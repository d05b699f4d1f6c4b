"""Operator 2: exact deduplication with an extendible-hash index on shared files.

1. Every task that reads documents folds equal texts of its own rows, so a text leaves a task once however often it
   occurs there, with the count and the row to keep.  Documents themselves stay behind as small member rows.
2. Owner tasks each hold ranges of the hash key (its top bits).  An owner inserts what it gets into an extendible
   hash: a directory of 2^depth pointers to buckets; a bucket with too many keys is split on its next bit, and the
   directory doubles when the bucket was as deep as the directory.  Different texts with one hash are chained in their
   slot and told apart by comparing bytes.
3. The index is written as a table of slots (owner, depth and prefix of the bucket, hash, place in the chain) to the
   shared folder; members find their class in it by the folded row they belong to.

A group that holds a third of all rows reaches its owner as one row per reading task.  An owner's memory holds the
distinct texts of one key range, about ``OWNER_BYTES``; ranges are as many as the text needs.

Defined results.  Null text equals the empty text.  Of equal texts the row with the largest doc_id stays, a null
doc_id being smaller than any; of repeated rows exactly one stays.  An empty table gives no rows.  Only the two named
columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from weighline.llm import common as C

#: Text bytes an owner's key range should hold; keys a bucket holds before it is split.
OWNER_BYTES, BUCKET_KEYS = 32 << 20, 64
_LOW = -(1 << 63)

_FOLDED = pa.schema([("kind", pa.int8()), ("rep", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("sha", pa.string()),
                     ("h", pa.int64()), ("n", pa.int64()), ("size", pa.int64()), ("text", pa.binary())])
FOLDED_SCHEMA = "kind byte, rep long, row long, doc_id long, sha string, h long, n long, size long, text binary"
_MEMBER, _TEXT, _TOTAL = 0, 1, 2
_SLOT = pa.schema([("owner", pa.int64()), ("depth", pa.int32()), ("prefix", pa.int64()), ("h", pa.int64()), ("chain", pa.int32()),
                   ("rep", pa.int64()), ("keep_id", pa.int64()), ("keep_row", pa.int64()), ("group_size", pa.int64())])
SLOT_SCHEMA = ("owner long, depth int, prefix long, h long, chain int, rep long, keep_id long, keep_row long, group_size long")


class Bucket:
    __slots__ = ("depth", "slots")

    def __init__(self, depth: int):
        self.depth, self.slots = depth, {}


class ExtendibleHash:
    """Keys of ``bits`` bits; ``slot(key)`` is the chain of a key, made where missing."""

    def __init__(self, bits: int, capacity: int = BUCKET_KEYS):
        self.bits, self.capacity, self.depth = bits, capacity, 0
        self.directory = [Bucket(0)]

    def slot(self, key: int) -> list:
        while True:
            bucket = self.directory[key >> (self.bits - self.depth)]
            chain = bucket.slots.get(key)
            if chain is not None:
                return chain
            if len(bucket.slots) < self.capacity or bucket.depth == self.bits:
                return bucket.slots.setdefault(key, [])
            self._split(bucket, key >> (self.bits - self.depth))

    def _split(self, bucket: Bucket, at: int) -> None:
        if bucket.depth == self.depth:  # double the directory: every pointer twice
            self.directory = [b for b in self.directory for _ in (0, 1)]
            self.depth += 1
            at *= 2
        halves = Bucket(bucket.depth + 1), Bucket(bucket.depth + 1)
        shift = self.bits - bucket.depth - 1
        for key, chain in bucket.slots.items():
            halves[key >> shift & 1].slots[key] = chain
        width = 1 << (self.depth - bucket.depth)  # pointers to the old bucket, side by side
        start = at & ~(width - 1)
        for i in range(width):
            self.directory[start + i] = halves[2 * i >= width]

    def buckets(self) -> Iterator[tuple[int, Bucket]]:
        """(first directory position, bucket), each bucket once."""
        i = 0
        while i < len(self.directory):
            yield i, self.directory[i]
            i += 1 << (self.depth - self.directory[i].depth)


def fold(docs: DataFrame, hash_bits: int, id_col: str, text_col: str) -> DataFrame:
    """Member rows of all documents, and per task one text row and one total row for each distinct text."""
    def run(batches):
        base, count, seen = TaskContext.get().partitionId() << 36, 0, {}
        for b in batches:
            out = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                data = text.encode()
                digest = hashlib.sha256(data).digest()
                row, count = base + count, count + 1
                order = (_LOW if doc_id is None else doc_id, -row)
                entry = seen.get(digest)
                if entry is None:
                    entry = seen[digest] = [row, order, 0]
                    h = int.from_bytes(digest[:8], "big") >> (64 - hash_bits)
                    out.append((_TEXT, row, None, None, None, h, None, len(data), data))
                entry[1] = max(entry[1], order)
                entry[2] += 1
                out.append((_MEMBER, entry[0], row, doc_id, digest.hex(), None, None, None, None))
            if out:
                yield C.batch(_FOLDED, **dict(zip(_FOLDED.names, zip(*out))))
        totals = [(_TOTAL, rep, -order[1], None if order[0] == _LOW else order[0], None,
                   int.from_bytes(digest[:8], "big") >> (64 - hash_bits), n, None, None)
                  for digest, (rep, order, n) in seen.items()]
        for i in range(0, len(totals), 20_000):
            yield C.batch(_FOLDED, **dict(zip(_FOLDED.names, zip(*totals[i:i + 20_000]))))

    return C.map_arrow(docs.select(F.col(id_col).cast("long"), C.text_of(text_col)), run, FOLDED_SCHEMA)


def owned(batches, owner_bits: int, hash_bits: int, capacity: int):
    """Insert every owner's rows, which come one owner after the other, and give the slots of its index."""
    current, index, totals = None, None, {}

    def slots():
        rows = []
        for first, bucket in index.buckets():
            prefix = first >> (index.depth - bucket.depth)
            for key, chain in bucket.slots.items():
                for place, (_, reps) in enumerate(chain):
                    found = [totals[r] for r in reps]
                    keep_id, keep_row = max((i, -r) for i, r, _ in found)
                    size = sum(n for _, _, n in found)
                    rows += [(current, bucket.depth, prefix, current << (hash_bits - owner_bits) | key, place, r,
                              None if keep_id == _LOW else keep_id, -keep_row, size) for r in reps]
        for i in range(0, len(rows), 20_000):
            yield C.batch(_SLOT, **dict(zip(_SLOT.names, zip(*rows[i:i + 20_000]))))

    for b in batches:
        for owner, h, rep, kind, doc_id, row, n, text in zip(*(c.to_pylist() for c in b.columns)):
            if owner != current:
                if index is not None:
                    yield from slots()
                current, index, totals = owner, ExtendibleHash(hash_bits - owner_bits, capacity), {}
            if kind == _TOTAL:
                totals[rep] = (_LOW if doc_id is None else doc_id, row, n)
                continue
            chain = index.slot(h & ((1 << (hash_bits - owner_bits)) - 1))
            for known, reps in chain:
                if known == text:
                    reps.append(rep)
                    break
            else:
                chain.append((text, [rep]))
    if index is not None:
        yield from slots()


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 62,
                bucket_keys: int = BUCKET_KEYS) -> tuple[DataFrame, DataFrame]:
    """(documents, index).  Documents: doc_id, keep_id, group_size, kept, text_sha256, one row per row of the input.
    Index: one row per slot entry, a table in the shared folder."""
    folded = C.table(fold(docs, hash_bits, id_col, text_col), "folded")
    spark = docs.sparkSession
    size = folded.where(F.col("kind") == _TEXT).agg(F.sum("size")).first()[0] or 0
    owners = C.partitions_for(spark, size, OWNER_BYTES)
    owner_bits = min(hash_bits, (owners - 1).bit_length())
    index = C.table(C.map_arrow(
        folded.where(F.col("kind") != _MEMBER)
        .select(F.shiftright("h", hash_bits - owner_bits).alias("owner"), "h", "rep", "kind", "doc_id", "row", "n", "text")
        .repartition(owners, "owner").sortWithinPartitions("owner"),
        lambda batches: owned(batches, owner_bits, hash_bits, bucket_keys), SLOT_SCHEMA), "index")
    members = folded.where(F.col("kind") == _MEMBER).select("rep", "row", "doc_id", F.col("sha").alias("text_sha256"))
    found = index.select("rep", "keep_id", "keep_row", "group_size")
    return (members.join(found, "rep").select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
                                              "text_sha256"), index)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; of rows repeated with one id, any one."""
    found = exact_dedup(docs, id_col, text_col)[0].where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__of"))
    marked = docs.withColumn("__sha", F.sha2(C.text_of(text_col).cast("binary"), 256))
    return C.one_each(marked, found, (marked["__sha"] == found["__of"]) & marked[id_col].eqNullSafe(found["__id"]), [id_col, "__sha"], docs.columns)
