"""Operator 8: best-fit decreasing packing of documents into training sequences.

Only documents longer than a sequence are cut.  Pieces are dealt into large groups by a hash (a group holds
``GROUP_PIECES`` pieces at most on average and fits one task); each group is packed by best-fit decreasing with a
segment tree over remaining capacities.  A group leaves only its last few sequences unfilled, so the loss against one
global packing is a few sequences per hundred thousand pieces.

Defined results.  Null and empty texts are one end token.  Repeated rows are packed once per row.  A null doc_id stays
null.  An empty table gives no rows.  Ties in length are taken in (doc_id, piece) order.  Only the named columns are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weighline.llm import common as C
from weighline.llm.encoding import encoder

GROUP_PIECES = 100_000

_PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("salt", pa.int64())])
_PACKED = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
PACKED_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class OpenBins:
    """Bins by remaining capacity: a segment tree over 0..capacity tells the tightest that still takes a length."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, remaining: int, number: int) -> None:
        self.bins[remaining].append(number)
        i = remaining + self.leaves
        while i and not self.any[i]:
            self.any[i] = 1
            i >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove and return (remaining, bin) of the tightest bin with at least ``length`` left; None without one."""
        any_, i = self.any, length + self.leaves
        if not any_[i]:
            while i > 1 and (i & 1 or not any_[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if any_[2 * i] else 2 * i + 1
        remaining = i - self.leaves
        number = self.bins[remaining].pop()
        if not self.bins[remaining]:
            any_[i] = 0
            i >>= 1
            while i and not (any_[2 * i] or any_[2 * i + 1]):
                any_[i] = 0
                i >>= 1
        return remaining, number


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every length, given in descending order."""
    open_bins, bins, offsets, made = OpenBins(capacity), np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for k, length in enumerate(lengths.tolist()):
        found = open_bins.take(length)
        if found is None:
            remaining, number, made = capacity, made, made + 1
        else:
            remaining, number = found
        bins[k], offsets[k] = number, capacity - remaining
        if remaining > length:
            open_bins.put(remaining - length, number)
    return bins, offsets


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's pieces of at most ``capacity`` tokens; ``salt`` tells repeated rows of a task apart."""
    def cut(batches):
        enc, count = encoder(tokenizer), 0
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        for b in batches:
            rows = []
            for doc_id, ids in zip(b.column(0).to_pylist(), enc.ids(b.column(1).to_pylist())):
                wide = np.frombuffer(ids + end, dtype=enc.dtype).astype("<u4")
                for p, start in enumerate(range(0, len(wide), capacity)):
                    part = wide[start:start + capacity]
                    count += 1
                    rows.append((doc_id, p, start, len(part), zlib.crc32(part.tobytes()), count))
            if rows:
                yield C.batch(_PIECE, **dict(zip(_PIECE.names, zip(*rows))))

    return C.map_arrow(docs.select(F.col(id_col).cast("long"), C.text_of(text_col)), cut,
                       "doc_id long, piece int, start long, length long, ids_crc32 long, salt long")


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece with its sequence and place in it."""
    cut = C.table(pieces(docs, tokenizer, end_id, capacity, id_col, text_col), "pieces")
    groups = max(1, -(-cut.count() // GROUP_PIECES))
    dealt = (cut.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "salt"), F.lit(groups)))
             .repartition(groups, "grp").sortWithinPartitions("grp", F.desc("length"), "doc_id", "piece", "ids_crc32", "salt"))

    def place(batches):
        held, current = [], None

        def packed():
            rows = pa.Table.from_batches(held)
            bins, offsets = best_fit(rows["length"].to_numpy(), capacity)
            for start in range(0, len(bins), 10_000):
                part, s = rows.slice(start, 10_000), slice(start, start + 10_000)
                yield C.batch(_PACKED, **{k: part[k].combine_chunks() for k in _PACKED.names[:5]},
                              sequence_id=(current << 40) + bins[s], offset=offsets[s])

        for b in batches:
            grp = b.column("grp").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(grp)) + 1), len(grp)]
            for a, e in zip(edges, edges[1:]):
                if a == e:
                    continue
                if held and grp[a] != current:
                    yield from packed()
                    held = []
                current = int(grp[a])
                held.append(b.slice(a, e - a))
        if held:
            yield from packed()

    return C.map_arrow(dealt, place, PACKED_SCHEMA)
