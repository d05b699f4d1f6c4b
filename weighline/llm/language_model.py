"""Operator 7: a language model of texts by logistic mixing of hashed-context bit predictors, and a unigram base.

A text is its words, each spelled in bytes and closed by a space, then an end mark; its probability is the product over
all bits.  Five predictors each look up one hashed context (the last one to four bytes of the word, and the whole word
so far) and give the share of ones seen there.  Their log-odds are mixed by weights that a gate selects (how often the
two longest contexts were seen); the mix is refined by an adaptive map from (gate, probability) to outcomes.

A text is read on across the borders of its words.  Near a word's beginning (and at the end mark) three more predictors
look up the last two, three and four bytes of the text, whatever words they belong to; a second mixer takes the first
one's result and theirs, by a gate of its own, and has a refinement of its own.  From a word's fourth byte on, the last
four bytes lie in the word and its closing space before it, so nothing more is seen of the text.

What is learned from the corpus, all of it from every training token.  Word counts; from them the byte code and every
predictor's bit counts.  Weights are fitted by Newton steps on the log loss of all training tokens, each bit predicted as
if its own occurrence had not been counted; the refinement holds the outcomes of the same bits.  A round is one pass over
the counted words and a step is kept only where it lowers the loss.  The second mixer is fitted the same way after the
first, on all openings: a word's first three bytes and end marks, each with the text before it.  Sums do not depend, but
for rounding, on how the corpus is partitioned.

How it scales.  What the text before a word cannot change is worked out once per distinct word; an opening is four bytes
and its depth, so equal ones are worked out once too.  A task folds a block of documents into its distinct words, the
order they stand in, and its counted openings.  Words travel dealt by ranges to be counted, each then one row with its
places; openings are packed and dealt by hashes.  Words of a range begin alike, and what they share is worked out once per
batch.  A range's counts and scores go back as one row per block, where the order of the words gives the openings again.
The most frequent word travels once per block.  Predictor tables have a fixed number of slots, and a task sends the used
ones of its part in few bytes.

Defined results.  Null text is empty: one end token.  Before a text's first word stand zeros and a space.  A null doc_id is
neither learned from nor held out.  Without training documents N and V are 0 and every context is unseen.  Repeated rows
give repeated results; an empty table gives no rows.  Only the two named columns are read.
"""

from __future__ import annotations

import heapq
import zlib
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, functions as F

from weighline.llm import common as C

FOLDS, HELD_OUT = 7, 2
#: A block of documents ends after so many characters or documents.
BLOCK_CHARS, BLOCK_DOCUMENTS = 32_000_000, 60_000
#: Slots of each predictor's table, as powers of two: contexts of 1, 2, 3 and 4 bytes, and of the word so far.
TABLE_BITS = (16, 18, 20, 21, 22)
#: The first bytes of a word from which the text before its space is still among the last four bytes.  Slots of the tables of
#: the last two, three and four bytes of the text there.  Parts that the openings of a depth are dealt to; openings in one row.
OPENING, ACROSS_BITS, PARTS, OPENINGS = 3, (18, 20, 22), 64, 2_000
#: Passes over the counted words that fit the weights; the pull towards the blank ones, in bits; occurrences that a
#: refinement's level counts for.
ROUNDS, PULL, LEVEL = 3, 1.0, 50.0
#: Words spelled out at a time, and their bytes worked on at a time; tokens of whole documents worked on at a time; rows of
#: words in one range; slots sent in one row.
WORDS, BYTES, STRETCH, RANGE_WORDS, CHUNK = 10_000, 50_000, 1 << 19, 400_000, 1 << 14
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_AB = np.uint64(int(_A) * int(_B) % (1 << 64))
#: Steps of the gates' counts and of the refinement's log-odds.
_STEPS = np.array([1, 3, 10, 100, 2000])
_BUCKETS = 33
#: Added to a count before its logarithm is taken, and the logarithms of small counts.
_BLANK = 0.02
_LOGS = np.log(np.arange(1 << 14) + _BLANK)

_OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                  ("base_score", pa.float64()), ("score", pa.float64()), ("bits_per_byte", pa.float64())])
OUT_SCHEMA = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
              "bits_per_byte double")
#: A block's head: ids, folds, words and bytes of its documents; first and last bytes of its distinct words; their order.  Rows of
#: openings (codes below -1, by depth and part) hold them in place of a word, and their counts in place of a head.
_FOLD = pa.schema([("block", pa.int64()), ("code", pa.int32()), ("word", pa.binary()), ("train", pa.int64()), ("head", pa.list_(pa.binary()))])
FOLD_SCHEMA = "block long, code int, word binary, train long, head array<binary>"
#: Folds of a document: learned from, held out, neither.
_TRAIN, _HELD, _NEITHER = 0, 1, 2


def mapped(df: DataFrame, fn, schema: str, *rows: int) -> DataFrame:
    """:func:`common.map_arrow`; memory that Arrow's pool keeps but no longer uses is given back when a task ends, as its worker
    lives on."""
    def run(batches):
        yield from fn(batches)
        pa.default_memory_pool().release_unused()

    return C.map_arrow(df, run, schema, *rows)


def fold_of(doc_id: int | None) -> int:
    return _NEITHER if doc_id is None else _HELD if zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT else _TRAIN


def edges(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(first three bytes of every word with the space after it, last three of it with the space before it), as numbers; 0
    stands for a byte that is not there."""
    start, end = (np.frombuffer(words.buffers()[1], np.int32, len(words), 4 * (words.offset + i)) for i in (0, 1))
    data = np.concatenate([np.frombuffer(words.buffers()[2] or b"", np.uint8), np.zeros(3, np.uint8)])
    size = end - start
    first, last = (np.zeros(len(words), np.uint32) for _ in range(2))
    for i in range(3):
        first |= np.where(size > i, data[start + i], np.where(size == i, 32, 0)).astype(np.uint32) << np.uint32(16 - 8 * i)
        last |= np.where(size > i, data[np.maximum(end - 1 - i, 0)], np.where(size == i, 32, 0)).astype(np.uint32) << np.uint32(8 * i)
    return first, last


def stretches(lengths: np.ndarray):
    """(documents, their tokens) of a block, some documents at a time, as slices."""
    end = np.cumsum(lengths)
    a = start = 0
    while a < len(end):
        e = max(a + 1, int(np.searchsorted(end, start + STRETCH, "right")))
        yield slice(a, e), slice(start, int(end[e - 1]))
        a, start = e, int(end[e - 1])


def openings(code: np.ndarray, lengths: np.ndarray, first: np.ndarray, last: np.ndarray):
    """Per depth below ``OPENING``: of every byte that stands so deep in its word, the byte after three before it, the space
    before the word left out, as a number; and its document.  ``code``: the words of all documents in order, so many each."""
    end = np.cumsum(lengths)
    some = lengths > 0
    follows = np.ones(len(code), bool)
    follows[(end - lengths)[some]] = False  # a document's first word
    after = last[code]  # the three bytes before the space that closes the word
    lone = after >> np.uint32(8) == 32  # a word of one byte: the end of the word before it is seen too
    filled = np.flatnonzero(lone & follows)
    after[filled] |= (last[code[filled - 1]] & np.uint32(255)) << np.uint32(16)
    before = np.zeros_like(after)
    before[1:] = after[:-1]
    before[~follows] = 0
    closing = np.zeros(len(lengths), np.uint32)
    closing[some] = after[end[some] - 1]
    begun, doc = first[code], np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    yield 0, np.concatenate([before << np.uint32(8) | begun >> np.uint32(16), closing << np.uint32(8) | np.uint32(0xff)]), \
        np.concatenate([doc, np.arange(len(lengths), dtype=np.int32)])
    yield 1, before << np.uint32(16) | begun >> np.uint32(8), doc
    longer = ~lone
    yield 2, before[longer] << np.uint32(24) | begun[longer], doc[longer]


def folded(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per block: one row with its documents, the order of their words and training documents (code -1), one row per distinct
    word with its count in training documents, and rows of openings with theirs (codes below -1)."""
    def one_block(block: int, ids: list, lengths: list[int], words: list[pa.Array]) -> pa.RecordBatch:
        lengths = np.array(lengths, np.int64)
        folds = np.array([fold_of(i) for i in ids], np.uint8)
        learned = folds == _TRAIN
        coded = pa.chunked_array(words, pa.binary()).dictionary_encode().chunks  # all of one dictionary; none without words
        coded = coded or [pa.array([], pa.binary()).dictionary_encode()]
        vocabulary = coded[0].dictionary
        code = np.concatenate([c.indices.to_numpy() for c in coded])
        first, last = edges(vocabulary)
        width = pc.binary_length(vocabulary).to_numpy().astype(np.float64)
        sizes, train = lengths + 1, np.zeros(len(vocabulary), np.int64)
        opened: list[list] = [[] for _ in range(OPENING)]
        for docs_, tokens in stretches(lengths):
            of = np.repeat(np.arange(docs_.stop - docs_.start), lengths[docs_])
            sizes[docs_] += np.bincount(of, weights=width[code[tokens]], minlength=docs_.stop - docs_.start).astype(np.int64)
            train += np.bincount(code[tokens][learned[docs_][of]], minlength=len(vocabulary))
            for depth, key, of in openings(code[tokens], lengths[docs_], first, last):
                opened[depth].append(np.unique(key[learned[docs_][of]], return_counts=True))
        doc_ids = np.array([i or 0 for i in ids], np.int64)  # a null one is known by its fold
        codes, keys, heads = [-1], [None], [[doc_ids.tobytes(), folds.tobytes(), lengths.tobytes(), sizes.tobytes(), *map(planes, (first, last, code))]]
        for depth, found in enumerate(opened):
            found, n = merged(found)
            part = found * np.uint32(0x9E3779B1) >> np.uint32(26)
            order = np.argsort(part, kind="stable")
            found, n, part = found[order], n[order], part[order].astype(np.int64)
            cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
            for a, e in zip(cuts, cuts[1:]):
                codes.append(-2 - depth * PARTS - part[a])
                keys.append(found[a:e].tobytes())
                heads.append([narrow(n[a:e])])
        kind, packed = _FOLD.field("head").type, len(codes)
        return C.batch(_FOLD, block=np.full(packed + len(vocabulary), block),
                       code=np.concatenate([np.array(codes, np.int32), np.arange(len(vocabulary), dtype=np.int32)]),
                       word=pa.concat_arrays([pa.array(keys, pa.binary()), vocabulary]),
                       train=np.concatenate(([learned.sum()], np.zeros(packed - 1, np.int64), train)),
                       head=pa.concat_arrays([pa.array(heads, kind), pa.nulls(len(vocabulary), kind)]))

    def run(batches):
        block, ids, lengths, words, held, chars = TaskContext.get().partitionId() << 32, [], [], [], [], 0
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                split = text.encode().lower().split()  # bytes: A-Z alone is lowered, and the six spaces alone split
                ids.append(doc_id)
                lengths.append(len(split))
                held += split
                chars += len(text)
                full = chars >= BLOCK_CHARS or len(ids) >= BLOCK_DOCUMENTS
                if full or len(held) >= WORDS:
                    words.append(pa.array(held, pa.binary()))
                    held = []
                if full:
                    yield one_block(block, ids, lengths, words)
                    block, ids, lengths, words, chars = block + 1, [], [], [], 0
        if ids:
            yield one_block(block, ids, lengths, [*words, pa.array(held, pa.binary())])

    return mapped(docs.select(F.col(id_col).cast("long"), C.text_of(text_col)), run, FOLD_SCHEMA)


def narrow(x: np.ndarray) -> bytes:
    """The numbers in the fewest bytes each, after one byte that tells how many."""
    kind = np.min_scalar_type(int(x.max(initial=0)))
    return bytes([kind.itemsize]) + x.astype(kind).tobytes()


def widened(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def merged(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, their counts) of several such pairs."""
    key, n = (np.concatenate(x) for x in zip(*counts))
    key, which = np.unique(key, return_inverse=True)
    return key, np.bincount(which, weights=n, minlength=len(key)).astype(np.int64)


def planes(x: np.ndarray) -> bytes:
    """The numbers, below 2^32, compressed: how many, then all lowest bytes, all next ones, and so on."""
    apart = np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(x).to_bytes(8, "little") + pa.compress(apart, codec="zstd", asbytes=True)


def joined(data) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    apart = np.frombuffer(pa.decompress(data[8:], 4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(apart.T).view("<u4").ravel()


def packed(table: np.ndarray) -> tuple[bytes, tuple[int, ...]]:
    """A table of floats, few of them large, as bytes of equal place together, compressed."""
    return pa.compress(np.ascontiguousarray(table.view(np.uint8).reshape(-1, 4).T), codec="zstd", asbytes=True), table.shape


def unpacked(data: bytes, shape: tuple[int, ...]) -> np.ndarray:
    flat = pa.decompress(data, 4 * int(np.prod(shape)), codec="zstd", asbytes=True)
    return np.frombuffer(flat, np.uint8).reshape(4, -1).T.copy().view(np.float32).reshape(shape)


def opened(fold: DataFrame) -> DataFrame:
    """(depth, keys, counts): every opening in all training documents with its count, many in a row."""
    schema = pa.schema([("depth", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])

    def run(batches):
        code, held, size, limit = None, [], 0, 0

        def rows():
            key, n = merged(held)
            cuts = range(0, len(key), OPENINGS)
            return C.batch(schema, depth=[(-2 - code) // PARTS] * len(cuts), keys=[key[s:s + OPENINGS].tobytes() for s in cuts],
                           counts=[narrow(n[s:s + OPENINGS]) for s in cuts])

        for b in batches:
            for at, keys, (counts,) in zip(*(c.to_pylist() for c in b.columns)):
                if at != code:
                    if held:
                        yield rows()
                    code, held, size, limit = at, [], 0, 1 << 20
                held.append((np.frombuffer(keys, np.uint32), widened(counts)))
                size += len(held[-1][0])
                if size >= limit:
                    held = [merged(held)]
                    size = len(held[0][0])
                    limit = 2 * size + (1 << 20)
        if held:
            yield rows()

    parts = fold.where("code < -1").select("code", "word", "head").repartition("code").sortWithinPartitions("code")
    return mapped(parts, run, "depth int, keys binary, counts binary")


def counted(fold: DataFrame) -> DataFrame:
    """(word, c, at): every distinct word, its count in all training documents, and the blocks it stands in with its
    code there, as pairs of numbers."""
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64()), ("at", pa.binary())])

    def one(rows: pa.RecordBatch, start: np.ndarray) -> pa.RecordBatch:
        train, block, code = (rows.column(n).to_numpy() for n in ("train", "block", "code"))
        pairs = np.stack([block, code.astype(np.int64)], axis=1)
        edges = np.append(start, len(rows)).astype(np.int32) * np.int32(pairs.itemsize * 2)
        at = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(edges), pa.py_buffer(pairs)])
        return C.batch(schema, word=rows.column("word").take(pa.array(start)), c=np.add.reduceat(train, start), at=at)

    def run(batches):
        held = []  # a word's rows may go on in the next batch
        for b in C.rebatch(batches, WORDS):
            b = pa.Table.from_batches([*held, b]).combine_chunks().to_batches()[0]
            word = b.column("word")
            start = np.flatnonzero(np.append(True, pc.not_equal(word.slice(1), word.slice(0, len(b) - 1)).to_numpy(zero_copy_only=False)))
            cut = int(start[-1])
            if cut:
                yield one(b.slice(0, cut), start[:-1])
            held = [b.slice(cut)]
        for b in held:
            yield one(b, np.zeros(1, np.int64))

    words = fold.where("code >= 0").select("word", "block", "code", "train")
    parts = C.partitions_for(fold.sparkSession, fold.count(), RANGE_WORDS)
    return mapped(words.repartitionByRange(parts, "word").sortWithinPartitions("word"), run, "word binary, c long, at binary", WORDS)


def spelled(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes of the words, each closed by a space, and the word each belongs to).  None stands for the end mark."""
    data = np.frombuffer(b"".join(b"\xff" if w is None else w + b" " for w in words), np.uint8)
    of = np.repeat(np.arange(len(words)), [1 if w is None else len(w) + 1 for w in words])
    return data, of


def contexts(data: np.ndarray, of: np.ndarray) -> list[np.ndarray]:
    """A hash per byte and predictor of what stands before the byte in its word."""
    n = len(data)
    start = np.searchsorted(of, of)  # where the byte's word begins
    depth = np.arange(n) - start
    x = data.astype(np.uint64) + np.uint64(1)
    out, h = [], np.zeros(n, np.uint64)
    for k in range(1, 5):
        before = np.zeros(n, np.uint64)
        before[k:] = x[:-k] if k < n else 0
        before[depth < k] = 0
        h = h * np.uint64(257) + before
        out.append(h if k == 1 else C.mix64(h ^ np.uint64(k)))
    # the word so far: a polynomial of its bytes, from running sums over all of them
    power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, _A))), dtype=np.uint64)
    inverse = np.uint64(pow(int(_A), -1, 1 << 64))
    lower = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, inverse))), dtype=np.uint64)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(x * lower[:n], dtype=np.uint64)))
    out.append(C.mix64((sums[:n] - sums[start]) * power[start] + _B))
    return out


def distinct(data: np.ndarray, context: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first of equal bytes with equal beginnings, which of these each byte is).  They meet the same slots."""
    key = C.mix64(context[-1] + (data.astype(np.uint64) + np.uint64(1)) * _A)
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    return first, which


def slots(context: list[np.ndarray], at: np.ndarray, node: np.ndarray):
    """Per predictor, the slots of decisions ``node`` on the bytes ``at``."""
    yield (context[0].astype(np.int64) & 255)[at] << 8 | node  # one byte: every context has slots of its own
    moved = node.astype(np.uint64) * _AB
    for i in range(1, len(TABLE_BITS)):
        yield (((context[i] * _B)[at] + moved) >> np.uint64(64 - TABLE_BITS[i])).astype(np.int64)


def opening_bytes(depth: int, key: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(bytes of openings, what they stand after: as inside the word, then across its border, then the depth)."""
    data = key.astype(">u4").view(np.uint8).reshape(-1, 4)[:, 3 - depth:].ravel()
    context = [c[depth::depth + 1] for c in contexts(data, np.repeat(np.arange(len(key)), depth + 1))]
    seen = (key >> np.uint32(8)).astype(np.uint64)
    for k in range(2, 2 + len(ACROSS_BITS)):
        known = k - (depth < k)  # of the last bytes, the space before the word is known
        context.append(C.mix64(seen & np.uint64((1 << 8 * known) - 1) | np.uint64(depth << 32 | k << 40)))
    return data[depth::depth + 1], [*context, np.full(len(key), depth, np.uint8)]


def across_slots(context: list[np.ndarray], at: np.ndarray, node: np.ndarray):
    """:func:`slots` of the contexts across the border."""
    moved = node.astype(np.uint64) * _AB
    for c, bits in zip(context[len(TABLE_BITS):], ACROSS_BITS):
        yield (((c * _B)[at] + moved) >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class ByteCode:
    """A prefix code of the 256 bytes, short for frequent ones, so that a byte takes few binary decisions.

    ``length[byte]``; ``node[byte, k]`` and ``bit[byte, k]``: the k-th decision and its outcome."""

    length: np.ndarray
    node: np.ndarray
    bit: np.ndarray

    @staticmethod
    def of(words: list[bytes]) -> "ByteCode":
        return ByteCode.from_counts(np.bincount(spelled([*words, None])[0], minlength=256))

    @staticmethod
    def from_counts(found: np.ndarray) -> "ByteCode":
        """Built by joining the two rarest parts again and again, from the counts of bytes (one more for each)."""
        counts = found + 1
        heap = [(int(c), b, b) for b, c in enumerate(counts)]
        heapq.heapify(heap)
        paths: list[list[tuple[int, int]]] = [[] for _ in range(256)]
        parts = {b: [b] for b in range(256)}
        for inner in range(255):
            x, y = heapq.heappop(heap), heapq.heappop(heap)
            for side, part in ((0, x), (1, y)):
                for b in parts[part[2]]:
                    paths[b].append((inner, side))
            parts[256 + inner] = parts.pop(x[2]) + parts.pop(y[2])
            heapq.heappush(heap, (x[0] + y[0], 256 + inner, 256 + inner))
        longest = max(map(len, paths))
        node, bit = np.zeros((256, longest), np.int64), np.zeros((256, longest), np.int64)
        for b, path in enumerate(paths):
            for k, (inner, side) in enumerate(reversed(path)):
                node[b, k], bit[b, k] = inner, side
        return ByteCode(np.array([len(p) for p in paths]), node, bit)

    def steps(self, data: np.ndarray):
        """Decision after decision: (places of the bytes that take it, node, outcome)."""
        length = self.length[data]
        for k in range(int(length.max(initial=0))):
            at = np.flatnonzero(length > k)
            yield at, self.node[data[at], k], self.bit[data[at], k]

    def decisions(self, data: np.ndarray):
        """The same byte after byte, all at once."""
        length = self.length[data]
        at = np.repeat(np.arange(len(data)), length)
        place = data[at] * np.int64(self.node.shape[1]) + np.arange(len(at)) - np.repeat(np.cumsum(length) - length, length)
        return at, self.node.ravel()[place], self.bit.ravel()[place]


def logs(n: np.ndarray) -> np.ndarray:
    """Logarithms of whole numbers, each with a little added."""
    out = _LOGS[np.minimum(n, len(_LOGS) - 1).astype(np.int64)]
    large = np.flatnonzero(n >= len(_LOGS))
    out[large] = np.log(n[large] + _BLANK)
    return out


def reached(n: np.ndarray) -> np.ndarray:
    """How many of the steps the numbers have reached."""
    return sum((n >= step).view(np.uint8) for step in _STEPS)


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """``code``: of bytes.  ``counts``: per predictor and slot, of zeros and ones.  ``weights``: per gate.  ``refined``:
    probabilities per gate and bucket."""

    code: ByteCode
    counts: list[np.ndarray]
    weights: np.ndarray
    refined: np.ndarray

    def __getstate__(self):
        """As sent to the tasks: every executor keeps a copy on its disk."""
        return self.__dict__ | {"counts": [packed(table) for table in self.counts]}

    def __setstate__(self, state):
        self.__dict__.update(state, counts=[unpacked(*table) for table in state["counts"]])

    @staticmethod
    def blank(words: list[bytes]) -> "Model":
        return Model.of(ByteCode.of(words))

    @staticmethod
    def of(code: ByteCode) -> "Model":
        n = len(TABLE_BITS)
        gates = (len(_STEPS) + 1) ** 2
        weights = np.full((gates, n + 1), 0.25)
        weights[:, n] = 0
        level = squash(np.linspace(-12, 12, _BUCKETS))
        return Model(code, [np.zeros((1 << b, 2), np.float32) for b in TABLE_BITS], weights, np.tile(level, (gates, 1)))

    def inputs(self, context: list[np.ndarray], node: np.ndarray, bit: np.ndarray | None = None, at: np.ndarray | None = None):
        """(log-odds of every predictor and a constant, gate) of decisions on the bytes ``at``, or one on each byte.  With
        ``bit``, its own occurrence is taken out first."""
        x = np.ones((len(node), len(TABLE_BITS) + 1))
        seen = self.looked_up(x, slots(context, np.arange(len(node)) if at is None else at, node), bit)
        return x, reached(seen[-1]) * np.uint8(len(_STEPS) + 1) + reached(seen[-2])

    def looked_up(self, x: np.ndarray, places, bit: np.ndarray | None) -> list[np.ndarray]:
        """How often each predictor's slots were met; their log-odds go into the columns of ``x``."""
        seen = []
        for i, s in enumerate(places):
            n = self.counts[i].view(np.complex64).ravel()[s].view(np.float32).astype(np.float64)  # a slot's two counts lie together
            if bit is not None:
                own = 2 * np.arange(len(s)) + bit
                n[own] = np.maximum(n[own] - 1, 0)
            n0, n1 = n[::2], n[1::2]
            x[:, i] = np.clip(logs(n1) - logs(n0), -12, 12)
            seen.append(n0 + n1)
        return seen

    def mixed(self, x: np.ndarray, gate: np.ndarray):
        dot = np.einsum("ij,ij->i", x, self.weights[gate])
        return dot, squash(dot)

    def final(self, dot: np.ndarray, p: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """The mix, moved a quarter of the way to its refinement (read between two buckets); never 0 or 1."""
        at = (np.clip(dot, -11.999, 11.999) + 12) * (_BUCKETS - 1) / 24
        low = at.astype(np.int64)
        part = at - low
        low += gate * np.int64(_BUCKETS)
        refined = self.refined.ravel()[low] * (1 - part) + self.refined.ravel()[low + 1] * part
        return np.clip((3 * p + refined) / 4, 1e-6, 1 - 1e-6)

    def gathered(self, words: list[bytes | None], counts: np.ndarray) -> np.ndarray:
        """Per gate, over all bits of the words so many times each: loss, gradient, curvature, and per bucket of the
        refinement the bits and the ones among them."""
        return self.summed(*weighed(words, counts))

    def summed(self, data: np.ndarray, context: list[np.ndarray], weight: np.ndarray) -> np.ndarray:
        """:meth:`gathered` of bytes with their contexts, each so many times."""
        gates, n = self.weights.shape
        out = np.zeros((gates, _stats(n)))
        for s in range(0, len(data), BYTES):
            at, node, bit = self.code.decisions(data[s:s + BYTES])
            x, gate = self.inputs([c[s:s + BYTES] for c in context], node, bit, at)
            order = np.argsort(gate, kind="stable")
            x, gate, bit, w = x[order], gate[order], bit[order], weight[s:s + BYTES][at[order]]
            dot, p = self.mixed(x, gate)
            loss = -w * np.log(np.where(bit == 1, p, 1 - p))
            bucket = gate * np.int64(_BUCKETS) + np.rint((np.clip(dot, -12, 12) + 12) * (_BUCKETS - 1) / 24).astype(np.int64)
            bits, ones = (np.bincount(bucket, v, gates * _BUCKETS).reshape(gates, _BUCKETS) for v in (w, w * bit))
            edges = np.append(np.flatnonzero(np.diff(gate.astype(np.int64), prepend=-1)), len(gate))
            for a, e in zip(edges, edges[1:]):
                g, part, v, q = gate[a], x[a:e], w[a:e], p[a:e]
                out[g] += np.concatenate(([loss[a:e].sum()], part.T @ (v * (bit[a:e] - q)), (part.T @ (part * (v * q * (1 - q))[:, None])).ravel(),
                                          bits[g], ones[g]))
        return out

    def learn(self, gather) -> None:
        """Fit weights and refinement; ``gather(weights)`` gives what :meth:`gathered` gives for all training tokens."""
        start, n = self.weights.copy(), self.weights.shape[1]
        best = np.full(len(start), np.inf)
        tried, level = start.copy(), squash(np.linspace(-12, 12, _BUCKETS))
        step = np.zeros_like(start)
        for _ in range(ROUNDS):
            found = gather(tried)
            for g, row in enumerate(found):
                loss, slope, curve = row[0], row[1:1 + n], row[1 + n:1 + n + n * n].reshape(n, n)
                bits, ones = row[1 + n + n * n:].reshape(2, _BUCKETS)
                away = tried[g] - start[g]
                loss += PULL / 2 * away @ away
                if loss < best[g]:
                    best[g], self.weights[g] = loss, tried[g]
                    self.refined[g] = np.clip((ones + LEVEL * level) / (bits + LEVEL), 1e-6, 1 - 1e-6)
                    step[g] = np.clip(np.linalg.solve(curve + PULL * np.eye(n), slope - PULL * away), -1, 1)
                else:
                    step[g] /= 4
                tried[g] = self.weights[g] + step[g]

    def learn_online(self, words: list[bytes]) -> None:
        """:meth:`learn` from these words alone, each once."""
        self.learn(lambda weights: replace(self, weights=weights).gathered(words, np.ones(len(words))))

    def log10(self, words: list[bytes | None], since: int = 0) -> np.ndarray:
        """Base-10 log probability of every word with its closing space, its first ``since`` bytes left out; of None, the end
        mark."""
        data, of = spelled(words)
        context = contexts(data, of)
        if since:
            deep = np.arange(len(of)) - np.searchsorted(of, of) >= since
            data, of, context = data[deep], of[deep], [c[deep] for c in context]
        first, which = distinct(data, context)
        out = self.byte_logs(data[first], [c[first] for c in context])
        return np.bincount(of, weights=out[which], minlength=len(words))

    def byte_logs(self, data: np.ndarray, context: list[np.ndarray]) -> np.ndarray:
        """Base-10 log probability of every byte."""
        out = np.zeros(len(data))
        for s in range(0, len(data), BYTES):
            at, node, bit = self.code.decisions(data[s:s + BYTES])
            x, gate = self.inputs([c[s:s + BYTES] for c in context], node, at=at)
            dot, p = self.mixed(x, gate)
            p = self.final(dot, p, gate)
            out[s:s + BYTES] = np.bincount(at, weights=np.log10(np.where(bit == 1, p, 1 - p)))
        return out


@dataclass
class Across(Model):
    """The second mixer.  ``inner``: the first, fitted; the rest as there, for the contexts across the border."""

    inner: Model | None = None

    @staticmethod
    def over(inner: Model) -> "Across":
        """Before anything is learned the result is the first mixer's."""
        n = len(ACROSS_BITS)
        gates = OPENING * (len(_STEPS) + 1) ** 2
        weights = np.zeros((gates, n + 2))
        weights[:, n] = 1
        return Across(inner.code, [np.zeros((1 << b, 2), np.float32) for b in ACROSS_BITS], weights,
                      np.tile(squash(np.linspace(-12, 12, _BUCKETS)), (gates, 1)), inner)

    def inputs(self, context: list[np.ndarray], node: np.ndarray, bit: np.ndarray | None = None, at: np.ndarray | None = None):
        """(log-odds of every predictor, of the first mixer, and a constant, gate)."""
        at = np.arange(len(node)) if at is None else at
        inner, gate = self.inner.inputs(context[:len(TABLE_BITS)], node, bit, at)
        p = self.inner.final(*self.inner.mixed(inner, gate), gate)
        x = np.ones((len(node), len(ACROSS_BITS) + 2))
        seen = self.looked_up(x, across_slots(context[:-1], at, node), bit)
        x[:, -2] = np.log(p / (1 - p))
        steps = np.uint8(len(_STEPS) + 1)
        return x, (context[-1][at] * steps + reached(seen[-1])) * steps + reached(seen[-2])

    def opening_logs(self, depth: int, key: np.ndarray) -> np.ndarray:
        """Base-10 log probability of every opening."""
        return np.concatenate([np.zeros(0), *(self.byte_logs(*opening_bytes(depth, key[s:s + BYTES])) for s in range(0, len(key), BYTES))])


def _stats(n: int) -> int:
    return 1 + n + n * n + 2 * _BUCKETS


def byte_counts(vocabulary: DataFrame) -> np.ndarray:
    """How often each byte stands in all training tokens, end marks aside."""
    schema = pa.schema([("byte", pa.int32()), ("n", pa.int64())])

    def run(batches):
        total = np.zeros(256, np.int64)
        for b in C.rebatch(batches, WORDS):
            data, of = spelled(b.column(0).to_pylist())
            total += np.bincount(data, weights=b.column(1).to_numpy()[of], minlength=256).astype(np.int64)
        yield C.batch(schema, byte=np.arange(256, dtype=np.int32), n=total)

    out = np.zeros(256, np.int64)
    for r in mapped(vocabulary.where("c > 0").select("word", "c"), run, "byte int, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect():
        out[r["byte"]] = r["n"]
    return out


def weighed(words: list[bytes | None], counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(distinct bytes of the words, their contexts, how often they stand there), of words so many times each."""
    data, of = spelled(words)
    context = contexts(data, of)
    first, which = distinct(data, context)
    return data[first], [c[first] for c in context], np.bincount(which, weights=counts[of], minlength=len(first))


def of_words(batches):
    """:func:`weighed` of rows of words and counts."""
    for b in C.rebatch(batches, WORDS):
        yield weighed(b.column(0).to_pylist(), b.column(1).to_numpy().astype(np.float64))


def of_openings(batches):
    """The same of rows that :func:`opened` gives."""
    for b in batches:
        found = list(zip(*(c.to_pylist() for c in b.columns)))
        for depth in range(OPENING):
            rows = [(np.frombuffer(k, np.uint32), widened(n)) for d, k, n in found if d == depth]
            if rows:
                key, n = (np.concatenate(x) for x in zip(*rows))
                for s in range(0, len(key), BYTES):
                    yield *opening_bytes(depth, key[s:s + BYTES]), n[s:s + BYTES].astype(np.float64)


def bit_counts(rows: DataFrame, code: ByteCode, pieces, look, sizes: tuple[int, ...]) -> DataFrame:
    """(predictor, chunk, places, counts) over all training tokens: of a stretch of a table the places that are not zero,
    summed.  A slot has two places, for zeros and ones.  ``pieces`` gives the bytes of rows, ``look`` their slots.

    Words come in ranges, so few tasks share a long context.  A task adds up whole tables and sends the used places as
    numbers; of the sums they come as a bit map."""
    schema = pa.schema([("predictor", pa.int32()), ("chunk", pa.int32()), ("places", pa.binary()), ("counts", pa.binary())])
    names = "predictor int, chunk int, places binary, counts binary"

    def run(batches):
        tables = None
        for data, context, weight in pieces(batches):
            if tables is None:
                tables = [np.zeros(2 << size) for size in sizes]  # doubles: a count never stops growing
            for s in range(0, len(data), BYTES):
                at, node, bit = code.decisions(data[s:s + BYTES])
                w = weight[s:s + BYTES][at]
                for table, place in zip(tables, look([c[s:s + BYTES] for c in context], at, node)):
                    np.add.at(table, 2 * place + bit, w)
        for i, table in enumerate(tables or ()):
            for start in range(0, len(table), 32 * CHUNK):
                chunk, places, counts = [], [], []
                for at in range(start, min(start + 32 * CHUNK, len(table)), 2 * CHUNK):
                    used = np.flatnonzero(table[at:at + 2 * CHUNK])
                    if len(used):
                        chunk.append(at // (2 * CHUNK))
                        places.append(used.astype(np.uint16).tobytes())
                        counts.append(narrow(table[at + used].astype(np.int64)))
                if chunk:
                    yield C.batch(schema, predictor=[i] * len(chunk), chunk=chunk, places=places, counts=counts)

    def add(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for predictor, chunk, places, counts in zip(*(c.to_pylist() for c in b.columns)):
                total = sums.setdefault((predictor, chunk), np.zeros(2 * CHUNK, np.int64))
                total[np.frombuffer(places, np.uint16)] += widened(counts)
        for (predictor, chunk), total in sums.items():
            used = total != 0
            yield C.batch(schema, predictor=[predictor], chunk=[chunk], places=[np.packbits(used).tobytes()],
                          counts=[zlib.compress(narrow(total[used]), 1)])

    return mapped(mapped(rows, run, names).repartition("predictor", "chunk"), add, names)


def fill(model: Model, rows: DataFrame, pieces, look, sizes: tuple[int, ...]) -> None:
    """Put the counts of all rows into the model's tables."""
    # at most one row per chunk of slots: a bound that does not grow with the corpus
    for r in bit_counts(rows, model.code, pieces, look, sizes).collect():
        places = np.flatnonzero(np.unpackbits(np.frombuffer(bytes(r["places"]), np.uint8))) + r["chunk"] * 2 * CHUNK
        model.counts[r["predictor"]].reshape(-1)[places] = widened(zlib.decompress(bytes(r["counts"])))


def summed_over(rows: DataFrame, pieces, made, shape: tuple[int, int]) -> np.ndarray:
    """What :meth:`Model.summed` of the model that ``made`` gives in a task gives for all rows."""
    schema, names = pa.schema([("gate", pa.int32()), ("part", pa.int32()), ("sums", pa.binary())]), "gate int, part int, sums binary"

    def run(batches):
        model, total = made(), 0
        for piece in pieces(batches):
            total = total + model.summed(*piece)
        if np.ndim(total):
            part = TaskContext.get().partitionId()
            yield C.batch(schema, gate=range(len(total)), part=[part] * len(total), sums=[row.tobytes() for row in total])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for gate, _, row in zip(*(c.to_pylist() for c in b.columns)):
                sums[gate] = sums.get(gate, 0) + np.frombuffer(row)
        if sums:
            yield C.batch(schema, gate=list(sums), part=[0] * len(sums), sums=[x.tobytes() for x in sums.values()])

    out = np.zeros((shape[0], _stats(shape[1])))
    for r in mapped(mapped(rows, run, names).repartition("gate").sortWithinPartitions("gate", "part"), add, names).collect():
        out[r["gate"]] = np.frombuffer(bytes(r["sums"]))
    return out


def train(vocabulary: DataFrame, ends: int) -> tuple[Model, Broadcast]:
    """Fit byte code, predictors, weights and refinement on all counted words.  Also the model as sent to the tasks, whose
    weights and refinement are still blank."""
    bytes_ = byte_counts(vocabulary)
    bytes_[0xff] += ends
    model = Model.of(ByteCode.from_counts(bytes_))
    learned = vocabulary.where("c > 0").select("word", "c")
    fill(model, learned, of_words, slots, TABLE_BITS)
    end, of = spelled([None])
    at, node, bit = model.code.decisions(end)
    for counts, slot in zip(model.counts, slots(contexts(end, of), at, node)):
        np.add.at(counts, (slot, bit), ends)
    shared = vocabulary.sparkSession.sparkContext.broadcast(model)

    def gather(weights: np.ndarray) -> np.ndarray:
        return (replace(model, weights=weights).gathered([None], np.array([float(ends)]))
                + summed_over(learned, of_words, lambda: replace(shared.value, weights=weights), weights.shape))

    model.learn(gather)
    return model, shared


def train_across(opening: DataFrame, model: Model, shared: Broadcast) -> tuple[Across, Broadcast]:
    """Fit the second mixer on all counted openings; the same two."""
    across = Across.over(model)
    fill(across, opening, of_openings, across_slots, ACROSS_BITS)
    sent = opening.sparkSession.sparkContext.broadcast(replace(across, inner=None))
    inner = {"weights": model.weights, "refined": model.refined}
    across.learn(lambda weights: summed_over(
        opening, of_openings, lambda: replace(sent.value, weights=weights, inner=replace(shared.value, **inner)), weights.shape))
    return across, sent


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base and model log10 probability of every document."""
    fold = C.table(folded(docs, id_col, text_col), "folded-words")
    heads = fold.where("code = -1").select("block", "code", "train", "head")
    ends, blocks = heads.agg(F.coalesce(F.sum("train"), F.lit(0)), F.count("*")).first()
    words = C.table(counted(fold), "counted-words")
    vocabulary = words.select("word", "c")
    known = vocabulary.where("c > 0").agg(F.sum("c"), F.count("*")).first()
    tokens, distinct = (known[0] or 0) + ends, known[1] + (1 if ends else 0)
    model, shared = train(vocabulary, ends)
    fitted = {"weights": model.weights, "refined": model.refined}
    across, sent = train_across(C.table(opened(fold), "counted-openings"), model, shared)
    second = {"weights": across.weights, "refined": across.refined}
    columns = ["codes", "counts", "logs"]
    scored_schema = pa.schema([("block", pa.int64()), ("code", pa.int32()), *((n, pa.binary()) for n in columns)])

    def spell(batches):
        model = replace(shared.value, **fitted)
        held, size = [], 0

        def by_block():
            at, c, log = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(at[:, 0], kind="stable")
            at, c, log = at[order], c[order], log[order]
            edges = np.append(np.flatnonzero(np.diff(at[:, 0], prepend=-1)), len(at))
            parts = [(at[a, 0], 0, narrow(at[a:e, 1]), narrow(c[a:e]), log[a:e].tobytes()) for a, e in zip(edges, edges[1:])]
            return C.batch(scored_schema, **dict(zip(scored_schema.names, zip(*parts))))

        for b in C.rebatch(batches, WORDS):
            places = b.column(2).to_pylist()
            at = np.frombuffer(b"".join(places), np.int64).reshape(-1, 2)
            n = np.fromiter(map(len, places), np.int64, len(places)) // 16
            held.append((at, np.repeat(b.column(1).to_numpy(), n), np.repeat(model.log10(b.column(0).to_pylist(), OPENING), n)))
            size += len(at)
            if size >= RANGE_WORDS:
                yield by_block()
                held, size = [], 0
        if held:
            yield by_block()

    found = mapped(words.select("word", "c", "at"), spell, "block long, code int, codes binary, counts binary, logs binary")
    both = found.unionByName(heads.select("block", "code", "head"), allowMissingColumns=True)
    dealt = both.repartition(C.partitions_for(docs.sparkSession, blocks, 1), "block").sortWithinPartitions("block", "code")

    def total(batches):
        head, across = None, None

        def finished():
            nonlocal across
            across = across or replace(sent.value, **second, inner=replace(shared.value, **fitted))
            ids, folds, lengths, sizes = (np.frombuffer(head[i], t) for i, t in enumerate((np.int64, np.uint8, np.int64, np.int64)))
            rows = len(folds)
            base_score, model_score, known = (np.zeros(rows) for _ in range(3))
            each = np.stack([np.log10((c + 1) / (tokens + distinct + 1)), lp, c > 0])
            found: list[list] = [[] for _ in range(OPENING)]
            for docs_, at in stretches(lengths):
                of = np.repeat(np.arange(docs_.stop - docs_.start), lengths[docs_])
                for out, w in zip((base_score, model_score, known), each):
                    out[docs_] = np.bincount(of, weights=w[code[at]], minlength=docs_.stop - docs_.start)
                for depth, key, _ in openings(code[at], lengths[docs_], first, last):
                    found[depth].append(pc.unique(pa.array(key)).to_numpy())
            found = [np.unique(np.concatenate(keys)) for keys in found]
            log = [across.opening_logs(depth, keys) for depth, keys in enumerate(found)]
            for docs_, at in stretches(lengths):
                for depth, key, of in openings(code[at], lengths[docs_], first, last):
                    key = pa.array(key).dictionary_encode()
                    w = log[depth][np.searchsorted(found[depth], key.dictionary.to_numpy())]
                    model_score[docs_] += np.bincount(of, weights=w[key.indices.to_numpy()], minlength=docs_.stop - docs_.start)
            base_score += np.log10((ends + 1) / (tokens + distinct + 1))
            return C.batch(_OUT, doc_id=pa.array(ids, mask=folds == _NEITHER), held_out=folds == _HELD, n_tokens=lengths + 1,
                           n_known=known.astype(np.int64) + (1 if ends else 0), train_tokens=np.full(rows, tokens),
                           base_score=base_score, score=model_score, bits_per_byte=-model_score * np.log2(10) / sizes)

        for b in batches:
            for i in range(b.num_rows):  # one row at a time: a head is large
                if b.column("code")[i].as_py() == -1:
                    if head is not None:
                        yield finished()
                    head = [x.as_py() for x in b.column("head")[i].values]
                    first, last, code = map(joined, head[4:])
                    del head[4:]
                    c, lp = np.zeros(len(first), np.int64), np.zeros(len(first))
                else:
                    at, n, log = (b.column(name)[i].as_py() for name in columns)
                    at = widened(at)
                    c[at], lp[at] = widened(n), np.frombuffer(log)
        if head is not None:
            yield finished()

    return mapped(dealt, total, OUT_SCHEMA)
