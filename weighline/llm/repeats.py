"""Operator 10: removal of long repeated byte strings, found in an enhanced suffix array.

A byte goes if a string of ``WINDOW`` bytes that covers it starts anywhere else in the corpus.

1. Anchors.  Every window names its smallest hashed ``GRAM``-gram (the leftmost of equals), so equal windows name the
   same one at the same offset.  Neighbouring windows that name one anchor form a run; a run is a small row of two
   hashes (anchor; the run's whole bytes and offset).  Texts stay where they are.
2. Anchors that occur once are dropped by one aggregate.  Runs whose bytes occur twice are repeated as a whole.
3. Anchors with different runs need comparing: one run of each kind fetches its bytes, and an enhanced suffix array over the
   windows of all runs of an anchor is scanned with a stack.  The intervals of common prefix of at least ``WINDOW``
   bytes form a tree; those whose members differ in the byte to their left are maximal repeats.  ``occurrences`` gives each
   with all its occurrences, those in equal runs too; ``remove`` needs only rows that cover the same bytes.  A run's first
   place counts as different from all others: the anchor before it covers its repeats only up to its own last window.
4. Every document's repeats are joined and cut out.

How it scales.  Counting is aggregated map-side, joins on anchors can be split when skewed.  A suffix array holds the
runs of whole anchors up to ``CHUNK_WINDOWS`` windows.  An anchor with more than ``ARRAY_RUNS`` different runs (a passage of a
large share of all documents has such anchors at its edges) is split by the anchor's place in the window, which equal
windows share, and its windows are compared by hash.  Both ways are exact up to collisions of 128 hashed bits.

Defined results.  Null text is empty.  Texts shorter than the window lose nothing.  Two rows with one text repeat each
other; so do repeated rows, also with one doc_id or none.  An empty table gives no rows.  Only the two named columns are
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from weighline.llm import common as C

WINDOW, GRAM = 200, 32
ARRAY_RUNS, CHUNK_WINDOWS = 2_000, 60_000
#: Window starts worked on at a time; a longer text is cut into overlapping parts.
PART = 1 << 20
_LOW = -(1 << 63)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
BYTES = C.mix64(np.arange(1, 257, dtype=np.uint64))  # every byte as a 64-bit number

_RUN = pa.schema([("id", pa.int64()), ("tk", pa.int64()), ("s", pa.int64()), ("run", pa.int32()), ("off", pa.int32()), ("h1", pa.int64()),
                  ("h2", pa.int64()), ("rid", pa.int64())])
RUN_SCHEMA = "id long, tk long, s long, run int, off int, h1 long, h2 long, rid long"
_CONTEXT = pa.schema([("h1", pa.int64()), ("m", pa.int64()), ("id", pa.int64()), ("tk", pa.int64()), ("s", pa.int64()), ("run", pa.int32()),
                      ("off", pa.int32()), ("h2", pa.int64()), ("n", pa.int64()), ("bytes", pa.binary())])
CONTEXT_SCHEMA = "h1 long, m long, id long, tk long, s long, run int, off int, h2 long, n long, bytes binary"
_OCCURRENCE = pa.schema([("id", pa.int64()), ("tk", pa.int64()), ("s", pa.int64()), ("e", pa.int64()), ("repeat", pa.int64()), ("occurrences", pa.int64())])
OCCURRENCE_SCHEMA = "id long, tk long, s long, e long, repeat long, occurrences long"
_MEMBER = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("p", pa.int64()), ("length", pa.int64()), ("repeat", pa.int64()), ("occurrences", pa.int64())])
MEMBER_SCHEMA = "h1 long, h2 long, p long, length long, repeat long, occurrences long"
_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
OUT_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def gram_hashes(x: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n bytes from every place on, for n a power of two, by doubling."""
    h, size = x, 1
    while size < n:
        h = h[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + h[size:]
        size *= 2
    return C.mix64(h)


class RangeHash:
    """Hash of any range of the bytes, from running sums."""

    def __init__(self, x: np.ndarray):
        n = len(x)
        lower = np.full(n + 1, _INVERSE, np.uint64)
        lower[0] = 1
        lower = np.cumprod(lower, dtype=np.uint64)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * lower[:n], dtype=np.uint64)))
        power = np.full(n + 1, _BASE, np.uint64)
        power[0] = 1
        self.power = np.cumprod(power, dtype=np.uint64)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return C.mix64((self.sums[end] - self.sums[start]) * self.power[start] + (end - start).astype(np.uint64))


def sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbouring values, from running minima of blocks in both directions."""
    n = len(v) - width + 1
    blocks = -(-len(v) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(v)] = v
    grid = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1:width - 1 + n])


def runs(data: np.ndarray, valid: np.ndarray, window: int, gram: int):
    """Runs of windows with one anchor: (first start, length, offset of the anchor in it, anchor hash, run hash).

    ``valid``: which starts have a whole window inside one document."""
    x = BYTES[data]
    h = gram_hashes(x, gram)
    low = np.uint64(max(1, len(h).bit_length()))
    mask = (np.uint64(1) << low) - np.uint64(1)
    least = sliding_least(h & ~mask | np.arange(len(h), dtype=np.uint64), window - gram + 1)
    starts = np.flatnonzero(valid)
    anchor = (least[starts] & mask).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(starts) != 1) | (np.diff(anchor) != 0)
    at = np.flatnonzero(new)
    first, length = starts[at], np.diff(np.append(at, len(starts)))
    off = anchor[at] - first
    whole = RangeHash(x).of(first, first + length - 1 + window)
    return first, length, off, h[anchor[at]], C.mix64(whole ^ off.astype(np.uint64))


def parts(batch: pa.RecordBatch, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """The batch's texts, one behind the other, in parts: (bytes, valid starts, [(place of the document, position of
    its first byte in the part, its offset there)])."""
    held, size, index = [], 0, []

    def part():
        data = np.frombuffer(b"".join(held), np.uint8)
        valid = np.zeros(max(len(data) - window + 1, 0), bool)
        for (_, begin, _), text in zip(index, held):
            valid[begin:max(begin, begin + len(text) - window + 1)] = True
        return data, valid, index

    for place, text in enumerate(batch.column(2).to_pylist()):
        raw = text.encode()
        for start in range(0, max(len(raw) - window + 1, 0), PART):
            piece = raw[start:start + PART + window - 1]
            if size + len(piece) > PART + window and held:
                yield part()
                held, size, index = [], 0, []
            index.append((place, size, start))
            held.append(piece)
            size += len(piece)
    if held:
        yield part()


def run_rows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Rows of all runs of all documents (id, tk, text)."""
    def emit(batches):
        rid = TaskContext.get().partitionId() << 40
        for b in batches:
            ids, keys = b.column(0).to_numpy(), b.column(1).to_numpy()
            for data, valid, index in parts(b, window):
                if not valid.any():
                    continue
                first, length, off, h1, h2 = runs(data, valid, window, gram)
                begins = np.array([i[1] for i in index])
                of = np.searchsorted(begins, first, side="right") - 1
                place = np.array([i[0] for i in index])[of]
                s = first - begins[of] + np.array([i[2] for i in index])[of]
                yield C.batch(_RUN, id=ids[place], tk=keys[place], s=s, run=length.astype(np.int32), off=off.astype(np.int32),
                              h1=h1.view(np.int64), h2=h2.view(np.int64), rid=rid + np.arange(len(s)))
                rid += len(s)

    return C.map_arrow(docs, emit, RUN_SCHEMA)


def suffix_array(texts: list[bytes]):
    """(suffix array, ranks by length 1, 2, 4, ... 256, symbols, first position of every text) of the texts, each closed
    by a symbol of its own."""
    lengths = np.array([len(t) + 1 for t in texts])
    symbols = np.frombuffer(b"".join(t + b"\0" for t in texts), np.uint8).astype(np.int64) + len(texts)
    ends = np.cumsum(lengths) - 1
    symbols[ends] = np.arange(len(texts))
    n, levels, size = len(symbols), [symbols], 1
    while size < 256:
        rank = levels[-1]
        behind = np.zeros(n, np.int64)
        behind[:-size] = rank[size:] + 1
        _, rank = np.unique(rank * (n + len(texts) + 258) + behind, return_inverse=True)
        levels.append(rank)
        size *= 2
    rank = levels[-1]
    behind = np.zeros(n, np.int64)
    behind[:-size] = rank[size:] + 1
    return np.argsort(rank * (n + 1) + behind, kind="stable"), levels, ends + 1 - lengths


def common_prefix(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffix pairs, up to 511, from the ranks by length."""
    out, n = np.zeros(len(a), np.int64), len(levels[0])
    for k in reversed(range(len(levels))):
        inside = (a + out < n) & (b + out < n)
        equal = np.zeros(len(a), bool)
        equal[inside] = levels[k][(a + out)[inside]] == levels[k][(b + out)[inside]]
        out[equal] += 1 << k
    return out


def maximal_repeats(texts: list[bytes], starts: list[int], left: list[int], least: int, copies: list[int] | None = None, every: bool = False):
    """Maximal repeats of at least ``least`` bytes among the suffixes that begin in the first ``starts[t]`` places of
    text t: lists of (length, [(text, place)]).  ``left[t]``: the byte before text t, or -1 where a text's first place
    counts as different from all others.

    A stack scan over the common prefixes of neighbours in the suffix array closes each interval of the prefix tree once;
    an interval is a maximal repeat if not all its members have the same byte to their left.  Members are listed once, in
    the deepest maximal repeat that holds them (the ones above it cover less); with ``every``, in each that holds them.
    ``copies[t]``: how many texts text t stands for; several make the whole text a repeat, given once for all of them."""
    order, levels, begins = suffix_array(texts)
    of = np.searchsorted(begins, order, side="right") - 1
    place = order - begins[of]
    keep = place < np.array(starts)[of]
    order, of, place = order[keep], of[keep], place[keep]
    if len(order) < 2 and copies is None:
        return []
    copied = np.ones(len(texts), np.int64) if copies is None else np.array(copies)
    upto = np.concatenate(([0], np.cumsum(copied[of])))
    prefix = common_prefix(levels, order[:-1], order[1:])
    symbols = levels[0]
    before = np.where(place > 0, symbols[np.maximum(order - 1, 0)], -1 - order)  # a first place differs from every other
    known = np.array(left)[of]
    before = np.where((place == 0) & (known >= 0), known + len(texts), before)
    differs = np.concatenate(([0], np.cumsum(before[1:] != before[:-1])))
    listed = np.zeros(len(order), bool)
    out: list[tuple[int, np.ndarray]] = []
    stack: list[tuple[int, int]] = []  # (common prefix, left bound)

    def close(length: int, lb: int, rb: int) -> None:
        if differs[rb] > differs[lb]:
            fresh = lb + np.flatnonzero(~listed[lb:rb + 1])
            if len(fresh):
                listed[fresh] = not every
                out.append((length, int(upto[rb + 1] - upto[lb]), fresh))

    long = np.flatnonzero(prefix >= least)
    previous = -2
    for i in long.tolist():
        if i != previous + 1:
            while stack:
                close(*stack.pop(), previous + 1)
        value, lb = int(prefix[i]), i
        while stack and stack[-1][0] > value:
            length, lb = stack.pop()
            close(length, lb, i)
        if not stack or stack[-1][0] < value:
            stack.append((value, lb))
        previous = i
    while stack:
        close(*stack.pop(), previous + 1)
    size = np.array([len(t) for t in texts])[of]
    longest = np.maximum(np.append(0, prefix), np.append(prefix, 0))  # shared with a neighbour
    for j in np.flatnonzero((copied[of] > 1) & (place == 0) & (longest < size)).tolist():
        out.append((int(size[j]), int(copied[of[j]]), np.array([j])))
    return [(length, members, [(int(of[j]), int(place[j])) for j in fresh]) for length, members, fresh in out]


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
                array_runs: int = ARRAY_RUNS) -> tuple[DataFrame, DataFrame]:
    """(occurrences of repeats, keyed documents).  Occurrences: id, tk (key of the text), s, e (bytes), ``repeat`` (its
    group) and the number of the group's members.  Every group lists all its members, also those inside deeper groups."""
    return stretches(docs, id_col, text_col, window, gram, array_runs, True)


def stretches(docs: DataFrame, id_col: str, text_col: str, window: int, gram: int, array_runs: int, every: bool) -> tuple[DataFrame, DataFrame]:
    """``every``: all members of all groups.  Otherwise what covers the same bytes: equal runs as a whole, and one run of
    each kind in its deepest groups."""
    keyed = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LOW)).alias("id"), F.xxhash64(C.text_of(text_col)).alias("tk"),
                        C.text_of(text_col).alias("text"))
    rows = run_rows(keyed, window, gram)
    # anchors seen twice; the runs of others are dropped
    twice = C.table(rows.groupBy("h1").agg(F.count("*").alias("n")).where("n > 1").select("h1"), "anchors")
    live = C.table(rows.join(twice, "h1", "left_semi"), "runs")
    kinds = C.table(live.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("rid").alias("rid")), "kinds")
    several = kinds.groupBy("h1").agg(F.count("*").alias("m")).where("m > 1")
    alike = kinds.where("n > 1")
    if every:  # an array has equal runs in its groups
        alike = alike.join(several, "h1", "left").where(F.col("m").isNull() | (F.col("m") > array_runs))
    whole = (live.join(alike.select("h1", "h2", "n"), ["h1", "h2"])
             .select("id", "tk", "s", (F.col("s") + F.col("run") - 1 + window).alias("e"), F.xxhash64("h1", "h2").alias("repeat"),
                     F.col("n").alias("occurrences")))
    chosen = kinds.join(several, "h1").select("rid", "m", "n")
    compared = live.join(chosen, "rid")
    wanted = compared.groupBy("id", "tk").agg(F.collect_set(F.struct("s", "run", "off", "h1", "m", "h2", "n")).alias("wanted"))

    def fetch(batches):
        for b in batches:
            rows = []
            for i, tk, text, want in zip(*(c.to_pylist() for c in b.columns)):
                raw = text.encode()
                for w in want:
                    s, end = w["s"], w["s"] + w["run"] - 1 + window
                    rows.append((w["h1"], w["m"], i, tk, s, w["run"], w["off"], w["h2"], w["n"], raw[s:end]))
                if len(rows) > 5_000:
                    yield C.batch(_CONTEXT, **dict(zip(_CONTEXT.names, zip(*rows))))
                    rows = []
            if rows:
                yield C.batch(_CONTEXT, **dict(zip(_CONTEXT.names, zip(*rows))))

    fetched = C.table(C.map_arrow(keyed.join(wanted, ["id", "tk"]).select("id", "tk", "text", "wanted"), fetch, CONTEXT_SCHEMA), "contexts")
    if every:
        fetched = fetched.dropDuplicates(["h1", "h2"])  # rows with one doc_id and text fetch a run each

    given, given_schema = (_MEMBER, MEMBER_SCHEMA) if every else (_OCCURRENCE, OCCURRENCE_SCHEMA)

    def scan(batches):
        held, size, last = [], 0, None

        def found():
            anchor, ids, keys, s, run, h2, n, texts = zip(*held)
            # a first place counts as different: what stands left of it belongs to another anchor
            rows = []
            for length, members, places in maximal_repeats(list(texts), list(run), [-1] * len(texts), window, list(n) if every else None, every):
                t, p = places[0]
                group = int.from_bytes(hashlib.blake2b(texts[t][p:p + length], digest_size=8).digest(), "big", signed=True)
                if every:
                    rows += [(anchor[t], h2[t], p, length, group, members) for t, p in places]
                else:
                    rows += [(ids[t], keys[t], s[t] + p, s[t] + p + length, group, members) for t, p in places]
                if len(rows) > 20_000:
                    yield C.batch(given, **dict(zip(given.names, zip(*rows))))
                    rows = []
            if rows:
                yield C.batch(given, **dict(zip(given.names, zip(*rows))))

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if row[0] != last and size >= CHUNK_WINDOWS:
                    yield from found()
                    held, size = [], 0
                held.append(row)
                size, last = size + row[4], row[0]
        if held:
            yield from found()

    arrayed = C.map_arrow(fetched.where(F.col("m") <= array_runs).select("h1", "id", "tk", "s", "run", "h2", "n", "bytes")
                          .repartition("h1").sortWithinPartitions("h1"), scan, given_schema)
    counted_schema = pa.schema([("h1", pa.int64()), ("part", pa.int64()), ("id", pa.int64()), ("tk", pa.int64()), ("s", pa.int64()), ("off", pa.int32()),
                                ("h2", pa.int64()), ("n", pa.int64()), ("at", pa.int32()), ("w", pa.list_(pa.int64()))])
    offsets = window - gram + 1  # an anchor stands at one of so many places of a window

    def windows(batches):
        """A crowded anchor's runs, cut where the anchor's place in the window passes from one part to the next."""
        for b in batches:
            rows = []
            for h1, m, i, tk, s, run, off, h2, n, raw in zip(*(c.to_pylist() for c in b.columns)):
                at = np.arange(run)
                hashes = RangeHash(BYTES[np.frombuffer(raw, np.uint8)]).of(at, at + window).view(np.int64)
                width = max(1, offsets * array_runs // m)
                split = max(1, m // (offsets * array_runs))  # more runs than places can part: by hash as well
                part = (off - at) // width * split + hashes % split
                edges = [0, *(np.flatnonzero(np.diff(part)) + 1), run]
                rows += [(h1, int(part[x]), i, tk, s + x, off - x, h2, n, x, hashes[x:y]) for x, y in zip(edges, edges[1:])]
            if rows:
                yield C.batch(counted_schema, **dict(zip(counted_schema.names, zip(*rows))))

    def count(batches):
        held, group = [], None

        def found():
            ids, keys, s, off, h2, copies, begun, hashes = (np.array(x) if i < 7 else x for i, x in enumerate(zip(*held)))
            lengths = np.array([len(h) for h in hashes])
            row = np.repeat(np.arange(len(held)), lengths)
            at = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            w = np.concatenate(hashes).astype(np.uint64) + C.mix64((off[row] - at).astype(np.uint64))
            _, back, times = np.unique(w, return_inverse=True, return_counts=True)
            n = np.bincount(back, copies[row]).astype(np.int64)[back]
            again = np.flatnonzero(times[back] > 1)
            # neighbouring windows of a run are given as one stretch
            new = np.ones(len(again), bool)
            new[1:] = (np.diff(again) != 1) | (np.diff(row[again]) != 0)
            first = again[new]
            last = again[np.append(np.flatnonzero(new)[1:] - 1, len(again) - 1)] if len(again) else again
            begin, end = at[first], at[last] + window
            of, common = row[first], {"repeat": w[first].view(np.int64), "occurrences": n[first]}
            if every:
                yield C.batch(_MEMBER, h1=np.full(len(of), group[0]), h2=h2[of], p=begun[of] + begin, length=end - begin, **common)
            else:
                yield C.batch(_OCCURRENCE, id=ids[of], tk=keys[of], s=s[of] + begin, e=s[of] + end, **common)

        for b in batches:
            for h1, part, *rest in zip(*(c.to_pylist() for c in b.columns)):
                if held and (h1, part) != group:
                    yield from found()
                    held = []
                group = (h1, part)
                held.append(rest)
        if held:
            yield from found()

    crowded = C.map_arrow(fetched.where(F.col("m") > array_runs).select("h1", "m", "id", "tk", "s", "run", "off", "h2", "n", "bytes"), windows,
                          "h1 long, part long, id long, tk long, s long, off int, h2 long, n long, at int, w array<long>")
    counted = C.map_arrow(crowded.repartition("h1", "part").sortWithinPartitions("h1", "part"), count, given_schema)
    rest = arrayed.unionByName(counted)
    if every:  # a kind's place in a group is that of all its runs
        rest = (rest.join(live.select("h1", "h2", "id", "tk", "s"), ["h1", "h2"])
                .select("id", "tk", (F.col("s") + F.col("p")).alias("s"), (F.col("s") + F.col("p") + F.col("length")).alias("e"), "repeat", "occurrences"))
    return whole.unionByName(rest), keyed


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
           array_runs: int = ARRAY_RUNS) -> DataFrame:
    """Per document: bytes, bytes and spans removed, and the digest of what is left."""
    found, keyed = stretches(docs, id_col, text_col, window, gram, array_runs, False)
    marks = found.groupBy("id", "tk").agg(F.collect_set(F.struct("s", "e")).alias("marks"))

    def cut(batches):
        for b in batches:
            rows = []
            for i, text, spans in zip(*(c.to_pylist() for c in b.columns)):
                raw = text.encode()
                kept, at, end, count, removed = [], 0, -1, 0, 0
                for s, e in sorted((m["s"], m["e"]) for m in spans or ()):
                    if s > end:
                        kept.append(raw[at:s])
                        count, removed, at, end = count + 1, removed + e - s, e, e
                    elif e > end:
                        removed, at, end = removed + e - end, e, e
                kept.append(raw[at:])
                rows.append((None if i == _LOW else i, len(raw), removed, count, C.sha(b"".join(kept))))
            if rows:
                yield C.batch(_OUT, **dict(zip(_OUT.names, zip(*rows))))

    return C.map_arrow(keyed.join(marks, ["id", "tk"], "left").select("id", "text", "marks"), cut, OUT_SCHEMA)
