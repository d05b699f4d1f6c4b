"""Operator 11: periodic runs of words, found by multi-scale minimizers.

A run is a stretch of words with smallest period q, at least ``MIN_WORDS`` and two periods long, that no neighbouring word
extends.  A batch of documents becomes one array of word numbers with a different mark after each document, so that one
set of array operations serves many short texts; a long text is a batch of its own.

Periods below ``SCAN_BELOW`` are found by comparing the array with itself at each lag.  For the periods of a scale, Q up to
2Q - 1, every window of Q/2 places names the place whose following Q/2 words have the least hash (the leftmost of
equals).  A run of two such periods holds a whole window and the same window one period later; both name the same place
of the period, so equal minima at a distance of the scale lead to every run.  Equal minima less than Q/4 apart lie in one
stretch of a short period; such a chain is kept as its ends and step, and two chains give each distance between them
once.  Every seed is extended by comparing words, so hashes never decide: a collision costs time only.  Of the periods
found for a stretch the least is its smallest.

Scale.  One pass without a shuffle; a task holds a batch of ``BATCH_WORDS`` words or one text.  Per scale the work is
linear in the words, and scales double, so a text costs words times the logarithm of its length, besides the runs
themselves.

Defined results.  Null and empty texts and texts of blanks have no words and no runs.  Rows with equal or null doc_id stay
separate.  An empty table gives no rows.  Only the two named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weighline.llm import common as C

MIN_WORDS = 12
#: Periods below this are compared lag by lag; a power of two.
SCAN_BELOW = 32
#: Words worked on at once; a longer text is a batch of its own.
BATCH_WORDS = 200_000
#: Fixed value: the characters that part words, besides the plain space.
BLANKS = "\t\n\x0b\x0c\r"

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])
OUT_SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"

Rewrite = Callable[[int | None, list[str]], list[str]]


def words_of(text: str) -> list[str]:
    for c in BLANKS:
        if c in text:
            text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def planted(doc_id: int | None, words: list[str]) -> list[str]:
    """The words of the contract's query: in a tenth of the documents, chosen by a checksum of the id, a part from word
    ``a`` on repeats with period ``p``.  A null id leaves the words alone."""
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    root = words[a:a + p]
    return words[:a] + (root * ((n - a) // p + 1))[:n - a]


def window_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least key of every window of ``width`` places (running minima of blocks from both sides)."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(keys.dtype).max, keys.dtype)
    padded[:len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """The places that windows of ``width`` name: least hash (of its upper bits), leftmost of equals."""
    bits = np.uint64(len(hashes).bit_length())
    keys = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    at = (window_least(keys, width) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    return at[np.concatenate(([True], at[1:] != at[:-1]))]


def stretches(x: np.ndarray, lag: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches [a, b) of at least ``least`` places where ``x`` equals itself ``lag`` places on."""
    equal = np.flatnonzero(x[:-lag] == x[lag:])
    if not len(equal):
        return equal, equal
    edges = np.flatnonzero(np.diff(equal) != 1)
    a, b = equal[np.concatenate(([0], edges + 1))], equal[np.concatenate((edges, [len(equal) - 1]))] + 1
    keep = b - a >= least
    return a[keep], b[keep]


def seeds(at: np.ndarray, hashes: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place, distance) of equal minima with a distance of the scale, each distance of two chains once."""
    none = np.empty(0, np.int64)
    if len(at) < 2:
        return none, none
    order = np.argsort(hashes[at], kind="stable")
    at, h = at[order], hashes[at][order]
    gap = np.diff(at)
    chained = (h[1:] == h[:-1]) & (gap <= scale // 4)
    start = np.flatnonzero(np.concatenate(([True], ~chained)))
    end = np.append(start[1:], len(at)) - 1
    first, last, name = at[start], at[end], h[start]
    steps = np.concatenate(([0], np.where(chained, gap, 0)))  # a chain's first place adds nothing to its common step
    step = np.gcd.reduceat(steps, start)
    places, distances = [], []
    for ahead in range(1, len(first)):
        near = np.flatnonzero((name[ahead:] == name[:-ahead]) & (first[ahead:] - last[:-ahead] < 2 * scale))
        if not len(near):
            break
        near = near[last[near + ahead] - first[near] >= scale]
        if not len(near):
            continue
        one, two = near, near + ahead
        by = np.gcd(step[one], step[two])
        low, high = first[two] - last[one], np.minimum(last[two] - first[one], 2 * scale - 1)
        by = np.where(by == 0, 1 << 40, by)
        low = low + np.maximum(0, -(-(scale - low) // by)) * by
        count = np.maximum(0, (high - low) // by + 1)
        pair = np.repeat(np.arange(len(near)), count)
        nth = np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count)
        d = low[pair] + nth * by[pair]
        places.append(np.clip(last[two][pair] - d, first[one][pair], last[one][pair]))
        distances.append(d)
    return (np.concatenate(places), np.concatenate(distances)) if places else (none, none)


def reach(x: np.ndarray, i: int, d: int) -> tuple[int, int]:
    """The stretch around ``i`` where ``x`` equals itself ``d`` places on; compared in growing pieces."""
    right, size = i, 64
    while right + d < len(x):
        piece = x[right + d:right + d + size]
        differ = np.flatnonzero(x[right:right + len(piece)] != piece)
        if len(differ):
            right += int(differ[0])
            break
        right, size = right + len(piece), 2 * size
    left, size = i, 64
    while left > 0:
        low = max(0, left - size)
        differ = np.flatnonzero(x[low:left] != x[low + d:left + d])
        if len(differ):
            left = low + int(differ[-1]) + 1
            break
        left, size = low, 2 * size
    return left, right


def runs_of(x: np.ndarray, ends: np.ndarray, min_words: int = MIN_WORDS, scan_below: int = SCAN_BELOW) -> np.ndarray:
    """All runs (start, length, period) of the array by start and period; texts end at ``ends`` with marks of their own."""
    found = []
    lengths = np.diff(np.concatenate(([0], ends)))
    longest = int(lengths.max(initial=0))
    for q in range(1, min(scan_below, longest // 2 + 1)):
        a, b = stretches(x, q, max(min_words - q, q))
        found.append(np.stack((a, b + q, np.full(len(a), q)), axis=1))
    scale, size = scan_below, 1
    y, place, h = x, None, C.mix64(x.astype(np.uint64) + np.uint64(1))
    while 2 * scale <= longest:
        kept = lengths >= 2 * scale
        if not kept.all():  # only texts that can hold two periods of this scale
            inside = np.repeat(kept, lengths)
            y, h = y[inside], h[inside]
            place = np.flatnonzero(inside) if place is None else place[inside]
            lengths = lengths[kept]
        while 2 * size <= scale // 2:
            half = h
            h = C.mix64(h[:len(h) - size] * np.uint64(0x9E3779B97F4A7C15) + h[size:])
            h = np.concatenate((h, half[len(h):]))  # the last places have no such gram; their marks keep them apart
            size *= 2
        at, d = seeds(minima(h[:len(y) - size + 1], scale // 2), h, scale)
        if len(at):  # what holds a whole period goes on for half a gram to one side at least
            part = size // 2
            l, r = np.maximum(at - part, 0), np.minimum(at + size, len(y) - part)
            e = np.minimum(r + d, len(y) - part)
            going = (half[r] == half[e]) | (half[l] == half[l + d])
            at, d = at[going], d[going]
        covered: dict[int, int] = {}
        out = []
        order = np.lexsort((at, d))
        for i, lag in zip(at[order].tolist(), d[order].tolist()):
            if i < covered.get(lag, 0):
                continue
            a, b = reach(y, i, lag)
            covered[lag] = b
            if b - a >= lag and b - a + lag >= min_words:
                out.append((a, b + lag, lag))
        if out:
            some = np.array(out, np.int64)
            if place is not None:
                some[:, 1] = place[some[:, 1] - 1] + 1
                some[:, 0] = place[some[:, 0]]
            found.append(some)
        scale *= 2
    every = np.concatenate(found) if found else np.empty((0, 3), np.int64)
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    fresh = np.ones(len(every), bool)  # a stretch found with several periods has the least
    fresh[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)
    every = every[fresh]
    every[:, 1] -= every[:, 0]
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def runs_of_texts(texts: list[list[str]], **options) -> list[np.ndarray]:
    """The runs of every list of words, places counted from its own first word."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes + 1)
    flat = np.empty(sum(sizes), object)
    flat[:] = [w for t in texts for w in t]
    codes, _ = pd.factorize(flat) if len(flat) else (np.empty(0, np.int64), None)
    x = np.insert(codes.astype(np.int64), np.cumsum(sizes), -1 - np.arange(len(texts)))  # a mark after each text
    runs = runs_of(x, ends, **options)
    starts = ends - sizes - 1
    owner = np.searchsorted(ends, runs[:, 0], side="right")
    runs[:, 0] -= starts[owner]
    return np.split(runs, np.searchsorted(owner, np.arange(1, len(texts))))


def collapse(words: list[str], runs: np.ndarray) -> list[str]:
    """The words without those that repeat: of every run only its first period stays, unless another run drops it."""
    if not len(runs):
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]


def find_runs(docs: DataFrame, rewrite: Rewrite | None = None, id_col: str = "doc_id", text_col: str = "text",
              min_words: int = MIN_WORDS) -> DataFrame:
    """Per document its number of words, its runs by start and period, and its text without repeats.

    ``rewrite`` may change a document's words first.
    """
    def work(batches: Iterable[pa.RecordBatch]):
        ids, texts, size = [], [], 0

        def done():
            found = runs_of_texts(texts, min_words=min_words)
            lists = [[{"start": s, "length": n, "period": q} for s, n, q in r.tolist()] for r in found]
            return C.batch(_OUT, doc_id=ids, n_words=[len(t) for t in texts], runs=lists,
                           collapsed=[" ".join(collapse(t, r)) for t, r in zip(texts, found)])

        for b in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in b.columns)):
                words = words_of(text)
                words = rewrite(doc_id, words) if rewrite else words
                if ids and size + len(words) > BATCH_WORDS:
                    yield done()
                    ids, texts, size = [], [], 0
                ids.append(doc_id)
                texts.append(words)
                size += len(words) + 1
        if ids:
            yield done()

    return C.map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), C.text_of(text_col).alias("text")), work, OUT_SCHEMA)


def digest(found: DataFrame) -> DataFrame:
    """Of :func:`find_runs`: the number of runs, the longest (then the first, then of least period), and checksums."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    return (found.withColumn("b", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("b.s")).alias("start"), F.col("b.length").alias("length"),
        (-F.col("b.p")).alias("period"), F.expr("1000 * b.length div -b.p").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words"))
