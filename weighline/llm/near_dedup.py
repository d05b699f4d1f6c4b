"""Operator 5: near-duplicates by MinHash bands, sequential Bayesian verification and exact confirmation.

1. A document's set of word shingles, hashed to 64 bits, gives a signature; rows with equal sets form one class.
2. Classes that agree in all rows of a band are candidates.  In each crowded bucket every member is paired with one hub, not
   with every other member.
3. Signatures of a pair are compared batch by batch; a pair is dropped as soon as the posterior probability that its
   similarity reaches the threshold falls below ``MISS`` (uniform prior).  Survivors are confirmed on their full sets.
4. Confirmed links are joined into components.  Buckets whose members are all in one component need nothing more.
   In the others every member meets every other, in blocks, leaving out pairs that are already in one component.  So
   every pair of a bucket is either linked through its component or was itself dropped or compared: no cap on partners.

How it scales.  Signatures are made where texts are read.  A bucket's hub is the member that meets most others over all
buckets, as the centre of a group of near copies does.  Sizes and hubs come from aggregates; joins on bucket keys can
be split when skewed.  Texts of candidates alone are moved, once, and a hub with many partners is copied to several tasks.
A pair below the threshold cannot be linked; one at 0.8 is missed by all bands with probability 3e-6.

Defined results.  Null text is empty.  A text with fewer words than a shingle is one shingle of all of them; without words the
set is empty and linked with nothing, not even another empty one: its component is its own doc_id.  The component is the
smallest doc_id reachable, null only if all are null; ``kept`` tells whether it is the row's own doc_id.  Of repeated
rows all are kept or none, while ``stays`` marks exactly one row of a component.  An empty table gives no rows.
Only the two named columns are read.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from weighline.llm import common as C
from weighline.llm.repeats import BYTES, RangeHash

BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
#: Hashes compared before the posterior is looked at again; the probability at which a pair is given up.
BATCH, MISS = 32, 1e-6
#: Members of a block; partners of a hub's copy.
BLOCK, PARTNERS = 256, 500
#: Bytes of text hashed at a time.
PART = 1 << 20
#: Rows of numbers that a task writes at least, where the session has more partitions than its cores need.
TASK_ROWS = 50_000
_LOW = -(1 << 63)
_HIGH = (1 << 63) - 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_DRAW = np.random.default_rng(20240229)
_XOR = _DRAW.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_ODD = _DRAW.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)

_ROW = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("id", pa.int64()), ("tk", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()),
                  ("n", pa.int64()), ("bands", pa.list_(pa.int64())), ("sig", pa.binary())])
ROW_SCHEMA = "rid long, doc_id long, id long, tk long, k1 long, k2 long, n long, bands array<long>, sig binary"


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of every word of lower-cased bytes.  The hash does not depend on where the word stands."""
    data = np.frombuffer(raw, np.uint8)
    inside = np.concatenate(([False], ~_SPACE[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    return RangeHash(BYTES[data]).of(start, end), start


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct shingles of a document's word hashes, ascending."""
    if not len(words):
        return words
    size = min(size, len(words))
    h = np.full(len(words) - size + 1, size, np.uint64)
    for j in range(size):
        h = C.mix64(h * np.uint64(0x9E3779B97F4A7C15) + words[j:j + len(h)])
    return np.unique(h)


def document_sets(texts: list[str], size: int):
    """The shingle set of every text; short texts are hashed together, long ones piece by piece."""
    out: list[np.ndarray | None] = [None] * len(texts)
    held: list[tuple[int, bytes]] = []
    length = 0

    def flush():
        begins = np.cumsum([0, *(len(r) + 1 for _, r in held)])
        words, at = word_hashes(b"\n".join(r for _, r in held) + b"\n")
        edges = np.searchsorted(at, begins)
        for k, (place, _) in enumerate(held):
            out[place] = shingle_set(words[edges[k]:edges[k + 1]], size)

    for place, text in enumerate(texts):
        raw = text.encode().lower()
        if len(raw) > PART:
            out[place] = long_set(raw, size)
            continue
        if length + len(raw) > PART:
            flush()
            held, length = [], 0
        held.append((place, raw))
        length += len(raw)
    if held:
        flush()
    return out


def long_set(raw: bytes, size: int) -> np.ndarray:
    """The set of one long text, from pieces that end at a space; the last words of a piece are carried to the next."""
    sets, carried, at = [], np.zeros(0, np.uint64), 0
    while at < len(raw):
        end = at + PART
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        words = np.concatenate((carried, word_hashes(raw[at:end])[0]))
        at = end
        if len(words) < size and at < len(raw):
            carried = words
            continue
        sets.append(shingle_set(words, size))
        carried = words[len(words) - size + 1:] if size > 1 else words[:0]
    if len(sets) > 1 and len(words) < size:
        sets.pop()  # what was left over is part of the last whole shingles
    return np.unique(np.concatenate(sets)) if sets else carried


def signature(shingles: np.ndarray) -> np.ndarray:
    x = ((shingles ^ (shingles >> np.uint64(32))) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for s in range(0, len(x), 1_000):
        np.minimum(out, ((x[s:s + 1_000, None] ^ _XOR) * _ODD).min(axis=0), out=out)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in sig.reshape(BANDS, ROWS).T:
        h = C.mix64(h * np.uint64(0x9E3779B97F4A7C15) + column)
    return h.view(np.int64)


@functools.cache
def least_matches(threshold: float, miss: float = MISS) -> tuple[int, ...]:
    """For 1, 2, ... batches: the fewest equal hashes at which P(similarity >= threshold | matches) still reaches
    ``miss``.  With a uniform prior the posterior is a beta distribution, and its upper tail a binomial sum."""
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        # P(Beta(m+1, n-m+1) > t) = P(Binomial(n+1, t) <= m)
        total, m = 0.0, -1
        while total < miss and m < n:
            m += 1
            total += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def survive(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether each pair of signature rows comes through all batches."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for k, least in enumerate(least_matches(threshold)):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches[alive] += (a[alive, part] == b[alive, part]).sum(axis=1)
        alive = alive[matches[alive] >= least]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def signed(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """A row per document; band keys and signature with the first row of a set that a task meets."""
    def run(batches):
        rid, seen = TaskContext.get().partitionId() << 36, set()
        for b in batches:
            rows = []
            for doc_id, tk, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), document_sets(b.column(2).to_pylist(), size)):
                digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                bands = short = None
                if len(found) and digest not in seen:
                    seen.add(digest)
                    sig = signature(found)
                    bands, short = band_keys(sig), (C.mix64(sig) & np.uint64(255)).astype(np.uint8).tobytes()
                rows.append((rid, doc_id, _LOW if doc_id is None else doc_id, tk, int.from_bytes(digest[:8], "big", signed=True),
                             int.from_bytes(digest[8:], "big", signed=True), len(found), bands, short))
                rid += 1
            if rows:
                yield C.batch(_ROW, **dict(zip(_ROW.names, zip(*rows))))

    text = C.text_of(text_col)
    return C.map_arrow(docs.select(F.col(id_col).cast("long"), F.xxhash64(text), text), run, ROW_SCHEMA)


def _sigs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, HASHES)


def pruned(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Of pairs (hub, cid) those whose signatures survive."""
    schema = pa.schema([("hub", pa.int64()), ("cid", pa.int64())])

    def run(batches):
        for b in batches:
            yield b.select(["hub", "cid"]).filter(pa.array(survive(_sigs(b.column("a")), _sigs(b.column("b")), threshold))).cast(schema)

    sigs = classes.select("cid", "sig")
    both = (pairs.join(sigs.select(F.col("cid").alias("hub"), F.col("sig").alias("a")), "hub")
            .join(sigs.select("cid", F.col("sig").alias("b")), "cid").select("hub", "cid", "a", "b"))
    return C.map_arrow(both, run, "hub long, cid long")


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Of pairs (hub, cid) those whose full sets reach the similarity.  Partners of a hub are dealt to copies of it."""
    hubs = pairs.groupBy("hub").agg(F.count("*").alias("n")).select(
        "hub", F.ceil(F.col("n") / PARTNERS).cast("int").alias("copies"))
    partners = (pairs.join(hubs, "hub").withColumn("copy", F.pmod(F.xxhash64("cid"), F.col("copies")).cast("int"))
                .join(texts, "cid").select("hub", "copy", "cid", "text"))
    centres = (hubs.join(texts, hubs["hub"] == texts["cid"])
               .select("hub", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(None).cast("long").alias("cid"), "text"))
    schema = pa.schema([("hub", pa.int64()), ("cid", pa.int64())])

    def run(batches):
        group, own = None, None
        for b in batches:
            rows = []
            columns = [b.column(i).to_pylist() for i in range(3)]
            for hub, copy, cid, found in zip(*columns, document_sets(b.column(3).to_pylist(), size)):
                if cid is None:
                    group, own = (hub, copy), found
                elif (hub, copy) == group:
                    common = len(np.intersect1d(own, found, assume_unique=True))
                    if 100 * common >= percent * (len(own) + len(found) - common):
                        rows.append((hub, cid))
            if rows:
                yield C.batch(schema, **dict(zip(schema.names, zip(*rows))))

    dealt = centres.unionByName(partners).repartition("hub", "copy").sortWithinPartitions("hub", "copy", F.col("cid").asc_nulls_first())
    return C.map_arrow(dealt, run, "hub long, cid long")


def light(df: DataFrame, rows: int, name: str) -> DataFrame:
    """A table of at most so many rows of a few numbers, written by no more tasks than they need.

    Its shuffles follow the session's partitions, which suit texts; thousands of tasks of a few rows each would cost more
    than the rows.  A session with adaptive coalescing comes to the same; tables that need more tasks keep them all."""
    tasks = max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    return C.table(df.coalesce(tasks), name)


def components(links: DataFrame) -> DataFrame:
    """(cid, comp): the smallest node reachable over links (hub, cid), for nodes that have any.

    Each round takes the least label of all neighbours, then follows labels one step (so long chains halve)."""
    n = 2 * links.count()
    edges = light(links.select(F.col("hub").alias("a"), F.col("cid").alias("b")).union(links.select("cid", "hub")).distinct(), n, "edges")
    labels = light(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("comp")).withColumnRenamed("a", "cid"), n, "labels")
    while True:
        near = (edges.join(labels.select(F.col("cid").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("near")))
        moved = labels.join(near, labels["cid"] == near["a"]).select("cid", "comp", F.least("comp", "near").alias("to"))
        follow = labels.select(F.col("cid").alias("to"), F.col("comp").alias("next"))
        new = light(moved.join(follow, "to", "left").select("cid", F.least("to", F.coalesce("next", "to")).alias("new"), "comp"), n, "labels")
        changed = new.where("new < comp").limit(1).count()
        labels = new.select("cid", F.col("new").alias("comp"))
        if not changed:
            return labels


def blocks(mixed: DataFrame, firsts: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (hub, cid) between different components within buckets (key, cid, comp), every member with every other.

    A bucket's members are dealt into blocks of about ``BLOCK``; each pair of blocks is one group of rows.  A pair is
    looked at in the first band it shares only.  Survivors of the signatures are confirmed on their full sets at once,
    so that what leaves the task are links, and of those only such as join components.
    """
    sizes = light(mixed.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")), mixed.count(), "sizes")
    placed = (mixed.join(sizes, "key").withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
              .join(firsts.select("cid", "bands", "sig"), "cid").join(texts, "cid"))
    # a member goes to the pairs (part, j) for j >= part and (i, part) for i < part
    dealt = (placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "cid", "comp", "bands", "sig", "text"))
    schema = pa.schema([("hub", pa.int64()), ("cid", pa.int64())])
    threshold = percent / 100

    def run(batches):
        held, group = [], None

        def found():
            cid, comp, part = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("cid", "comp", "part"))
            bands = np.concatenate([b.column("bands").flatten().to_numpy() for b in held]).reshape(-1, BANDS)
            sig = np.concatenate([_sigs(b.column("sig")) for b in held])
            key, i, j = group
            left = np.flatnonzero(part == i)
            right = left if i == j else np.flatnonzero(part == j)
            texts, sets = pa.chunked_array([b.column("text") for b in held]), {}  # sets of members that some signature lets through
            joined: dict[int, int] = {}

            def root(c: int) -> int:
                while c in joined:
                    c = joined[c]
                return c

            links = []
            for a in left:
                own = root(int(comp[a]))
                other = right[cid[right] > cid[a]] if i == j else right
                other = other[np.array([root(c) != own for c in comp[other].tolist()], bool)] if joined else other[comp[other] != own]
                shared = bands[other] == bands[a]
                other = other[bands[a][shared.argmax(axis=1)] == key]
                if not len(other):
                    continue
                other = other[survive(np.broadcast_to(sig[a], (len(other), HASHES)), sig[other], threshold)]
                if not len(other):
                    continue
                unread = [k for k in (int(a), *other.tolist()) if k not in sets]
                if unread:
                    sets.update(zip(unread, document_sets(texts.take(pa.array(unread)).to_pylist(), size)))
                mine, theirs = sets[int(a)], [sets[o] for o in other.tolist()]
                lengths, flat = np.array([len(x) for x in theirs]), np.concatenate(theirs)
                at = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
                common = np.add.reduceat((mine[at] == flat).astype(np.int64), np.cumsum(lengths) - lengths)  # no set is empty
                for o in other[100 * common >= percent * (len(mine) + lengths - common)].tolist():
                    x, y = root(int(comp[a])), root(int(comp[o]))
                    if x != y:
                        joined[max(x, y)] = min(x, y)
                        links.append((int(cid[a]), int(cid[o])))
            if links:
                yield C.batch(schema, **dict(zip(schema.names, zip(*links))))

        for b in batches:
            key, i, j = (b.column(c).to_numpy() for c in ("key", "i", "j"))
            edges = [0, *(np.flatnonzero((np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1), len(key)]
            for s, e in zip(edges, edges[1:]):
                if s == e:
                    continue
                this = (int(key[s]), int(i[s]), int(j[s]))
                if held and this != group:
                    yield from found()
                    held = []
                group = this
                held.append(b.slice(s, e - s))
        if held:
            yield from found()

    return C.map_arrow(dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"), run, "hub long, cid long")


def near_dedup(docs: DataFrame, size: int = 2, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept, stays, and ``tk`` (hash of the text), one row per row of the input."""
    threshold = percent / 100
    rows = C.table(signed(docs, size, id_col, text_col), "signed")
    n = rows.count()
    classes = light(rows.where("n > 0").groupBy("k1", "k2").agg(
        F.min("rid").alias("cid"), F.min(F.struct(F.coalesce("doc_id", F.lit(_HIGH)).alias("id"), "rid")).alias("best")), n, "classes")
    firsts = C.table(rows.where("bands IS NOT NULL").join(classes.select(F.col("cid").alias("rid")), "rid")
                     .select(F.col("rid").alias("cid"), "id", "tk", "bands", "sig"), "first-rows")
    members = firsts.select(F.explode("bands").alias("key"), "cid")
    # tables of their own: a join right above an aggregate could not be split when a key is crowded
    crowded = light(members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), BANDS * n, "crowded")
    live = light(members.join(crowded, "key"), BANDS * n, "buckets")
    n_live = live.count()
    # the centre of a group of near copies meets more members, in more buckets, than they meet each other
    met = light(live.groupBy("cid").agg(F.sum("size").alias("met")), n, "met")
    live = light(live.join(met, "cid").select("key", "cid", "size", F.struct("met", F.xxhash64("cid").alias("tie")).alias("rank")), n_live, "buckets")
    centres = light(live.groupBy("key").agg(F.max_by("cid", "rank").alias("hub")), n_live, "hubs")
    keyed = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LOW)).alias("id"), F.xxhash64(C.text_of(text_col)).alias("tk"),
                        C.text_of(text_col).alias("text"))
    first = live.select("key", "cid").join(centres, "key").where("hub <> cid").select("hub", "cid").distinct()
    pairs = C.table(pruned(first, firsts, threshold), "pairs")
    wanted = live.select("cid").distinct().join(firsts.select("cid", "id", "tk"), "cid")
    # a repeated row (same doc_id, same text) would bring its text twice: one is enough
    texts = C.table(keyed.join(wanted, ["id", "tk"]).select("cid", "text").dropDuplicates(["cid"]), "texts")
    links = C.table(confirmed(pairs, texts, size, percent), "links")
    labels = components(links)
    # buckets whose members are not yet in one component; the one pair of a bucket of two was judged with its hub
    tagged = live.where("size > 2").join(labels, "cid", "left").select("key", "cid", F.coalesce("comp", "cid").alias("comp"))
    open_ = light(tagged.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key"), n_live, "open")
    mixed = light(tagged.join(open_, "key"), n_live, "mixed")
    if mixed.limit(1).count():
        links = C.table(links.union(blocks(mixed, firsts, texts, size, percent)), "links")
        labels = components(links)
    named = classes.join(labels, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    best = named.groupBy("comp").agg(F.min("best").alias("best"))
    found = named.select("k1", "k2", "comp").join(best, "comp").select(
        "k1", "k2", F.when(F.col("best.id") < _HIGH, F.col("best.id")).alias("low"), F.col("best.rid").alias("first"))
    joined = rows.drop("bands", "sig").join(found, ["k1", "k2"], "left")
    component = F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"),
                         ((F.col("n") == 0) | (F.col("rid") == F.col("first"))).alias("stays"), "tk")


def keep_one(docs: DataFrame, size: int = 2, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every component, that with the smallest id, with all its columns."""
    found = near_dedup(docs, size, percent, id_col, text_col).where("stays").select(F.col("doc_id").alias("__id"), F.col("tk").alias("__of"))
    marked = docs.withColumn("__tk", F.xxhash64(C.text_of(text_col)))
    return C.one_each(marked, found, (marked["__tk"] == found["__of"]) & marked[id_col].eqNullSafe(found["__id"]), [id_col, "__tk"], docs.columns)
