"""Exact and near deduplication and removal of repeats against brute force."""

import itertools
import random

import numpy as np
import pytest
from awkward import empty, key, rows, sha, table

from weighline.llm import exact_dedup, near_dedup, repeats


def exact_brute(data):
    groups = {}
    for i, t in data:
        groups.setdefault(t or "", []).append(i)
    low = lambda i: -1 if i is None else i
    return {t: (max(ids, key=low), len(ids)) for t, ids in groups.items()}


@pytest.mark.parametrize("bits,capacity", [(62, 64), (5, 2)])  # five bits: texts share hashes and are chained
def test_exact(spark, bits, capacity):
    data = rows() + [(100 + i, f"t{i % 150}") for i in range(400)]
    got, index = exact_dedup.exact_dedup(table(spark, data), hash_bits=bits, bucket_keys=capacity)
    got, want = got.collect(), exact_brute(data)
    by = {sha(t): v for t, v in want.items()}
    assert len(got) == len(data)
    assert all((r.keep_id, r.group_size) == by[r.text_sha256] and (not r.kept or r.doc_id == r.keep_id) for r in got)
    assert sorted(r.text_sha256 for r in got if r.kept) == sorted(by)
    chains = index.agg({"chain": "max", "depth": "max"}).first()
    assert (chains["max(chain)"] > 0) == (bits == 5)


def test_extendible_hash_doubles_and_splits():
    h, rng = exact_dedup.ExtendibleHash(16, 4), random.Random(1)
    keys = [rng.randrange(1 << 16) for _ in range(3_000)]
    for k in keys:
        h.slot(k).append(k)
    assert len(h.directory) == 1 << h.depth
    for k in keys:
        assert set(h.slot(k)) == {k}
    for first, bucket in h.buckets():
        assert len(bucket.slots) <= 4
        assert all(k >> (16 - bucket.depth) == first >> (h.depth - bucket.depth) for k in bucket.slots)
    assert sum(len(b.slots) for _, b in h.buckets()) == len(set(keys))


def test_exact_empty_and_keep_one(spark):
    assert exact_dedup.exact_dedup(empty(spark))[0].count() == 0
    kept = exact_dedup.keep_one(table(spark))
    assert kept.columns == table(spark).columns
    got = sorted((r.text or "") for r in kept.collect())
    assert got == sorted({t or "" for _, t in rows()})


def shingles(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set()


def near_brute(data, size, percent):
    sets = [shingles(t, size) for _, t in data]
    parent = list(range(len(data)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(data)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
    out = []
    for k, (i, _) in enumerate(data):
        ids = [j for m, (j, _) in enumerate(data) if find(m) == find(k) and j is not None]
        c = (min(ids) if ids else None) if sets[k] else i
        out.append((i, len(sets[k]), c, i == c, find(k)))
    return out


def family(seed, n=150):
    """Chains and stars of texts that differ in a few words, around the threshold."""
    rng = random.Random(seed)
    out, base = [], []
    for i in range(n):
        if not base or rng.random() < 0.12:
            base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 8, 60, 60]))]
        w = list(base)
        for _ in range(rng.randrange(0, 6)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(4000)}"
        if rng.random() < 0.3:
            base = w
        out.append((1000 + i * 7 % n, " ".join(w)))
    return out


@pytest.mark.parametrize("size", [2, 5])
def test_near(spark, size):
    data = rows() + family(size)
    got = near_dedup.near_dedup(table(spark, data), size=size).collect()
    want = near_brute(data, size, 80)
    assert sorted([tuple(r)[:4] for r in got], key=key) == sorted([w[:4] for w in want], key=key)
    assert sum(r.stays for r in got) == len({w[4] for w in want})


def test_near_mixed_buckets_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    data = family(3)
    got = near_dedup.near_dedup(table(spark, data)).collect()
    assert sorted([tuple(r)[:4] for r in got], key=key) == sorted([w[:4] for w in near_brute(data, 2, 80)], key=key)


def kept_one(files, name, df):
    files.setdefault(name, []).append(df)
    return df


def test_near_light_tables_are_few_tasks(spark, monkeypatch):
    """With many shuffle partitions, a table of few numbers is not written by a task for each of them."""
    files, table_of = {}, near_dedup.C.table
    monkeypatch.setattr(near_dedup.C, "table", lambda df, name: kept_one(files, name, table_of(df, name)))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "48")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        data = family(3)
        got = near_dedup.near_dedup(table(spark, data)).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert sorted([tuple(r)[:4] for r in got], key=key) == sorted([w[:4] for w in near_brute(data, 2, 80)], key=key)
    most = 2 * spark.sparkContext.defaultParallelism
    names = ("classes", "crowded", "buckets", "met", "hubs", "edges", "labels", "open", "mixed")
    assert all(len(t.inputFiles()) <= most for n in names for t in files[n])


def test_near_buckets_of_two_are_settled_by_their_pair(spark, monkeypatch):
    """Pairs that share a bucket but are no link were judged once and are not compared again in blocks."""
    found, table_of = {}, near_dedup.C.table
    monkeypatch.setattr(near_dedup.C, "table", lambda df, name: kept_one(found, name, table_of(df, name)))
    data = []
    for i in range(20):
        words = [f"w{i}x{j}" for j in range(100)]
        data += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:75] + [f"v{i}x{j}" for j in range(25)]))]
    got = near_dedup.near_dedup(table(spark, data)).collect()
    assert all(r.kept for r in got) and len(got) == 40
    assert found["crowded"][0].count() > 0 and found["mixed"][0].count() == 0


def test_near_chain_of_links(spark):
    data = [(i, " ".join(f"k{j}" for j in range(i * 2, i * 2 + 60))) for i in range(40)]
    got = near_dedup.near_dedup(table(spark, data)).collect()
    assert {r.component_id for r in got} == {0} and sum(r.kept for r in got) == 1


def test_long_text_in_pieces(monkeypatch):
    words = [f"w{i % 977}" for i in range(3_000)]
    raw = " ".join(words).encode()
    want = near_dedup.document_sets([raw.decode()], 3)[0]
    for part in (7, 50, 1_000):
        monkeypatch.setattr(near_dedup, "PART", part)
        assert np.array_equal(near_dedup.long_set(raw, 3), want)
        assert np.array_equal(near_dedup.long_set(b"  one  ", 3), near_dedup.shingle_set(near_dedup.word_hashes(b"one")[0], 3))
        assert len(near_dedup.long_set(b" " * 40, 3)) == 0


def test_posterior_bounds():
    # the bound by numerical integration of the beta density over (t, 1)
    grid = np.linspace(0.8, 1, 20_001)
    for k, least in enumerate(near_dedup.least_matches(0.8)):
        n = (k + 1) * near_dedup.BATCH
        def tail(m):
            density = grid ** m * (1 - grid) ** (n - m)
            whole = np.linspace(0, 1, 100_001)
            return np.trapezoid(density, grid) / np.trapezoid(whole ** m * (1 - whole) ** (n - m), whole)
        assert tail(least) >= near_dedup.MISS * 0.99 and (least == 0 or tail(least - 1) < near_dedup.MISS * 1.01)


def test_near_empty_and_keep_one(spark):
    assert near_dedup.near_dedup(empty(spark)).count() == 0
    data = [(1, "a b c d e f"), (2, "a b c d e f"), (3, None), (4, ""), (5, "q r s")]
    kept = near_dedup.keep_one(table(spark, data))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5] and kept.columns == table(spark).columns


def repeats_brute(data, w):
    texts = [(t or "").encode() for _, t in data]
    counts = {}
    for x in texts:
        for i in range(len(x) - w + 1):
            counts[x[i:i + w]] = counts.get(x[i:i + w], 0) + 1
    out = []
    for (i, _), x in zip(data, texts):
        gone = np.zeros(len(x), bool)
        for s in range(len(x) - w + 1):
            if counts[x[s:s + w]] > 1:
                gone[s:s + w] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((i, len(x), int(gone.sum()), spans, sha(bytes(b for b, g in zip(x, gone) if not g))))
    return out


def passages(seed):
    rng = random.Random(seed)
    letters = "ab" if seed % 2 else "abcdefgh é"
    own = lambda a, b: "".join(rng.choice(letters) for _ in range(rng.randint(a, b)))
    shared = [own(15, 90) for _ in range(8)]
    data = [(i, "".join(rng.choice(shared) if rng.random() < 0.5 else own(1, 40) for _ in range(rng.randint(0, 6)))) for i in range(60)]
    return data + [(70, "a" * 70), (71, "ab" * 50), (72, None), (3, data[3][1]), (3, data[3][1]), (None, data[4][1])]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("array_runs", [2_000, 1])  # 1: windows are counted instead of sorted
def test_repeats(spark, seed, array_runs):
    data = passages(seed)
    got = repeats.remove(table(spark, data), window=20, gram=4, array_runs=array_runs).collect()
    assert sorted(map(tuple, got), key=key) == sorted(repeats_brute(data, 20), key=key)


def test_repeats_production_window(spark):
    got = repeats.remove(table(spark)).collect()
    assert sorted(map(tuple, got), key=key) == sorted(repeats_brute(rows(), 200), key=key)
    assert repeats.remove(empty(spark)).count() == 0


def test_repeat_groups_hold_all_members():
    texts = [b"xxHELLOWORLDyy", b"zHELLOWORLDq", b"HELLOWORLD"]
    found = repeats.maximal_repeats(texts, [len(t) for t in texts], [-1] * 3, 10)
    assert [(length, members, sorted(places)) for length, members, places in found] == [(10, 3, [(0, 2), (1, 1), (2, 0)])]


@pytest.mark.parametrize("seed", [1, 2])
def test_occurrences_list_all_members(spark, seed):
    """Every group lists all places of its string in the corpus, whatever runs and deeper groups they lie in."""
    data = passages(seed)
    data += [(100 + i, data[5][1] + "!" + data[6][1]) for i in range(4)] + [(110, "?" + data[5][1] + "?" + data[6][1])]
    found, keyed = repeats.occurrences(table(spark, data), window=20, gram=4)
    texts = [(r.id, r.tk, r.text.encode()) for r in keyed.collect()]
    of, groups = {(i, tk): t for i, tk, t in texts}, {}
    for r in found.collect():
        groups.setdefault(r.repeat, []).append(r)
    assert len(groups) > 10
    for members in groups.values():
        strings = {of[r.id, r.tk][r.s:r.e] for r in members}
        assert len(strings) == 1 and len(next(iter(strings))) >= 20
        piece = strings.pop()
        want = sorted((i, tk, s) for i, tk, t in texts for s in range(len(t)) if t.startswith(piece, s))
        assert sorted((r.id, r.tk, r.s) for r in members) == want
        assert {r.occurrences for r in members} == {len(want)}


def test_runs_of_parts(monkeypatch):
    """A long text cut into parts gives the same windows, none twice."""
    import pyarrow as pa
    monkeypatch.setattr(repeats, "PART", 37)
    text = "".join(random.Random(5).choice("abc") for _ in range(500))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([1]), pa.array([text])], names=["id", "tk", "text"])
    seen = []
    for data, valid, index in repeats.parts(batch, 20):
        first, length, *_ = repeats.runs(data, valid, 20, 4)
        begins = [i[1] for i in index]
        for f, n in zip(first.tolist(), length.tolist()):
            k = max(j for j, b in enumerate(begins) if b <= f)
            seen += range(f - begins[k] + index[k][2], f - begins[k] + index[k][2] + n)
    assert sorted(seen) == list(range(481))
