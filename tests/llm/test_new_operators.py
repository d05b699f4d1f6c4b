"""Periodic runs, token alignment and URL filter against plain versions."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from awkward import empty, key, rows, sha, table
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from weighline.llm import periodic_runs as pr, queries, token_alignment as ta, url_filter as uf

A, B = public_tokenizers.path(queries.BYTE_TOKENIZER), public_tokenizers.path(queries.PIECE_MODEL)


# --- periodic runs ----------------------------------------------------------------------------------------------------

def runs_brute(words, least=12):
    """Every maximal stretch of every period, by its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j - i + q >= least:
                found.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def texts_with_runs(rng, n):
    kind = int(rng.integers(0, 6))
    if kind == 0:
        w = rng.integers(0, 2, n)
    elif kind == 1:
        w = np.tile(rng.integers(0, 3, max(1, n // int(rng.integers(2, 9)))), 9)[:n]
    elif kind == 2:  # two stretches of one short period that meet: runs of many longer periods
        a = np.tile(rng.integers(0, 3, int(rng.integers(1, 8))), n + 1)[:n // 2]
        w = np.concatenate([a, rng.integers(0, 2, int(rng.integers(0, 3))), a])
    elif kind == 3:
        w = rng.integers(0, 50, n)
        for _ in range(3 * (n > 40)):
            p = int(rng.integers(1, n // 3))
            s = int(rng.integers(0, n - 2 * p))
            w[s:s + 3 * p] = np.tile(w[s:s + p], 3)[:len(w[s:s + 3 * p])]
    elif kind == 4:  # Fibonacci words hold the most runs
        a, b = "0", "01"
        while len(b) < n:
            a, b = b, b + a
        w = list(b[:n])
    else:
        w = ([0] * int(rng.integers(1, 60)) + [1]) * n
        w = w[:n]
    return [str(x) for x in w]


@pytest.mark.parametrize("scan_below", [4, 32])
def test_runs_equal_brute(scan_below):
    rng = np.random.default_rng(scan_below)
    for _ in range(40):
        texts = [texts_with_runs(rng, int(rng.integers(0, 500))) for _ in range(6)]
        for words, got in zip(texts, pr.runs_of_texts(texts, scan_below=scan_below)):
            assert list(map(tuple, got.tolist())) == runs_brute(words), (len(words), words[:30])


def test_long_periods_in_one_text():
    rng = np.random.default_rng(5)
    root = [str(x) for x in rng.integers(0, 1000, 3_000)]
    words = [*map(str, rng.integers(0, 1000, 500)), *root, *root, *root[:700], "end", *["x"] * 40]
    assert (500, 6_700, 3_000) in list(map(tuple, pr.runs_of_texts([words])[0].tolist()))


def runs_row(doc_id, text):
    words, part = [], ""
    for c in text or "":
        if c in " \t\n\x0b\x0c\r":
            words, part = words + [part] * bool(part), ""
        else:
            part += c
    words += [part] * bool(part)
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = runs_brute(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs)]
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(kept)), n)


def test_runs_query(spark):
    rng, r = np.random.default_rng(1), random.Random(1)
    data = [(i, t if t is None or len(t) < 20_000 else t[:9_000]) for i, t in rows()]
    data += [(100 + k, r.choice([" ", "\n", "\t "]).join(texts_with_runs(rng, int(rng.integers(0, 300))))) for k in range(80)]
    data += [(7, "x " * 50), (7, "x " * 50), (None, "y " * 30), (-8, "a\x0bb " * 12), (9, "a\x1cb " * 20)]
    got = sorted(map(tuple, pr.digest(pr.find_runs(table(spark, data), pr.planted)).collect()), key=key)
    want = sorted((runs_row(i, t) for i, t in data), key=key)
    assert sum(w[1] for w in want) > 100 and any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in data)
    assert got == want


def test_runs_empty_table(spark):
    out = pr.digest(pr.find_runs(empty(spark), pr.planted))
    assert out.count() == 0 and out.columns[:8] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_batches_do_not_matter(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [texts_with_runs(rng, 200) for _ in range(20)]
    together = pr.runs_of_texts(texts)
    assert all((pr.runs_of_texts([t])[0] == g).all() for t, g in zip(texts, together))


# --- token alignment --------------------------------------------------------------------------------------------------

BITS = ["a", "the", "é", "日本", "\n", "\t", " ", "  ", "👍🏽", "𓀀", "x'll", "<|endoftext|>", "<0x41>", "\x00", "\u3000", "\xa0", "12", "...",
        "\u200b", "e\u0301", "\r\n", "\x85", "\x1c", "ﬁ", "Ａ", "\u2581", "\ue000"]


@pytest.fixture(scope="module")
def models():
    one = Tokenizer.from_file(A)
    one.encode_special_tokens = True
    two = SentencePieceProcessor(model_file=B)
    both = ta.Aligner(A, B)
    return one, two, both.a_bytes, both.b_bytes


def tokens_brute(models, text):
    """(ids, ends) of both over the whole text, or None."""
    one, two, a_bytes, b_bytes = models
    if not text:
        return None
    a, b = one.encode(" " + text, add_special_tokens=False).ids, two.encode(text)
    whole = (" " + text).encode()
    if b"".join(a_bytes[i] for i in a) != whole or b"".join(b_bytes[i] for i in b) != whole:
        return None
    return a, np.cumsum([len(a_bytes[i]) for i in a]).tolist(), b, np.cumsum([len(b_bytes[i]) for i in b]).tolist()


def alignment_brute(models, data):
    """Every row from its definition, token pair by token pair."""
    docs, count = [], {}
    for doc_id, text in data:
        found = tokens_brute(models, text)
        links, groups = [], []
        if found:
            a, a_ends, b, b_ends = found
            j = 0
            for i, end in enumerate(a_ends):
                begin = a_ends[i - 1] if i else 0
                while j and (b_ends[j - 1] > begin):
                    j -= 1
                while b_ends[j] <= begin:
                    j += 1
                while j < len(b) and (b_ends[j - 1] if j else 0) < end:
                    links.append((a[i], b[j]))
                    j += 1
                j = min(j, len(b) - 1)
            low = 0
            for c in sorted(set(a_ends) & set(b_ends)):
                groups.append("|".join(",".join(str(x) for x, e in zip(ids, ends) if low < e <= c) for ids, ends in ((a, a_ends), (b, b_ends))))
                low = c
        for pair in links:
            count[pair] = count.get(pair, 0) + 1
        docs.append((doc_id, found, links, groups))
    most = {}
    for (_, y), n in count.items():
        most[y] = max(n, most.get(y, 0))
    return [(i, len(f[0]) if f else 0, len(f[2]) if f else 0, len(g), len(k), sum(count[p] == most[p[1]] for p in k),
             sum(count[p] for p in k), sha(";".join(g)) if f else "") for i, f, k, g in docs]


def odd_texts(n, seed):
    r = random.Random(seed)
    out = []
    for k in range(n):
        bits = BITS if k % 3 else BITS[:-2]
        out.append("".join(r.choice(bits) + (" " if r.random() < 0.5 else "") for _ in range(r.randrange(30))))
    return out


@pytest.mark.parametrize("most", [ta.BROADCAST_PAIRS, 40, 0])
def test_alignment_query(spark, models, most):
    data = [(i, t if t is None or len(t) < 20_000 else t[:6_000]) for i, t in rows()] + [(200 + k, t) for k, t in enumerate(odd_texts(120, 4))]
    got = ta.compare(table(spark, data), A, B, broadcast_pairs=most)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(alignment_brute(models, data), key=key)


def test_segments_cut_where_tokens_do(models, monkeypatch):
    monkeypatch.setattr(ta, "CACHE_SEGMENTS", 50)
    both = ta.Aligner(A, B)
    assert both.local
    for text in odd_texts(600, 9):
        assert " ".join(ta.segments(text)) == text
        numbers = both.numbers([both.cut(text) if text else []])[0]
        found = tokens_brute(models, text)
        assert (len(numbers) and both.valid[numbers].all()) == (found is not None and found != ())
        if found:
            assert both.sizes[numbers].sum(axis=0).tolist()[:2] == [len(found[0]), len(found[2])]


def test_aligned_groups(spark, models):
    (row,) = ta.aligned(spark.createDataFrame([(1, "naïve 日本語 text")], "doc_id long, text string"), A, B).collect()
    one, two, a_bytes, b_bytes = models
    assert row.groups[-1].end == len(" naïve 日本語 text".encode())
    low = 0
    for g in row.groups:
        part = " naïve 日本語 text".encode()[low:g.end]
        assert b"".join(a_bytes[i] for i in g.a) == part == b"".join(b_bytes[i] for i in g.b)
        low = g.end


def test_alignment_empty_table(spark):
    out = ta.compare(empty(spark), A, B)
    assert out.count() == 0 and out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


# --- URL filter -------------------------------------------------------------------------------------------------------

URLS = [None, "", "x", "http://", "://", "HTTP://A.Com", "http://a.com/", "http://example.com/en/1", "http://www.example.com/en/", "ftp://x.www.EXAMPLE.com/en/q?x=/es/",
        "http://notexample.com/en/", "https://q.net/es/1", "https://q.net/es", "https://q.net/fr/#/es/", "https://q.net?/es/", "a://b://C.NET/es/", "http://com/x",
        "http://example.com:80/en/1", "http://ÄB.net/ES/", "http://a.net\n/es/1", "://#", "http://net/fr/\u00e9", "http://x.org/" + "long/" * 5000]


def url_brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))]
    best = None
    for r in queries.URL_RULES:
        h, p = r.address.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(r.address) > len(best.address)):
            best = r
    return host, path, best.address if best else None, best.action if best else None


@pytest.fixture(scope="module")
def url_model(spark):
    return uf.fit(uf.seed_labels(spark))


def test_url_rules(spark, url_model):
    data = [*enumerate(URLS), (None, URLS[7]), (3, URLS[11]), (3, URLS[11])]
    pages = spark.createDataFrame([(i, u, 1, "h", "p") for i, u in data], "page_id long, url string, features int, host string, path string")
    got = uf.judge(pages, queries.URL_RULES, url_model).collect()
    want = [(i, *url_brute(u)) for i, u in data]
    assert sorted([(r.page_id, r.host, r.path, r.rule) for r in got], key=key) == sorted([w[:4] for w in want], key=key)
    assert all(r.verdict in ("allow", "block") for r in got)
    by_rule = {w[:4]: w[4] for w in want}
    assert all(r.verdict == by_rule[r.page_id, r.host, r.path, r.rule] for r in got if r.rule)
    assert uf.judge(pages.limit(0), queries.URL_RULES, url_model).count() == 0


def test_url_model_equals_its_weights(spark, url_model):
    """The probability from the grams one by one: hashed, each bucket counted once, weighed and squashed."""
    from pyspark.ml.feature import HashingTF
    model = url_model.stages[-1]
    urls = ["http://m.free-bets.example.org/en/1", "https://library.example.net/de/2.html", "http://a", "nothing"]
    got = {r.page_id: r.blocked for r in uf.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), [], url_model).collect()}
    table_of = HashingTF(numFeatures=uf.FEATURES)
    for k, url in enumerate(urls):
        host, path = url_brute(url)[:2]
        grams = {m + t[i:i + n] for m, t in (("h", f"^{host}$"), ("p", f"^{path}$")) for n in uf.GRAM_SIZES for i in range(max(1, len(t) - n + 1))}
        z = model.intercept + sum(model.coefficients[j] for j in {table_of.indexOf(g) for g in grams})
        assert abs(got[k] - 1 / (1 + np.exp(-z))) < 1e-5


def test_url_model_held_out(spark):
    """Other addresses of sites it was fitted to, and sites none of whose addresses it saw."""
    labelled = uf.seed_labels(spark).coalesce(1).withColumn("page_id", F.monotonically_increasing_id()).cache()
    for fold, least in ((F.pmod("page_id", F.lit(4)), 0.95), (F.pmod(F.crc32("site"), F.lit(3)), 0.6)):
        held = labelled.withColumn("held", fold == 1)
        judged = uf.judge(held.where("held"), [], uf.fit(held.where("NOT held")))
        seen = judged.join(labelled.select("page_id", F.col("blocked").alias("want")), "page_id").collect()
        assert sum((r.verdict == "block") == (r.want == 1) for r in seen) / len(seen) > least
    with pytest.raises(ValueError):
        uf.fit(labelled.crossJoin(spark.range(30)))
