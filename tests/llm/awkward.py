"""A small table with nulls, empty and very long texts, ties, repeated rows and extra columns with clashing names."""

import hashlib
import random


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def rows():
    rng = random.Random(11)
    words = ["red", "Blue", "élan", "the", "of", "ñu", "x1", "don't", "a.b,", "##", " ", "日本"]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long, base = make(30_000), make(120)
    near = base.split()
    near[60] = "changed"
    texts = [None, "", " ", "a", "\n\t", base, base, " ".join(near), make(80), long, "1234 !!", make(5), "aa" * 300, "<|endoftext|> x"]
    out = [(i, t) for i, t in enumerate(texts)]
    out += [(5, base), (5, base), (None, base), (None, None), (3, "b"), (40, make(300) + base + base)]
    return out


def table(spark, data=None):
    """doc_id, text, and columns that carry names operators use for their own."""
    data = rows() if data is None else data
    return spark.createDataFrame([(i, t, "en" if (i or 0) % 2 else None, 7, "z", i) for i, t in data],
                                 "doc_id long, text string, lang string, id int, word string, part long").repartition(3)


def empty(spark):
    return table(spark).limit(0)


def key(r):
    return tuple((x is not None, str(x)) for x in r)
