"""Operator 9: byte-level BPE encoding and decoding with a pair occurrence index.

Texts are cut into pre-tokens; the distinct new ones of a task's batch are merged together.  The index maps each
adjacent pair to all its positions in the batch.  The ranks that are present are taken in ascending order; merging a
pair at its positions removes its neighbours' old pairs and adds the new ones to their lists.  Merged pre-tokens stay
in a bounded cache of the worker, so a frequent one is merged once.

Texts are encoded whole where they are read: no shuffle, and no state that grows with the corpus.

Defined results.  Null text is empty and gives no ids.  A special token's spelling in a text becomes its id, as in the
library, and is decoded to its spelling.  Ties between equal pairs go to the leftmost.  Repeated rows give repeated
results; an empty table gives no rows.  Only the two named columns are read.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from weighline.llm import common as C

#: Pre-tokens kept by one generation of the cache; two generations are held.
CACHE_TOKENS = 300_000
#: Fixed value: the pre-token pattern of byte-level BPE.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
OUT_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

_coders: dict[str, "Coder"] = {}


def coder(path: str) -> "Coder":
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary: itself where printable, else the next free
    letter from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def merge_batch(words: list[bytes], ranks: dict[tuple[int, int], tuple[int, int]], byte_ids: list[int]) -> list[list[int]]:
    """The ids of every word.  ``ranks``: pair of ids to (rank, merged id).

    All words lie in one array of symbols with links to the live neighbours; -1 ends a word.
    """
    symbols: list[int] = []
    for w in words:
        symbols += [byte_ids[b] for b in w]
        symbols.append(-1)
    size = len(symbols)
    left, right = list(range(-1, size - 1)), list(range(1, size + 1))
    where: dict[tuple[int, int], list[int]] = {}
    for i in range(size - 1):
        pair = (symbols[i], symbols[i + 1])
        if pair in ranks:
            where.setdefault(pair, []).append(i)
    active = [(ranks[p][0], p) for p in where]
    heapq.heapify(active)
    while active:
        _, pair = heapq.heappop(active)
        a, b = pair
        merged = ranks[pair][1]
        fresh: set[tuple[int, int]] = set()
        for i in sorted(where.pop(pair)):
            if symbols[i] != a:
                continue
            j = right[i]
            if j >= size or symbols[j] != b:
                continue
            symbols[i], symbols[j] = merged, -2  # -2: no longer a symbol; its links are not used again
            k = right[i] = right[j]
            if k < size:
                left[k] = i
                after = (merged, symbols[k])
                if after in ranks:
                    where.setdefault(after, []).append(i)
                    fresh.add(after)
            h = left[i]
            if h >= 0:
                before = (symbols[h], merged)
                if before in ranks:
                    where.setdefault(before, []).append(h)
                    fresh.add(before)
        for p in fresh:
            heapq.heappush(active, (ranks[p][0], p))
        while active and active[0][1] not in where:
            heapq.heappop(active)
    out, ids = [], []
    for s in symbols:
        if s >= 0:
            ids.append(s)
        elif s == -1:
            out.append(ids)
            ids = []
    return out


class Coder:
    """Encodes and decodes with the vocabulary, merges and special tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        vocab, letters = config["model"]["vocab"], byte_letters()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in config["model"]["merges"]]
        self.ranks = {(vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in reversed(list(enumerate(merges)))}
        self.byte_ids = [0] * 256
        for letter, b in letters.items():
            self.byte_ids[b] = vocab[letter]
        special = {a["content"]: a["id"] for a in config["added_tokens"]}
        self.special = special
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.pieces: list[bytes] = [b""] * (max([*vocab.values(), *special.values()]) + 1)
        for token, i in vocab.items():
            self.pieces[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        for token, i in special.items():
            self.pieces[i] = token.encode()
        self.new: dict[str, tuple[str, bytes]] = {}
        self.old: dict[str, tuple[str, bytes]] = {}

    def pre_tokens(self, text: str) -> list[str]:
        """Pre-tokens of the text; a special token's spelling is one of its own."""
        if self.cut is None or not any(s in text for s in self.special):
            return PATTERN.findall(text)
        out = []
        for part in self.cut.split(text):
            out += [part] if part in self.special else PATTERN.findall(part)
        return out

    def learn(self, words: Iterable[str]) -> None:
        unknown = []
        for w in words:
            if w in self.new:
                continue
            if w in self.old:
                self.new[w] = self.old[w]
            elif w in self.special:
                self.new[w] = str(self.special[w]), np.array([self.special[w]], "<u4").tobytes()
            else:
                unknown.append(w)
        for w, ids in zip(unknown, merge_batch([w.encode() for w in unknown], self.ranks, self.byte_ids)):
            self.new[w] = ",".join(map(str, ids)), np.array(ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[tuple[str, np.ndarray]]:
        """Of every text: its ids as decimals joined by commas, and as an array."""
        if len(self.new) > CACHE_TOKENS:
            self.old, self.new = self.new, {}
        rows = [self.pre_tokens(t) for t in texts]
        self.learn(set().union(*rows) if rows else ())
        out = []
        for row in rows:
            found = list(map(self.new.__getitem__, row))
            out.append((",".join([f[0] for f in found]), np.frombuffer(b"".join([f[1] for f in found]), "<u4")))
        return out

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.pieces.__getitem__, ids.tolist())).decode("utf-8", "replace")


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))])

    def run(batches):
        c = coder(tokenizer)
        for b in batches:
            yield C.batch(schema, doc_id=b.column(0), ids=[i for _, i in c.encode(b.column(1).to_pylist())])

    return C.map_arrow(docs.select(F.col(id_col).cast("long"), C.text_of(text_col)), run, "doc_id long, ids array<long>")


def decode(ids: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and text of every row of ids."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        c = coder(tokenizer)
        for b in batches:
            yield C.batch(schema, doc_id=b.column(0), text=[c.decode(np.array(i, np.int64)) for i in b.column(1).to_pylist()])

    return C.map_arrow(ids.select("doc_id", "ids"), run, "doc_id long, text string")


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode what was encoded, and return the digests of both for every document."""
    def run(batches):
        c = coder(tokenizer)
        for b in batches:
            rows = [(len(ids), C.sha(listed.encode()), C.sha(c.decode(ids).encode())) for listed, ids in c.encode(b.column(1).to_pylist())]
            if rows:
                yield C.batch(_OUT, doc_id=b.column(0), **dict(zip(_OUT.names[1:], zip(*rows))))

    return C.map_arrow(docs.select(F.col(id_col).cast("long"), C.text_of(text_col)), run, OUT_SCHEMA)
