"""Operator 4: language identification by prediction by partial matching.

For every language a variable-order context tree over bytes (contexts of up to three bytes) is learned from a bounded
sample of labelled documents and then frozen.  A byte's probability is its share in the longest context that was seen;
a byte new to a context costs the context's escape probability and is looked up one byte shorter, down to a uniform
choice of 256.  A text's code length in a language is the sum over all its bytes, exactly; the shortest wins, and the
score is the posterior probability of the winner under equal priors.

Trees are merged into shared arrays (a node per context seen in any language, a cost per language), at most a few MB
whatever the corpus, sent to every task.  Texts are scored whole where they are read: no shuffle.

Defined results.  ``und`` with score 0 for a null text, a text without a letter, and where no language could be
learned.  Ties go to the first language in alphabetical order.  Of more than ``MAX_LANGUAGES`` label values, those with the
most documents (then in alphabetical order) are learned.  A null doc_id or a null lang is not learned from; a
null doc_id is not held out.  Repeated rows give repeated results; an empty table gives no rows.  Only the named
columns are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from weighline.llm import common as C

UNKNOWN = "und"
#: Documents learned from per language (those of the smallest hash); characters learned from a document, at a place chosen
#: by its id where it is longer; and characters in all, which many languages share.
SAMPLE_DOCUMENTS, SAMPLE_CHARS, SAMPLE_TOTAL = 250, 20_000, 40_000_000
#: Languages told apart: those with the most labelled documents.
MAX_LANGUAGES = 200
LETTER = re.compile(r"[^\W\d_]")
#: Bytes scored at a time, so that a very long text needs little memory.
CHUNK = 1 << 20

_OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])
#: Columns added to kept ones; names that no input is expected to have.
FOUND = ("__lang_pred", "__lang_score")
OUT_SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def held_out(id_col: str, folds: int = 4, fold: int = 2) -> Column:
    """Whether the fold of a document, by the checksum of its id as text, is the one not learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def grams(data: np.ndarray, n: int) -> np.ndarray:
    """The n-byte strings that end at each place, as numbers; the text is preceded by zero bytes."""
    out = data.astype(np.int64)
    for j in range(1, n):
        out[j:] += data[:-j].astype(np.int64) << (8 * j)
    return out


@dataclass
class Model:
    """Frozen statistics.  ``three``/``four``: sorted byte strings seen in any language.  Costs in bits, a column per
    language: ``cost3[i]`` of the last byte of ``three[i]``, ``cost4[i]`` likewise; ``escape3[i]`` of leaving the
    context ``three[i]``; ``cost2``/``escape2``: of all pairs of bytes."""

    languages: list[str]
    three: np.ndarray = None
    four_child: np.ndarray = None
    cost2: np.ndarray = None
    escape2: np.ndarray = None
    cost3: np.ndarray = None
    escape3: np.ndarray = None
    four: np.ndarray = None
    cost4: np.ndarray = None
    _index: dict = field(default_factory=dict)

    def prepare(self) -> None:
        """Tables for direct look-up, made once per worker."""
        index3 = np.full(1 << 24, -1, np.int32)
        index3[self.three] = np.arange(len(self.three), dtype=np.int32)
        byte = np.zeros(256, np.int64)
        used = np.unique(self.four & 255)
        byte[used] = np.arange(1, len(used) + 1)
        width = len(used) + 1
        child = np.full(len(self.three) * width, -1, np.int32)
        child[index3[self.four >> 8].astype(np.int64) * width + byte[self.four & 255]] = np.arange(len(self.four), dtype=np.int32)
        self._index = {"three": index3, "byte": byte, "width": width, "child": child}

    def bits(self, data: bytes) -> np.ndarray:
        """Code length of the data in every language."""
        total = np.zeros(len(self.languages))
        for start in range(0, len(data), CHUNK):
            before = data[max(0, start - 3):start].rjust(3, b"\0")
            x = np.frombuffer(before + data[start:start + CHUNK], np.uint8)
            total += self._chunk(x)
        return total

    def _chunk(self, x: np.ndarray) -> np.ndarray:
        ix = self._index
        code = grams(x, 3)
        last, node = x[3:].astype(np.int64), ix["three"][code[2:-1]].astype(np.int64)
        child = np.where(node >= 0, ix["child"][node * ix["width"] + ix["byte"][last]], -1)
        seen = child >= 0
        total = self.cost4[child[seen]].sum(axis=0, dtype=np.float64)
        missed = ~seen
        left = node[missed]
        total += self.escape3[left[left >= 0]].sum(axis=0, dtype=np.float64)
        row = ix["three"][code[3:][missed]].astype(np.int64)
        total += self.cost3[row[row >= 0]].sum(axis=0, dtype=np.float64)
        pair = code[3:][missed][row < 0]
        total += self.escape2[pair >> 8].sum(axis=0, dtype=np.float64)
        return total + self.cost2[pair & 0xFFFF].sum(axis=0, dtype=np.float64)


def learn(texts: dict[str, list[bytes]]) -> Model:
    """Count contexts per language and freeze every cost.  A byte seen n times in a context of t bytes, d of them
    different, has probability n / (t + d); leaving the context has d / (t + d); an unseen context is left for free."""
    languages = sorted(texts)
    model = Model(languages)
    if not languages:
        return model
    counts: list[list[tuple[np.ndarray, np.ndarray]]] = []
    for lang in languages:
        parts = [np.frombuffer(b"\0\0\0" + t, np.uint8) for t in texts[lang]]
        counts.append([np.unique(np.concatenate([grams(p, n)[3:] for p in parts] or [np.zeros(0, np.int64)]), return_counts=True)
                       for n in (1, 2, 3, 4)])
    model.three = np.unique(np.concatenate([np.concatenate((c[2][0], c[3][0] >> 8)) for c in counts]))
    model.four = np.unique(np.concatenate([c[3][0] for c in counts]))
    shape = len(languages)
    model.cost2, model.escape2 = np.zeros((1 << 16, shape), np.float32), np.zeros((1 << 16, shape), np.float32)
    model.cost3 = np.zeros((len(model.three), shape), np.float32)
    model.escape3 = np.zeros((len(model.three), shape), np.float32)
    model.cost4 = np.zeros((len(model.four), shape), np.float32)

    def order(keys: np.ndarray, n: np.ndarray, universe: np.ndarray, contexts: np.ndarray, shorter: np.ndarray):
        """(cost of every key of ``universe``, escape of every context of ``contexts``); ``shorter``: costs one byte shorter."""
        context, first = np.unique(keys >> 8, return_index=True)
        total, kinds = np.add.reduceat(n, first) if len(n) else n, np.diff(np.append(first, len(keys)))
        escape = np.zeros(len(contexts))
        at = np.searchsorted(contexts, context)
        escape[at] = -np.log2(kinds / (total + kinds)) if len(n) else 0
        known = np.zeros(len(contexts))
        known[at] = total + kinds
        of = np.searchsorted(contexts, universe >> 8)
        cost = shorter + escape[of]
        where = np.searchsorted(universe, keys)
        cost[where] = -np.log2(n / known[of[where]])
        return cost, escape

    for k in range(shape):
        one, two, three, four = counts[k]
        bytes_, pairs = np.arange(256), np.arange(1 << 16)
        cost1, _ = order(*one, bytes_, np.zeros(1, np.int64), np.full(256, 8.0))
        cost2, _ = order(*two, pairs, bytes_, cost1[pairs & 255])
        cost3, escape2 = order(*three, model.three, pairs, cost2[model.three & 0xFFFF])
        at3 = np.searchsorted(model.three, model.four & 0xFFFFFF)
        known3 = np.zeros(len(model.four))
        inside = (at3 < len(model.three)) & (model.three[np.minimum(at3, len(model.three) - 1)] == model.four & 0xFFFFFF)
        known3[inside] = cost3[at3[inside]]
        cost4, escape3 = order(*four, model.four, model.three, known3)
        model.cost2[:, k], model.escape2[:, k], model.cost3[:, k] = cost2, escape2, cost3
        model.escape3[:, k], model.cost4[:, k] = escape3, cost4
    return model


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> dict[str, list[bytes]]:
    """Texts to learn from: per language about ``SAMPLE_DOCUMENTS`` labelled documents with the smallest hash, of any length."""
    h = F.xxhash64(F.col(id_col))
    labelled = docs.select(F.col(text_col).alias("t"), F.col(lang_col).alias("lang"), h.alias("h")
                           ).where(F.col(id_col).isNotNull() & ~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()
    if not counts:
        return {}
    # a hash below share * 2^64 keeps about SAMPLE_DOCUMENTS of a language
    near = F.lit(False)
    for r in counts:
        share = min(1.0, SAMPLE_DOCUMENTS / r["n"])
        near |= (F.col("lang") == r["lang"]) & (F.col("h") <= min((1 << 63) - 1, int(-(1 << 63) + share * (1 << 64))))
    chars = min(SAMPLE_CHARS, SAMPLE_TOTAL // (SAMPLE_DOCUMENTS * len(counts)))
    start = F.pmod(F.xxhash64("h"), F.greatest(F.length("t") - chars, F.lit(0)) + 1) + 1
    part = F.substring(F.col("t"), start.cast("int"), F.lit(chars))
    out: dict[str, list[bytes]] = {}
    most = 2 * SAMPLE_DOCUMENTS * len(counts)  # the bound itself, should one doc_id be repeated without end
    for r in labelled.where(near).select("lang", "h", part.alias("t")).orderBy("h", "t").limit(most).collect():
        out.setdefault(r["lang"], []).append(r["t"].encode())
    return out


def predict(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None,
            model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; with ``keep``, these columns of the input, followed by
    ``__lang_pred`` and ``__lang_score``."""
    model = model or learn(sample(docs, id_col, text_col, lang_col))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def one(text: str | None) -> tuple[str, float]:
        m = shared.value
        if text is None or not m.languages or not LETTER.search(text):
            return UNKNOWN, 0.0
        bits = m.bits(text.encode())
        best = int(np.argmin(bits))
        return m.languages[best], float(1.0 / np.exp2(np.maximum(bits[best] - bits, -1000.0)).sum())

    if keep is None:
        source = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
        schema, names, last = OUT_SCHEMA, ["doc_id", "held_out"], ("lang_pred", "score")
    else:
        source = docs.select(*keep)
        schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields), *(f"{n} {t}" for n, t in zip(FOUND, ("string", "double")))])
        names, last = keep, FOUND
    place = source.columns.index("text" if keep is None else text_col)

    def run(batches):
        if shared.value.languages and not shared.value._index:
            shared.value.prepare()
        for b in batches:
            found = [one(t) for t in b.column(place).to_pylist()]
            columns = [b.column(b.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                                             names=[*names, *last])

    return C.map_arrow(source, run, schema)


def keep_known(docs: DataFrame, least_score: float = 0.5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows whose language could be told: not ``und``, and the winner at least as likely as ``least_score``."""
    found = predict(docs, id_col, text_col, lang_col, keep=docs.columns)
    return found.where((F.col(FOUND[0]) != UNKNOWN) & (F.col(FOUND[1]) >= least_score)).select(*docs.columns)
