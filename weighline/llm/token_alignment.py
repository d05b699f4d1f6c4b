"""Operator 12: alignment of two tokenizers' tokens over the same bytes.

A is a byte-level BPE of the tokenizers library, B a sentencepiece model with byte fallback that puts a space before the
text; so both spell the bytes of a space and the text.  A's character offsets and the spans of B's proto are the coarse
cuts: a token ends where its span ends.  Where tokens share a character, or B spells one byte by byte, spans say only which
character it is, and the bytes that the tokens decode to place the ends inside it.  Offsets where tokens of both end cut
the text into groups, and every stretch between neighbouring ends of either is one link, the pair of tokens over it.

Segments.  Neither tokenizer has a token that goes on after a letter across a plain space into the next word: A's
pre-tokens start at the space, and no piece of B has a space after another character (checked on its vocabulary; a model
that does gets whole texts).  So a text is cut at single spaces between two characters that are not white space, and a
segment's tokens, groups and links are worked out once while a worker keeps it; it keeps a bounded number, frequent ones
longest.  A word with ASCII punctuation after an ASCII letter is put together from the word and the punctuation where no
piece of B has that letter and mark side by side: A's pre-tokens part there as well.

Counts.  Texts are encoded in one pass, which writes each document's figures and its distinct linked pairs.  Counts are a
sum over those with map-side combination; the best of a B id is a second sum over its pairs.  To add a document's counts
up, its pairs are joined with the counts: with as many of the most frequent as a broadcast may hold (``BROADCAST_PAIRS``,
counted first), by a shuffle with all others; a pair in the shuffle is rare, so none is hot.

Defined results.  Null and empty texts, and texts whose tokens do not spell the space and the text (such as one that holds
U+2581), have no tokens: zeros and an empty ``groups_sha256``.  Repeated rows count each time; ties for the highest count all
count as best.  An empty table gives no rows.  Only the two named columns are read.
"""

from __future__ import annotations

import os
import re
import string
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weighline.llm import common as C
from weighline.llm.bpe import byte_letters

#: Segments that a worker keeps; when there are more, up to half stay.
CACHE_SEGMENTS = 300_000
#: Segments encoded as one text.
JOINED = 100
#: Counts of at most so many pairs are broadcast (16 bytes each).
BROADCAST_PAIRS = 1_000_000

_LINK = pa.struct([("pair", pa.int64()), ("links", pa.int32())])
_FIGURES = ["n_a", "n_b", "n_groups", "n_links"]
_ROW = pa.schema([("doc_id", pa.int64()), *[(n, pa.int64()) for n in _FIGURES], ("groups_sha256", pa.string()), ("pairs", pa.list_(_LINK))])
ROW_SCHEMA = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "pairs array<struct<pair: long, links: int>>")
_TOKENS = pa.list_(pa.int32())
_GROUPS = pa.schema([("doc_id", pa.int64()), ("groups", pa.list_(pa.struct([("end", pa.int64()), ("a", _TOKENS), ("b", _TOKENS)])))])

_GAPS = re.compile(r"\s{2,}|\s\Z")
_CUT = re.compile(r"(?<=\S) (?=\S)")
_HOLD = "\ue000"
#: Marks the name of punctuation that follows a letter; no text holds it.
_AFTER = "\udc00"

_aligners: dict[tuple[str, str], "Aligner"] = {}


def aligner(a_path: str, b_path: str) -> "Aligner":
    """The worker's aligner for two tokenizer files."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def segments(text: str) -> list[str]:
    """The text cut at single spaces between two characters that are not white space."""
    words = text.split()
    if " ".join(words) == text:
        return words
    if _HOLD in text:
        return _CUT.split(text)
    held = _GAPS.sub(lambda m: m.group().replace(" ", _HOLD), text)
    if held[0] == " ":
        held = _HOLD + held[1:]
    return [s.replace(_HOLD, " ") for s in held.split(" ")]


def ends_of(begin: np.ndarray, end: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Byte offset of the end of every token from its span and the length of its bytes.

    A span's end holds where the token shares no character with the next one and is not part of one spelt byte by byte;
    there the bytes decoded so far give the end.
    """
    clean = end > begin
    clean[:-1] &= begin[1:] >= end[:-1]
    clean[1:] &= clean[:-1] | (begin[1:] > begin[:-1])
    return np.where(clean, end, np.cumsum(lengths))


def byte_places(text: str) -> np.ndarray:
    """The byte offset of every character, and of the end."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
    return np.concatenate(([0], np.cumsum(width)))


class Aligner:
    """Tokens, groups and links of segments by number; see :meth:`numbers`."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        special = {i: t.content.encode() for i, t in self.a.get_added_tokens_decoder().items()}
        size = 1 + max(self.a.get_vocab(with_added_tokens=True).values())
        self.a_bytes = [b""] * size
        for token, i in self.a.get_vocab(with_added_tokens=False).items():
            self.a_bytes[i] = special[i] if i in special else bytes(letters[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_length, self.b_length = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.local = not any("▁" in p.lstrip("▁") for p in pieces)
        self.together = {x + y for p in pieces for x, y in zip(p, p[1:])}  # characters that some piece of B has side by side
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.valid = np.empty(0, bool)
        self.met = np.empty(0, np.int64)  # how often a segment was asked for
        self.text: list[str] = []  # its groups as text
        self.sizes = np.empty((0, 3), np.int64)  # tokens of A, of B, groups
        self.pairs = np.empty(0, np.int64)  # linked ids of all segments, A's in the upper half
        self.bounds = np.zeros(1, np.int64)  # where a segment's links start

    def links(self, numbers: np.ndarray) -> np.ndarray:
        """The linked pairs of these segments, one after the other."""
        low = self.bounds[numbers]
        size = self.bounds[numbers + 1] - low
        return self.pairs[np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())]

    def forget(self) -> None:
        """Keep the segments that were asked for repeatedly, the most frequent ones if they are many."""
        often = np.flatnonzero(self.met > 1)
        often = np.sort(often[np.argsort(-self.met[often], kind="stable")[:CACHE_SEGMENTS // 2]])
        pairs, size = self.links(often), np.diff(self.bounds)[often]
        names = list(self.number)
        self.number = {names[k]: i for i, k in enumerate(often.tolist())}
        self.text = [self.text[k] for k in often.tolist()]
        self.valid, self.sizes, self.pairs = self.valid[often], self.sizes[often], pairs
        self.met = self.met[often] // 2
        self.bounds = np.concatenate(([0], np.cumsum(size)))

    def cut(self, text: str) -> list[str]:
        return segments(text) if self.local else [text]

    def numbers(self, rows: list[list[str]]) -> list[np.ndarray]:
        """The numbers of every row's segments, good until the next call; new segments are worked out."""
        if len(self.number) > CACHE_SEGMENTS:
            self.forget()
        plain, apart, tails, composed = [], [], {}, []
        new = [s for s in dict.fromkeys(chain.from_iterable(rows)) if s not in self.number]
        if self.local:
            wanted = {}
            for s in new:
                stem = s.rstrip(string.punctuation)
                letter = stem[-1:]
                if len(stem) < len(s) and letter.isascii() and letter.isalpha() and not stem[0].isspace() and letter + s[len(stem)] not in self.together:
                    tail = s[len(stem):]
                    composed.append((s, stem, _AFTER + tail))
                    wanted[stem] = None
                    if _AFTER + tail not in self.number:
                        tails[tail] = letter  # any such letter will do
                elif s and not s[0].isspace() and not s[-1].isspace():
                    wanted[s] = None
                else:
                    apart.append(s)
            plain = [s for s in wanted if s not in self.number]
        else:
            apart = new
        parts = [x for k in range(0, len(plain), JOINED) for x in self.work_out(plain[k:k + JOINED])]
        parts += [x for s in apart for x in self.work_out([s])]
        parts += [x for tail, letter in tails.items() for x in self.work_out([tail], letter)]
        self._add(parts)
        if composed:
            self._add([self.put_together(*map(list, zip(*composed)))])
        get = self.number.__getitem__
        found = [np.fromiter(map(get, row), np.int64, len(row)) for row in rows]
        self.met += np.bincount(np.concatenate((*found, np.empty(0, np.int64))), minlength=len(self.met))
        return found

    def _add(self, parts: list[tuple[np.ndarray, ...]]) -> None:
        if parts:
            sizes, wide, links, valid = map(list, zip(*parts))
            self.sizes, self.pairs = np.concatenate((self.sizes, *sizes)), np.concatenate((self.pairs, *wide))
            self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(np.concatenate(links))))
            self.valid = np.concatenate((self.valid, *valid))
            self.met = np.concatenate((self.met, np.zeros(len(self.number) - len(self.met), np.int64)))

    def put_together(self, words: list[str], stems: list[str], tails: list[str]) -> tuple[np.ndarray, ...]:
        """Number words whose two parts are known."""
        get = self.number.__getitem__
        stem, tail = (np.fromiter(map(get, x), np.int64, len(x)) for x in (stems, tails))
        self.met += np.bincount(np.concatenate((stem, tail, tail)), minlength=len(self.met))
        both = np.stack((stem, tail), axis=1).ravel()
        valid = self.valid[stem] & self.valid[tail]
        first = len(self.number)
        self.number.update(zip(words, range(first, first + len(words))))
        self.text += [f"{self.text[i]};{self.text[j]}" for i, j in zip(stem.tolist(), tail.tolist())]
        return self.sizes[stem] + self.sizes[tail], self.links(both), np.diff(self.bounds)[both].reshape(-1, 2).sum(axis=1), valid

    def tokens(self, text: str) -> tuple[list[int], np.ndarray, list[int], np.ndarray] | None:
        """Ids and byte ends of both, over a space and the text; None where either does not spell those bytes."""
        whole = " " + text
        data = whole.encode()
        one = self.a.encode(whole, add_special_tokens=False)
        proto = self.b.encode(text, return_type="proto").pieces
        a, proto = one.ids, np.array([x for p in proto for x in (p.id, p.begin, p.end)], np.int64).reshape(-1, 3)
        b = proto[:, 0].tolist()
        if b"".join(map(self.a_bytes.__getitem__, a)) != data or b"".join(map(self.b_bytes.__getitem__, b)) != data:
            return None
        spans = np.fromiter(chain.from_iterable(one.offsets), np.int64, 2 * len(a))
        if len(data) != len(whole):
            spans = byte_places(whole)[spans]
        a_ends = ends_of(spans[::2], spans[1::2], self.a_length[a])
        # B's spans count the text's bytes; the space before the text belongs to its first piece
        begin, end = proto[:, 1] + 1, proto[:, 2] + 1
        begin[:1] = 0
        return a, a_ends, b, ends_of(begin, end, self.b_length[b])

    def work_out(self, some: list[str], stem: str = "") -> list[tuple[np.ndarray, ...]]:
        """Number these segments, encoded as one text: sizes, linked pairs, links of each, whether they have tokens.

        With a ``stem`` there is one, the punctuation that follows that letter; the letter's tokens are left out.
        """
        found = self.tokens(stem + " ".join(some))
        if found is None and len(some) > 1:
            return [x for s in some for x in self.work_out([s])]
        first = len(self.number)
        self.number.update(zip([_AFTER + s for s in some] if stem else some, range(first, first + len(some))))
        if found is None:
            self.text.append("")
            return [(np.zeros((1, 3), np.int64), np.empty(0, np.int64), np.zeros(1, np.int64), np.zeros(1, bool))]
        a, a_ends, b, b_ends = found
        stops = np.cumsum([1 + len(s) if s.isascii() else 1 + len(s.encode()) for s in some])
        if stem:
            skip = 1 + len(stem.encode())
            i, j = np.searchsorted(a_ends, skip) + 1, np.searchsorted(b_ends, skip) + 1
            a, a_ends, b, b_ends, stops = a[i:], a_ends[i:] - skip, b[j:], b_ends[j:] - skip, stops - 1
        links = np.union1d(a_ends, b_ends)
        of_a, of_b = np.searchsorted(a_ends, links), np.searchsorted(b_ends, links)
        both = (a_ends[of_a] == links) & (b_ends[of_b] == links)
        wide = np.array(a, np.int64)[of_a] << 32 | np.array(b, np.int64)[of_b]
        upto = lambda ends: np.diff(np.searchsorted(ends, stops, side="right"), prepend=0)
        sizes = np.stack((upto(a_ends), upto(b_ends), upto(links[both])), axis=1)
        a_text, b_text = list(map(str, a)), list(map(str, b))
        i = j = k = 0
        shown = []
        for x, y in zip((of_a[both] + 1).tolist(), (of_b[both] + 1).tolist()):
            shown.append(f"{a_text[i]}|{b_text[j]}" if x == i + 1 and y == j + 1 else f"{','.join(a_text[i:x])}|{','.join(b_text[j:y])}")
            i, j = x, y
        for n in sizes[:, 2].tolist():
            self.text.append(";".join(shown[k:k + n]))
            k += n
        return [(sizes, wide, upto(links), np.ones(len(some), bool))]


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), C.text_of(text_col).alias("text"))


def _rows(batches: Iterable[pa.RecordBatch], both: Aligner) -> Iterator[tuple[list, list[np.ndarray | None]]]:
    """Ids and segment numbers, 100 documents at a time; None for a text without tokens."""
    for whole in batches:
        for k in range(0, whole.num_rows, 100):
            b = whole.slice(k, 100)
            numbers = both.numbers([both.cut(t) if t else [] for t in b.column(1).to_pylist()])
            yield b.column(0).to_pylist(), [n if len(n) and both.valid[n].all() else None for n in numbers]


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The groups of every document in order: byte offset of the end in a space and the text, ids of A, ids of B."""
    def work(batches):
        both = aligner(a_path, b_path)
        split = lambda ids: list(map(int, ids.split(",")))
        for ids, rows in _rows(batches, both):
            out = []
            for numbers in rows:
                groups, end = [], 0
                for part in () if numbers is None else ";".join([both.text[k] for k in numbers.tolist()]).split(";"):
                    a, b = map(split, part.split("|"))
                    end += int(both.a_length[a].sum())
                    groups.append({"end": end, "a": a, "b": b})
                out.append(groups)
            yield C.batch(_GROUPS, doc_id=ids, groups=out)

    return C.map_arrow(_read(docs, id_col, text_col), work, "doc_id long, groups array<struct<end: long, a: array<int>, b: array<int>>>")


def linked(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its figures, the checksum of its groups, and its distinct linked pairs with their links."""
    def work(batches):
        both = aligner(a_path, b_path)
        for ids, rows in _rows(batches, both):
            figures, names, pairs, links, sizes = [], [], [], [], [0]
            for numbers in rows:
                if numbers is None:
                    figures.append((0, 0, 0, 0))
                    names.append("")
                    sizes.append(0)
                    continue
                n_a, n_b, groups = both.sizes[numbers].sum(axis=0).tolist()
                figures.append((n_a, n_b, groups, n_a + n_b - groups))
                names.append(C.sha(";".join(map(both.text.__getitem__, numbers.tolist())).encode()))
                all_pairs = np.sort(both.links(numbers))
                edge = np.flatnonzero(np.concatenate(([True], all_pairs[1:] != all_pairs[:-1])))
                pairs.append(all_pairs[edge])
                links.append(np.diff(edge, append=len(all_pairs)))
                sizes.append(len(edge))
            flat = [pa.array(np.concatenate((*x, np.empty(0, np.int64))), type=t) for x, t in ((pairs, pa.int64()), (links, pa.int32()))]
            lists = pa.ListArray.from_arrays(np.cumsum(sizes).astype(np.int32), pa.StructArray.from_arrays(flat, ["pair", "links"]))
            yield C.batch(_ROW, doc_id=ids, **dict(zip(_FIGURES, zip(*figures))), groups_sha256=names, pairs=lists)

    rows = C.map_arrow(_read(docs, id_col, text_col), work, ROW_SCHEMA)
    return C.table(rows.withColumn("row", F.monotonically_increasing_id()), "linked")  # row numbers are fixed by being written


def pair_counts(rows: DataFrame) -> DataFrame:
    """Of :func:`linked`: every pair's links over all documents, ``n``, and whether that is the highest of its B id."""
    each = rows.select(F.explode("pairs").alias("p")).groupBy("p.pair").agg(F.sum("p.links").alias("n"))
    sums = C.table(each.withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)), "pair-sums")
    most = sums.groupBy("b").agg(F.max("n").alias("most"))  # one row per id of B's vocabulary
    return C.table(sums.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")


def frequent_from(counts: DataFrame, limit: int) -> int | None:
    """A count that at most ``limit`` pairs reach; None if all pairs are no more than that.

    The number of pairs by the size of their count (powers of two) is a handful of rows.
    """
    by_size = {r["k"]: r["pairs"] for r in counts.groupBy(F.length(F.bin("n")).alias("k")).agg(F.count("*").alias("pairs")).collect()}
    if sum(by_size.values()) <= limit:
        return None
    held, least = 0, max(by_size) + 1
    for k in sorted(by_size, reverse=True):
        held += by_size[k]
        if held > limit:
            break
        least = k
    return 1 << (least - 1)


def compare(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Per document: tokens of both, groups, links, links whose count is the highest of their B id, sum of counts."""
    rows = linked(docs, a_path, b_path, id_col, text_col)
    counts = pair_counts(rows)
    least = frequent_from(counts, broadcast_pairs)
    links = rows.select("row", F.explode("pairs").alias("p")).select("row", "p.pair", "p.links")

    def worth(df: DataFrame) -> DataFrame:
        return (df.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
                                      F.sum(F.col("links") * F.col("n")).alias("count_sum")))

    if least is None:
        sums = worth(links.join(F.broadcast(counts), "pair"))
    else:
        frequent = counts.where(F.col("n") >= least)
        marked = links.join(F.broadcast(frequent), "pair", "left")
        rare = marked.where("n IS NULL").select("row", "pair", "links").join(counts.where(F.col("n") < least), "pair")
        sums = worth(marked.where("n IS NOT NULL").unionByName(rare.select(*marked.columns)))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return (rows.drop("pairs").join(sums, "row", "left")
            .select("doc_id", *_FIGURES, zero("n_best"), zero("count_sum"), "groups_sha256"))
