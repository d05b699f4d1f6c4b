"""Token ids of whole texts by the tokenizers library, with every distinct word encoded once per worker.

A tokenizer that drops white space and never looks across it gives a text's ids as the ids of its words in a row, so
words are looked up in a bounded cache and only new ones go to the library.  Other tokenizers encode whole texts.
"""

from __future__ import annotations

import json
import os
import string
from collections.abc import Iterable

import numpy as np

#: Words kept by one generation of the cache; two generations are held.
CACHE_WORDS = 400_000
#: Unknown plain words given to the library as one text.
JOINED_WORDS = 2_000
#: Fixed value: the split pattern, known to match no white space, of the word tokenizer.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_encoders: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """The worker's encoder for a tokenizer file; it lives as long as the worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def splits_on_space(config: dict) -> bool:
    """Whether white space is dropped and never looked across."""
    def steps(x, many):
        return [] if not x else x[many] if x["type"] == "Sequence" else [x]
    pre, norm = steps(config["pre_tokenizer"], "pretokenizers"), steps(config["normalizer"], "normalizers")
    first = pre[0] if pre else {}
    return (first.get("type") == "Split" and first["pattern"].get("Regex") == WORD_PATTERN
            and first["behavior"] == "Removed" and first["invert"]
            and [x["type"] for x in norm] == ["NFC", "Replace", "Lowercase"]
            and not any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in config["added_tokens"]))


def plain(word: str) -> bool:
    """Letters of Latin-1 only.  Their composed and lower-cased forms are letters again, so such a word is one pre-token,
    and ASCII punctuation after it is another.  Elsewhere a normal form may end in a combining mark, which joins the punctuation."""
    return word.isalpha() and max(word) < "\u0100"


class Encoder:
    """``ids(text)`` gives little-endian unsigned ids of the width ``dtype``, without special tokens added."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.dtype = "<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4"
        suffix = config["model"].get("end_of_word_suffix")
        self.by_word = splits_on_space(config) and bool(suffix)
        self.ends_word = np.zeros(self.library.get_vocab_size(), bool)
        if self.by_word:
            self.ends_word[[i for token, i in config["model"]["vocab"].items() if token.endswith(suffix)]] = True
        self.new: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def library_ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.dtype).tobytes()
                for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def word_ids(self, words: list[str]) -> list[bytes]:
        """The ids of plain words: many are encoded as one text and told apart by the tokens that end a word."""
        out: list[bytes] = []
        for at in range(0, len(words), JOINED_WORDS):
            part = words[at:at + JOINED_WORDS]
            whole = np.frombuffer(self.library_ids([" ".join(part)])[0], self.dtype)
            ends = np.flatnonzero(self.ends_word[whole]) + 1
            if len(ends) == len(part):
                data, width = whole.tobytes(), whole.itemsize
                cuts = [0, *(ends * width).tolist()]
                out += [data[a:e] for a, e in zip(cuts, cuts[1:])]
            else:
                out += self.library_ids(part)
        return out

    def learn(self, words: Iterable[str]) -> None:
        """Put words into the cache.  A plain word with ASCII punctuation after it is the word, then the
        punctuation."""
        new, old = self.new, self.old
        missing, composed = set(), []
        for w in words:
            if w in new:
                continue
            if w in old:
                new[w] = old[w]
                continue
            stem = w.rstrip(string.punctuation)
            if len(stem) < len(w) and plain(stem):
                parts = stem, w[len(stem):]
                composed.append((w, *parts))
                missing.update(x for x in parts if x not in new)
            else:
                missing.add(w)
        letters, others = [], []
        for w in missing:
            if w in old:
                new[w] = old[w]
            else:
                (letters if plain(w) else others).append(w)
        new.update(zip(letters, self.word_ids(letters)))
        new.update(zip(others, self.library_ids(others)))
        for w, stem, tail in composed:
            new[w] = new[stem] + new[tail]

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of every text."""
        if not self.by_word:
            return self.library_ids(texts)
        if len(self.new) > CACHE_WORDS:
            self.old, self.new = self.new, {"": b""}
        rows = [self._words(t) for t in texts]
        self.learn(set().union(*rows) if rows else ())
        get = self.new.__getitem__
        return [b"".join(map(get, row)) for row in rows]

    @staticmethod
    def _words(text: str) -> list[str]:
        """Split at plain spaces and line ends only; other white space is left to the library.  Texts within Latin-1
        are lower-cased first, where case and composition are settled letter by letter; not where a special token's
        spelling could come about by it."""
        try:
            text.encode("latin-1")
            low = text.lower()
            if "<|" not in low:
                text = low
        except UnicodeEncodeError:
            pass
        return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
