"""Token files, packing and BPE against the tokenizers library."""

import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from awkward import empty, key, rows, sha, table
from tokenizers import Tokenizer

from weighline.llm import bpe, encoding, packing, token_files
from weighline.llm.queries import BYTE_TOKENIZER, END_ID, WORD_TOKENIZER

WORD, BYTE = public_tokenizers.path(WORD_TOKENIZER), public_tokenizers.path(BYTE_TOKENIZER)
ODD = ["", "a", "aaaaaaa   aa", " \n\n x\t\ty  ", "<|endoftext|>a <|endoftext|>", "x\x1cy\x85z᠎​　 q", "don't we'll I'D", "héllo wörld ñ 你好 👍🏽",
       "ⅷ²½ ٣", "\x00\x01", "a" * 5000, "ŉ İstanbul ΑΣ σς", "é ́x", "K ſ", "\xa0\xa0x", "<|ENDOFTEXT|> <|EndOfText|>", "ﬁ Å Å", ".. ... a.. b., c:; d!? e. f,g"]


@pytest.fixture(scope="module")
def word():
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def byte():
    return Tokenizer.from_file(BYTE)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_word_cache_equals_library(word):
    enc = encoding.encoder(WORD)
    for text in ODD + ODD:
        assert np.frombuffer(enc.ids([text])[0], enc.dtype).tolist() == word.encode(text, add_special_tokens=False).ids, text


def test_words_that_end_in_a_mark(word):
    """Letters whose normal or lower-case form ends in a combining mark, which the library joins with what follows."""
    import unicodedata
    marked = [chr(c) for c in range(0x80, 0x30000) if chr(c).isalpha() and unicodedata.category(unicodedata.normalize("NFC", chr(c)).lower()[-1])[0] == "M"]
    assert len(marked) >= 60
    enc = encoding.Encoder(WORD)
    texts = [f"a{m}{stop} {m}{stop} q" for m in marked for stop in (",", ".", "!!")]
    rng = np.random.default_rng(7)
    letters = [*"abcXYZ019äßÑéµªº.,;:!?'%&-<|>\"", "हय", "İ", "Σ", "한", "ﬁ", "\u0301", "\u09df"]
    texts += [" ".join("".join(rng.choice(letters, rng.integers(1, 7))) for _ in range(20)) for _ in range(400)]
    got = [np.frombuffer(x, enc.dtype).tolist() for x in enc.ids(texts)]
    assert got == [e.ids for e in word.encode_batch(texts, add_special_tokens=False)]


def test_joined_words_fall_back(word, monkeypatch):
    monkeypatch.setattr(encoding, "JOINED_WORDS", 3)
    enc = encoding.Encoder(WORD)
    enc.ends_word[:] = False
    assert np.frombuffer(enc.ids(["one two three four"])[0], enc.dtype).tolist() == word.encode("one two three four", add_special_tokens=False).ids


def test_dictionary_of_long_texts_only(spark):
    long = [(i, f"word{i} of a long text " * 2_000) for i in range(30)]
    assert token_files.train_dictionary(table(spark, long), WORD, END_ID)
    assert token_files.train_dictionary(table(spark, [(1, None), (2, ""), (3, "x")]), WORD, END_ID)
    assert token_files.train_dictionary(table(spark, [(1, None), (2, "")]), WORD, END_ID) == b""


def test_cache_generations(word, monkeypatch):
    monkeypatch.setattr(encoding, "CACHE_WORDS", 3)
    enc = encoding.Encoder(WORD)
    for text in ["one two three four", "two, five six", "one seven. two"] * 2:
        assert np.frombuffer(enc.ids([text])[0], enc.dtype).tolist() == word.encode(text, add_special_tokens=False).ids


def test_unknown_tokenizer_is_given_whole_texts(byte):
    enc = encoding.Encoder(BYTE)
    assert not enc.by_word
    assert np.frombuffer(enc.ids(["a b  c"])[0], enc.dtype).tolist() == byte.encode("a b  c").ids


def test_token_files(spark, tmp_path, word):
    data = rows()
    files = token_files.write_tokens(table(spark), str(tmp_path / "t"), WORD, END_ID)
    got = sorted(token_files.read_tokens(spark, files).collect(), key=lambda r: r.start)
    want = {}
    for i, t in data:
        want.setdefault(i, []).append(word.encode(t or "", add_special_tokens=False).ids + [END_ID])
    assert [r.doc_id for r in got] == sorted((i for i, _ in data), key=lambda i: (i is not None, i))
    assert [r.start for r in got] == [0, *itertools.accumulate(r.n_tokens for r in got)][:-1]
    for i, ids in want.items():
        assert sorted((r.n_tokens, r.ids_crc32) for r in got if r.doc_id == i) == sorted((len(x), crc(x)) for x in ids)
        if i is not None:
            assert sorted(token_files.read_document(spark, files, i)) == sorted(ids)


def test_token_files_many_blocks(spark, tmp_path, monkeypatch, word):
    files = token_files.write_tokens(table(spark, [(i, f"text {i} " * (i % 9)) for i in range(9_500)]).coalesce(1), str(tmp_path / "t"), WORD, END_ID)
    assert files.blocks(spark).count() >= 3
    got = token_files.read_tokens(spark, files).orderBy("doc_id").collect()
    assert [r.start for r in got] == [0, *itertools.accumulate(r.n_tokens for r in got)][:-1]
    assert got[17].ids_crc32 == crc(word.encode("text 17 " * 8).ids + [END_ID])


def test_token_files_empty(spark, tmp_path):
    files = token_files.write_tokens(empty(spark), str(tmp_path / "t"), WORD, END_ID)
    assert token_files.read_tokens(spark, files).count() == 0 and token_files.read_document(spark, files, 1) == []


def test_best_fit_takes_the_tightest_bin():
    rng = np.random.default_rng(3)
    lengths = np.sort(rng.integers(1, 65, 2_000))[::-1]
    bins, offsets = packing.best_fit(lengths, 64)
    left: list[int] = []
    for length, b, o in zip(lengths.tolist(), bins.tolist(), offsets.tolist()):
        fits = [x for x in left if x >= length]
        if b == len(left):
            assert not fits
            left.append(64)
        assert left[b] == (min(fits) if fits else 64) and o == 64 - left[b]
        left[b] -= length


def test_pack(spark, word):
    data = rows()
    got = packing.pack(table(spark), WORD, END_ID, 256).collect()
    want = []
    for i, t in data:
        ids = word.encode(t or "", add_special_tokens=False).ids + [END_ID]
        want += [(i, p, s, len(ids[s:s + 256]), crc(ids[s:s + 256])) for p, s in enumerate(range(0, len(ids), 256))]
    assert sorted([tuple(r)[:5] for r in got], key=key) == sorted(want, key=key)
    for _, group in itertools.groupby(sorted(got, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for r in group:
            assert r.offset == at
            at += r.length
        assert at <= 256
    assert len({r.sequence_id for r in got}) <= sum(r.length for r in got) / 256 + 4
    assert packing.pack(empty(spark), WORD, END_ID).count() == 0


def test_pack_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 100)
    got = packing.pack(table(spark, [(i, "w " * (i % 50)) for i in range(1_000)]), WORD, END_ID, 64).collect()
    assert len(got) == 1_000 and len({r.sequence_id >> 40 for r in got}) == 10
    sums = {}
    for r in got:
        sums[r.sequence_id] = sums.get(r.sequence_id, 0) + r.length
    assert max(sums.values()) <= 64 and sum(v < 56 for v in sums.values()) <= 20


def test_bpe_equals_library(byte):
    c = bpe.coder(BYTE)
    for text in ODD:
        want = byte.encode(text, add_special_tokens=False).ids
        (listed, ids), = c.encode([text])
        assert ids.tolist() == want and listed == ",".join(map(str, want)), text
        assert c.decode(ids) == byte.decode(want, skip_special_tokens=False), text


def test_bpe_whole_table(spark, byte):
    want = [(i, byte.encode(t or "", add_special_tokens=False).ids) for i, t in rows()]
    got = bpe.round_trip(table(spark), BYTE).collect()
    full = [(i, len(x), sha(",".join(map(str, x))), sha(byte.decode(x, skip_special_tokens=False))) for i, x in want]
    assert sorted(map(tuple, got), key=key) == sorted(full, key=key)
    back = bpe.decode(bpe.encode(table(spark), BYTE), BYTE).collect()
    assert sorted(map(tuple, back), key=key) == sorted([(i, t or "") for i, t in rows()], key=key)
    assert bpe.round_trip(empty(spark), BYTE).count() == 0
