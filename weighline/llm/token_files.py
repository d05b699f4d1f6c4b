"""Operator 1: token ids of documents in files of separately compressed documents.

File format.  A table of blocks (Parquet, so that any store Spark writes to can hold it and a retried task leaves no
half file).  Blocks follow each other by ``shard`` and ``block`` in ascending doc_id order.  A block holds the
documents' frames one after the other in ``frames`` and an index: ``doc_ids``, ``offsets`` (start of every frame) and
``lengths`` (tokens).  A frame is one document's ids as little-endian unsigned integers, ``width`` bytes each, compressed alone by zstandard with a
dictionary shared by all; ``dictionary_hash`` (SHA-256) names it, and ``dictionary`` beside the blocks holds it.  To
read one document, find its block by ``first_id``/``last_id`` (pushed down to the files' statistics), cut its frame
by the offsets and decompress that frame only.

Defined results.  Null text is empty; every document ends with ``end_id``, so an empty one has one token.  Rows with
the same doc_id stay separate and lie next to each other, ordered by their content; a null doc_id sorts first.  An
empty table gives empty files.  Only the two named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from weighline.llm import common as C
from weighline.llm.encoding import encoder

#: The dictionary is trained on about so many documents of any length, and on at most so many ids of each.
TRAIN_DOCUMENTS, TRAIN_IDS, DICTIONARY_BYTES = 400, 4_000, 16_384
#: Characters of a drawn text that are sent to the driver.
TRAIN_CHARS = 20_000
#: A block ends after so many compressed bytes or documents; a shard aims at so many tokens.
BLOCK_BYTES, BLOCK_DOCUMENTS, SHARD_TOKENS = 1 << 20, 4_096, 16_000_000
LEVEL = 3

_FRAME = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("frame", pa.binary())])
_BLOCK = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("last_id", pa.int64()),
                    ("tokens_before", pa.int64()), ("n_tokens", pa.int64()), ("width", pa.int32()), ("dictionary_hash", pa.string()),
                    ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())),
                    ("lengths", pa.list_(pa.int64())), ("frames", pa.binary())])
BLOCK_SCHEMA = ("shard int, block int, first_id long, last_id long, tokens_before long, n_tokens long, width int, "
                "dictionary_hash string, doc_ids array<long>, offsets array<long>, lengths array<long>, frames binary")
_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


@dataclass(frozen=True)
class TokenFiles:
    """Where the files are: ``path``/blocks and ``path``/dictionary."""

    path: str

    def blocks(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(BLOCK_SCHEMA).parquet(f"{self.path}/blocks")

    def dictionary(self, spark: SparkSession) -> bytes:
        row = spark.read.schema("hash string, bytes binary").parquet(f"{self.path}/dictionary").first()
        data = bytes(row["bytes"])
        if C.sha(data) != row["hash"]:
            raise ValueError("the dictionary does not have the hash it is named by")
        return data


def _zdict(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> bytes:
    """A dictionary trained on the serialized ids of a bounded sample (see ``TRAIN_DOCUMENTS``).

    The sample is drawn by a hash of the id from the documents that have a text, of any length; of a long text a part is
    used, since a dictionary gains nothing from one document's tail.  It only changes how well frames are compressed.
    """
    text = F.substring(F.col(text_col), 1, TRAIN_CHARS)
    full = docs.where(F.length(text_col) > 0)
    share = min(1.0, 2 * TRAIN_DOCUMENTS / max(1, docs.count()))
    below = F.lit(min((1 << 63) - 1, int(-(1 << 63) + share * (1 << 64))))
    drawn = full.select(text.alias("t"), F.xxhash64(F.col(id_col)).alias("h"))
    rows = drawn.where(F.col("h") <= below).limit(TRAIN_DOCUMENTS).collect()
    if not rows:  # fewer texts than the share allows for, or none: any will do
        rows = drawn.limit(TRAIN_DOCUMENTS).collect()
    if not rows:
        return b""
    enc = encoder(tokenizer)
    end, width = np.array([end_id], dtype=enc.dtype).tobytes(), np.dtype(enc.dtype).itemsize
    samples = [ids[:TRAIN_IDS * width] + end for ids in enc.ids([r["t"] for r in rows])]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their bytes themselves serve as the dictionary
        return b"".join(samples)[:DICTIONARY_BYTES]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text") -> TokenFiles:
    """Encode every whole text and write the files described above to ``path``.

    Texts are read once and only compressed frames are moved: encoding and compression happen where the text is read,
    then the frames are dealt out by ranges of doc_id.
    """
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, tokenizer, end_id, id_col, text_col)
    name = C.sha(dictionary)

    def compress(batches):
        enc = encoder(tokenizer)
        width = np.dtype(enc.dtype).itemsize
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        z = zstandard.ZstdCompressor(level=LEVEL, dict_data=_zdict(dictionary))
        for b in batches:
            ids = [x + end for x in enc.ids(b.column(1).to_pylist())]
            yield C.batch(_FRAME, doc_id=b.column(0), n_tokens=[len(x) // width for x in ids],
                          frame=[z.compress(x) for x in ids])

    frames = C.table(C.map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), C.text_of(text_col).alias("text")),
                                 compress, "doc_id long, n_tokens long, frame binary"), "frames")
    tokens = frames.agg(F.sum("n_tokens")).first()[0] or 0
    n = C.partitions_for(spark, tokens, SHARD_TOKENS)

    def blocks(batches):
        shard = TaskContext.get().partitionId()
        width = np.dtype(encoder(tokenizer).dtype).itemsize
        ids, lengths, parts, size, number, before = [], [], [], 0, 0, 0

        def cut():
            offsets = np.cumsum([0, *(len(p) for p in parts[:-1])])
            named = [i for i in ids if i is not None] or [None]
            return C.batch(_BLOCK, shard=[shard], block=[number], first_id=[named[0]], last_id=[named[-1]],
                           tokens_before=[before], n_tokens=[sum(lengths)], width=[width], dictionary_hash=[name],
                           doc_ids=[ids], offsets=[offsets], lengths=[lengths], frames=[b"".join(parts)])

        for b in batches:
            for i, n_tokens, frame in zip(*(c.to_pylist() for c in b.columns)):
                ids.append(i)
                lengths.append(n_tokens)
                parts.append(frame)
                size += len(frame)
                if size >= BLOCK_BYTES or len(ids) >= BLOCK_DOCUMENTS:
                    yield cut()
                    before, number = before + sum(lengths), number + 1
                    ids, lengths, parts, size = [], [], [], 0
        if ids:
            yield cut()

    ordered = frames.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "n_tokens", F.xxhash64("frame"))
    C.map_arrow(ordered, blocks, BLOCK_SCHEMA).write.mode("overwrite").parquet(f"{path}/blocks")
    (spark.createDataFrame([(name, bytearray(dictionary))], "hash string, bytes binary").coalesce(1)
     .write.mode("overwrite").parquet(f"{path}/dictionary"))
    return TokenFiles(path)


def _unpack(block_rows, dictionary: bytes):
    """For every block row: (row, [ids array of every document])."""
    z = zstandard.ZstdDecompressor(dict_data=_zdict(dictionary))
    for row in block_rows:
        ends = [*row["offsets"][1:], len(row["frames"])]
        view = memoryview(row["frames"])
        yield row, [np.frombuffer(z.decompress(view[a:e]), dtype=f"<u{row['width']}") for a, e in zip(row["offsets"], ends)]


def read_tokens(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """Every document of the files: doc_id, start (tokens before it), n_tokens, ids_crc32 (of its ids as unsigned 32-bit).

    Tokens before a shard are summed over one row per shard; inside a shard every block knows its own start.
    """
    blocks, dictionary = files.blocks(spark), files.dictionary(spark)
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("shard_start"))

    def decode(batches):
        for b in batches:
            for row, documents in _unpack(b.to_pylist(), dictionary):
                starts = row["shard_start"] + row["tokens_before"] + np.cumsum([0, *row["lengths"][:-1]])
                yield C.batch(_READ, doc_id=row["doc_ids"], start=starts, n_tokens=[len(x) for x in documents],
                              ids_crc32=[zlib.crc32(x.astype("<u4").tobytes()) for x in documents])

    return C.map_arrow(blocks.join(shards, "shard"), decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_document(spark: SparkSession, files: TokenFiles, doc_id: int) -> list[list[int]]:
    """The ids of the documents with this doc_id: its blocks are found by their bounds, only its frames decompressed."""
    z = zstandard.ZstdDecompressor(dict_data=_zdict(files.dictionary(spark)))
    out = []
    found = files.blocks(spark).where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
    for row in found.select("width", "doc_ids", "offsets", "frames").toLocalIterator():
        ends = [*row["offsets"][1:], len(row["frames"])]
        out += [np.frombuffer(z.decompress(bytes(row["frames"][a:e])), dtype=f"<u{row['width']}").tolist()
                for i, a, e in zip(row["doc_ids"], row["offsets"], ends) if i == doc_id]
    return out
