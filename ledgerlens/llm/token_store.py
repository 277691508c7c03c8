"""Token-id shards: documents in key order, each shard one wavelet-matrix file.

Documents are dealt into key ranges, sorted inside them, encoded, and cut into shards of bounded
size; a shard's payload is a wavelet-matrix file.  Spark writes the payloads as binary rows of
Parquet, so the store needs no file system but the one Spark has; a row's columns say where the
shard belongs.  Reading needs no order: a shard knows its offset in its range, and the range's
offset comes from a table with one row per range.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import ship
from ledgerlens.llm.token_counts import LONGEST_KEPT, library
from ledgerlens.llm.wavelet import WaveletFile, build
from ledgerlens.operators.stability import checkpoint_folder, partition_count

END = 1  # id that closes a document
SHARD_TOKENS = 1_000_000
KEPT = 400_000  # words, and pieces, a worker remembers: some 65 MB each
CHUNK_BYTES = 2 << 20  # text encoded at once, unless one text is longer
BREAK, _BREAK = b"\xff" * 4, 0xFFFFFFFF  # between words; no id
_SHARDS = "part int, shard int, part_offset bigint, n_docs int, n_tokens bigint, doc_ids binary, no_id binary, lengths binary, payload binary"


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordEncoder:
    """Ids of whole texts.  Tokens never cross ASCII white space in this kind of vocabulary, so each distinct word is encoded once.

    Most words consist of printable ASCII and Latin-1 letters, which normalisation only lowers.  The new
    ones are cut into pieces together, and only the merges of a new piece are left to the library;
    other words go through it as a whole.
    """

    OTHER = re.compile("[^\n!-~À-ÖØ-öø-ÿ]")
    PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\n]+|\n")

    def __init__(self, path: str):
        self.tokenizer = library(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special, self.other = re.compile("|".join(map(re.escape, special)) or r"(?!)").finditer, self.OTHER.finditer
        letters = [chr(c) for c in range(0xDF, 0x100) if c != 0xF7]
        byte_level = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.bytes_of = str.maketrans({c: byte_level(c)[0][0] for c in letters})
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _by_library(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _learn_pieces(self, new: set[str]) -> None:
        merged, pieces = self.tokenizer.model.tokenize, list(new)
        odd = [i for i, piece in enumerate(pieces) if not piece.isascii()]
        texts = pieces.copy()
        for i, text in zip(odd, "\n".join([pieces[i] for i in odd]).translate(self.bytes_of).split("\n")):
            texts[i] = text
        ids, ends = [], [0]
        for text in texts:
            ids += [t.id for t in merged(text)]
            ends.append(4 * len(ids))
        packed = _packed(ids)
        self.pieces.update(zip(pieces, [packed[a:b] for a, b in zip(ends, ends[1:])]))

    def _learn(self, new: list[bytes]) -> None:
        """Encode words not met before."""
        texts = [word.decode() for word in new]
        joined = "\n".join(texts)
        odd = [m.start() for find in (self.special, self.other) for m in find(joined)]
        if odd:
            starts = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
            out = set(np.searchsorted(starts, odd, side="right").tolist())
            self.words.update((new[i], self._by_library(texts[i])) for i in out)
            new = [word for i, word in enumerate(new) if i not in out]
            joined = "\n".join([text for i, text in enumerate(texts) if i not in out])
        if not new:
            return
        found, known = self.PIECES.findall(joined.lower()), self.pieces
        known["\n"] = BREAK
        fresh = set(found).difference(known)
        self._learn_pieces(fresh)
        # Word by word again: a line break ends one.
        ids = b"".join(map(known.__getitem__, found))
        breaks = (np.flatnonzero(np.frombuffer(ids, "<u4") == _BREAK) * 4).tolist()
        self.words.update(zip(new, [ids[a:b] for a, b in zip([0, *[at + 4 for at in breaks]], [*breaks, len(ids)])]))
        for piece in fresh:
            if len(piece) > LONGEST_KEPT:
                del known[piece]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, without special tokens added, and how many each text has.

        A word is looked up once, however often it stands in these texts.
        """
        words = pc.ascii_split_whitespace(texts.fill_null(""))
        coded = words.flatten().dictionary_encode()
        distinct, known = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist(), self.words
        each = list(map(known.get, distinct))
        new = [word for word, found in zip(distinct, each) if found is None]
        if new:
            self._learn(new)
            each = [known[word] if found is None else found for word, found in zip(distinct, each)]
        # As bytes, so that no array of positions is needed, which takes several times the memory of the ids.
        coded_ids = pa.array(each, pa.large_binary()).take(coded.indices)
        _, places, packed = coded_ids.buffers()
        ends = np.frombuffer(places, "<i8", len(coded_ids) + 1) // 4 if len(coded_ids) else np.zeros(1, np.int64)
        ids = np.frombuffer(packed, "<u4", ends[-1]) if ends[-1] else np.zeros(0, "<u4")
        for word in new:
            if len(word) > LONGEST_KEPT:
                del known[word]
        for kept in (known, self.pieces):
            if len(kept) > KEPT:  # the oldest quarter goes, and what is above the bound
                for one in list(islice(kept, len(kept) - KEPT * 3 // 4)):
                    del kept[one]
        edges = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy())])
        return ids, np.diff(ends[edges])


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of some ``CHUNK_BYTES``."""
    sizes = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy().astype(np.int64))
    begin = 0
    while begin < len(sizes):
        before = int(sizes[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, before + CHUNK_BYTES, side="right")))
        yield begin, end
        begin = end


def write(df: DataFrame, folder: str, path: str, key: str = "doc_id", text: str = "text", end: int | None = END,
          shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode all texts and write the shards to ``folder``, in ascending ``key`` order, null keys first, equal keys by text hash."""
    spark = df.sparkSession
    ship(spark)
    closing = None if end is None else np.uint32(end)
    order = [F.col("k").asc_nulls_first(), F.col("h")]
    placed = (
        df.select(F.col(key).cast("bigint").alias("k"), F.xxhash64(text).alias("h"), F.col(text).alias("t"))
        .repartitionByRange(partition_count(spark), *order).sortWithinPartitions(*order).select("k", "t")
    )

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(path), TaskContext.get().partitionId()
        shard, offset, tokens, held = 0, 0, 0, []

        def flush() -> pa.RecordBatch:
            keys, absent, lengths, ids = map(np.concatenate, zip(*held))
            values = [[part], [shard], [offset], [len(keys)], [tokens], [keys.astype("<i8").tobytes()], [absent.astype("u1").tobytes()],
                      [lengths.astype("<u4").tobytes()], [build(ids)]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, fields)], [f.name for f in fields])

        for batch in batches:
            names = batch.column(0)
            keys, absent = names.fill_null(0).to_numpy(), names.is_null().to_numpy(zero_copy_only=False)
            for begin, end in _chunks(batch.column(1)):
                ids, lengths = encoder.encode(batch.column(1).slice(begin, end - begin))
                if closing is not None:
                    ids, lengths = np.insert(ids, np.cumsum(lengths), closing), lengths + 1
                ends = np.concatenate([[0], np.cumsum(lengths)])
                at, n = 0, end - begin
                while at < n:
                    # A shard ends with the text that fills it.
                    to = min(n, int(np.searchsorted(ends[1:], ends[at] + shard_tokens - tokens)) + 1)
                    to = max(to, at + 1)
                    held.append((keys[begin + at : begin + to], absent[begin + at : begin + to], lengths[at:to], ids[ends[at] : ends[to]]))
                    tokens += int(ends[to] - ends[at])
                    at = to
                    if tokens >= shard_tokens:
                        yield flush()
                        shard, offset, tokens, held = shard + 1, offset + tokens, 0, []
        if held:
            yield flush()

    fields = [
        pa.field(name, {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}[kind])
        for name, kind in (f.split(" ") for f in _SHARDS.split(", "))
    ]
    placed.mapInArrow(shards, _SHARDS).write.option("compression", "uncompressed").parquet(folder)


def shard_table(spark: SparkSession, folder: str) -> DataFrame:
    """The shards with ``start``, the number of ids before each."""
    shards = spark.read.schema(_SHARDS).parquet(folder)
    # One row per key range; there are as many as shuffle partitions, whatever the data.
    ranges = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = ranges.select(F.col("part").alias("p"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return shards.join(F.broadcast(bases), F.col("part") == F.col("p")).select(
        (F.col("base") + F.col("part_offset")).alias("start"), "n_docs", "n_tokens", "doc_ids", "no_id", "lengths", "payload",
    )


def digest(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """Per document of a store, read from its files: ``key``, start, n_tokens, ids_crc32."""
    ship(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):  # one payload at a time
                ids = WaveletFile(row["payload"]).all().astype("<u4")
                keys, absent = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["no_id"], "u1").astype(bool)
                lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
                ends = np.cumsum(lengths)
                raw = memoryview(ids.tobytes())
                sums = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, mask=absent), pa.array(row["start"] + ends - lengths), pa.array(lengths), pa.array(sums, pa.int64())],
                    [key, "start", "n_tokens", "ids_crc32"],
                )

    return shard_table(spark, folder).mapInArrow(read, f"`{key}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write a store of ``df`` in the shared folder and return its digest.

    Null and empty texts are documents with the closing id alone.  Repeated rows are documents of
    their own.  Other columns are ignored; an empty table gives an empty store and result.
    """
    folder = f"{checkpoint_folder(df.sparkSession).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write(df, folder, path, key, text)
    return digest(df.sparkSession, folder, key)
