"""Token counts by the whole-token shortcut.

Offline, every vocabulary string is encoded alone; the strings that come back as exactly their own
token are proven to cost one token wherever they stand as a whole pre-token.  A task splits a text
into pre-tokens, counts the proven ones directly, and merges only the rest, once per distinct string.

The proven set has at most one entry per vocabulary entry, which bounds its broadcast.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import ship

# Fixed value: the split pattern of byte-level BPE vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KEPT = 300_000  # merged strings a worker remembers
LONGEST_KEPT = 64


def library(path: str, special_as_text: bool = False):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    if special_as_text:
        tokenizer.encode_special_tokens = True
    return tokenizer


def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings that, encoded alone, are one token: their own."""
    tokenizer = library(path, special_as_text=True)
    ids = sorted(tokenizer.get_vocab(with_added_tokens=False).values())
    texts = tokenizer.decode_batch([[i] for i in ids], skip_special_tokens=False)
    known = [(i, text) for i, text in zip(ids, texts) if text and "�" not in text]
    encoded = tokenizer.encode_batch([text for _, text in known], add_special_tokens=False)
    return frozenset(text for (i, text), one in zip(known, encoded) if one.ids == [i])


class PreTokenCounter:
    """Counts tokens of texts for one vocabulary file, given its proven whole tokens."""

    def __init__(self, path: str, whole: frozenset[str]):
        import regex

        self.split = regex.compile(SPLIT)
        self.tokenizer = library(path)
        self.pieces = library(path, special_as_text=True)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = whole
        self.cost: dict[str, int] = dict.fromkeys(whole, 1)
        self.same_class: dict[str, bool] = {}

    def _agrees(self, char: str) -> bool:
        """Whether library and pattern put a character into the same class (they follow different Unicode tables)."""
        if char not in self.same_class:
            self.same_class[char] = all(
                [span for _, span in self.pieces.pre_tokenizer.pre_tokenize_str(probe)]
                == [m.span() for m in self.split.finditer(probe)]
                for probe in (f"a{char}1", f" {char}!", f"1{char}a")
            )
        return self.same_class[char]

    def count(self, text: str | None) -> tuple[int, int]:
        """(tokens, tokens found by the shortcut)."""
        if not text:
            return 0, 0
        if any(s in text for s in self.special) or not all(map(self._agrees, set(text))):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids), 0
        found = self.split.findall(text)
        rest = [p for p in set(found) if p not in self.cost]
        for piece, encoded in zip(rest, self.pieces.encode_batch(rest, add_special_tokens=False)):
            self.cost[piece] = len(encoded.ids)
        tokens = sum(map(self.cost.__getitem__, found))
        direct = sum(map(self.whole.__contains__, found))
        for piece in rest:
            if len(piece) > LONGEST_KEPT:
                del self.cost[piece]
        if len(self.cost) > len(self.whole) + KEPT:
            self.cost = dict.fromkeys(self.whole, 1)
        return tokens, direct


@lru_cache(maxsize=1)
def _counter(path: str, whole: frozenset[str]) -> PreTokenCounter:
    return PreTokenCounter(path, whole)


def count_tokens(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 1024) -> DataFrame:
    """One row per input row: ``key``, n_bytes, n_tokens, over_limit (n_tokens > ``limit``), n_whole.

    Counts equal those of the tokenizers library for the file at ``path``, which executors must be
    able to read, without added special tokens; special strings inside a text count as the library
    counts them by default.  Null and empty texts have 0 bytes and tokens; repeated rows stay
    repeated; other columns are ignored; an empty table gives an empty result.
    """
    ship(df.sparkSession)
    proven = df.sparkSession.sparkContext.broadcast(whole_tokens(path))
    rows = df.select(
        F.col(key), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"), F.col(text).alias("_text"),
    )
    names = [key, "n_bytes", "n_tokens", "over_limit", "n_whole"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, proven.value)
        for batch in batches:
            pairs = [counter.count(value.as_py()) for value in batch.column(2)]
            tokens = pa.array([n for n, _ in pairs], pa.int64())
            over = pa.array([n > limit for n, _ in pairs], pa.bool_())
            whole = pa.array([d for _, d in pairs], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), tokens, over, whole], names)

    kind = df.schema[key].dataType.simpleString()
    return rows.mapInArrow(count, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean, n_whole bigint")
