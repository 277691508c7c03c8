"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Test items are taken in chunks of bounded size, so what is sent to the workers does not grow with
the benchmark; each chunk is held against every training text.

1. Seeds: every word n-gram of an item.  Choosing the rarest of a window would lose edited copies:
   an n-gram of theirs is never the rarest beside those of the verbatim copies in other texts.
2. Texts meet items where they share a seed.  A bound on the words they can have in common drops
   chance meetings without losing a match.
3. Around the remaining diagonals the item's words are aligned with the passage's words; the
   alignment score over the best possible one is the share.  A long passage counts whatever its share:
   ``PASSAGE`` equal words within ``STRETCH`` steps of an alignment, which always hold a seed.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import land, plain_words, ship

GRAM = 4
MATCH, MISMATCH, GAP = 2, -1, -1
SHARE = 0.5  # least alignment share that counts as contaminated
WORDS = 6  # least number of aligned words
PASSAGE, STRETCH = 13, 16  # so many equal words in so many steps count for any length of item; four of them are in a row
CHUNK_WORDS = 1_000_000

_MIX = np.uint64(0x9E3779B97F4A7C15)  # odd; a clash of keys only costs an alignment


def gram_keys(ids: np.ndarray) -> np.ndarray:
    """One key per n-gram of word numbers."""
    if len(ids) < GRAM:
        return np.zeros(0, np.uint64)
    words, keys = ids.astype(np.uint64), np.zeros(len(ids) - GRAM + 1, np.uint64)
    for step in range(GRAM):
        keys = (keys ^ (keys >> np.uint64(29))) * _MIX + words[step : step + len(keys)]
    return keys


class Items:
    """Test items of one chunk as word numbers, with their n-grams and, once counted, their seeds."""

    def __init__(self, rows: list[tuple]):
        self.vocabulary: dict[bytes, int] = {}
        self.names, self.words = [], []
        for name, text in rows:
            words = plain_words(text)
            if len(words) >= GRAM:
                self.names.append(name)
                self.words.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]))
        self.grams = [gram_keys(words) for words in self.words]
        self.bags = [np.unique(words, return_counts=True) for words in self.words]
        self.choose_seeds()

    def choose_seeds(self, frequency: dict[int, int] | None = None) -> None:
        """All n-grams, sorted, with item and place in it; how many texts hold them does not matter."""
        sizes = [len(grams) for grams in self.grams]
        keys = np.concatenate([np.zeros(0, np.uint64), *self.grams])
        order = np.argsort(keys, kind="stable")
        self.keys, self.item_of = keys[order], np.repeat(np.arange(len(sizes)), sizes)[order]
        self.inside = np.concatenate([np.zeros(0, np.int64), *map(np.arange, sizes)])[order]
        self.seeds = np.unique(self.keys)

    def read(self, text: str | None) -> np.ndarray:
        """Word numbers of a text; 0 stands for words that no item has."""
        words = plain_words(text)
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words))

    def hits(self, ids: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, keys) of a text's n-grams that are ``among`` a sorted array."""
        known = ids != 0
        if len(ids) < GRAM or not len(among):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        whole = known[: len(ids) - GRAM + 1].copy()
        for step in range(1, GRAM):
            whole &= known[step : step + len(whole)]
        at = np.flatnonzero(whole)
        if not len(at):
            return at, np.zeros(0, np.uint64)
        words, keys = ids.astype(np.uint64), np.zeros(len(at), np.uint64)
        for step in range(GRAM):
            keys = (keys ^ (keys >> np.uint64(29))) * _MIX + words[at + step]
        place = np.searchsorted(among, keys)
        place[place == len(among)] = 0
        found = among[place] == keys
        return at[found], keys[found]

    def may_match(self, item: int, passage: np.ndarray) -> bool:
        """Whether the words in common, order aside, are enough for the share or for a long passage: no alignment has more equal words."""
        words, counts = self.bags[item]
        place = np.minimum(np.searchsorted(words, passage), len(words) - 1)
        shared = words[place] == passage
        common = np.bincount(place[shared], minlength=len(words))
        if int(np.minimum(common, counts).sum()) >= SHARE * len(self.words[item]):
            return True
        running = np.concatenate([[0], np.cumsum(shared), np.full(STRETCH, shared.sum())])
        return bool((running[STRETCH:] - running[:-STRETCH]).max() >= PASSAGE)

    def alignments(self, item: int, passage: np.ndarray) -> Iterator[tuple]:
        """(counts, score, equal words, first, after last): the best alignment, and while none counts the best of what is left.

        A long passage may lie beside a looser alignment of a higher score, so aligned words are blanked and the rest aligned again.
        """
        words = self.words[item]
        while True:
            score, equal, first, last, dense = align_path(words, passage)
            counts = dense or score >= SHARE * MATCH * len(words) and equal >= min(WORDS, len(words))
            yield counts, score, equal, first, last
            if counts or score < MATCH * PASSAGE - (STRETCH - PASSAGE):
                return
            passage = passage.copy()
            passage[first:last] = 0

    def matches(self, text: str | None) -> list[tuple]:
        """(item, share, aligned words, first word, word after the last) of each item found in a text."""
        ids = self.read(text)
        at, keys = self.hits(ids, self.seeds)
        diagonals = defaultdict(set)
        places = zip(np.searchsorted(self.keys, keys, "left").tolist(), np.searchsorted(self.keys, keys, "right").tolist())
        for position, (lo, hi) in zip(at.tolist(), places):
            for item, inside in zip(self.item_of[lo:hi].tolist(), self.inside[lo:hi].tolist()):
                diagonals[item].add(position - inside)
        out = []
        for item, offsets in sorted(diagonals.items()):
            words = self.words[item]
            slack = max(4, len(words) // 4)
            best, begin, end = None, None, None
            for offset in [*sorted(offsets), None]:
                lo, hi = (len(ids), None) if offset is None else (max(0, offset - slack), offset + len(words) + slack)
                if begin is not None and (offset is None or lo > end):
                    if self.may_match(item, ids[begin:end]):
                        for found in self.alignments(item, ids[begin:end]):
                            found = (*found[:3], found[3] + begin, found[4] + begin)
                            best = found if best is None or found[:2] > best[:2] else best
                    begin = None
                if offset is not None:
                    begin, end = (lo, hi) if begin is None else (begin, max(end, hi))
            if best is None:
                continue
            if best[0]:
                out.append((self.names[item], best[1] / (MATCH * len(words)), *best[2:]))
        return out


def _table(item: np.ndarray, passage: np.ndarray) -> np.ndarray:
    """Smith-Waterman scores, one row per item word.  A row's gaps to the right are a running maximum."""
    slope = np.arange(len(passage)) * -GAP
    rows = np.zeros((len(item) + 1, len(passage) + 1), np.int64)
    for i, word in enumerate(item, 1):
        above = rows[i - 1]
        row = np.maximum(above[:-1] + np.where(passage == word, MATCH, MISMATCH), above[1:] + GAP)
        row = np.maximum(row, 0)
        rows[i, 1:] = np.maximum.accumulate(row + slope) - slope
    return rows


def align_path(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int, int, bool]:
    """(score, equal words, first, after last, long passage) of the best local alignment, positions in the passage."""
    if not len(passage):
        return 0, 0, 0, 0, False
    rows = _table(item, passage)
    i, j = np.unravel_index(int(rows.argmax()), rows.shape)
    score, last, step, equal = int(rows[i, j]), int(j), 0, []
    while i and j and rows[i, j] > 0:
        same = item[i - 1] == passage[j - 1]
        if rows[i, j] == rows[i - 1, j - 1] + (MATCH if same else MISMATCH):
            if same:
                equal.append(step)
            i, j = i - 1, j - 1
        elif rows[i, j] == rows[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
        step += 1
    dense = any(end - begin < STRETCH for begin, end in zip(equal, equal[PASSAGE - 1 :]))
    return score, len(equal), int(j), last, dense


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int, int]:
    """(score, equal words, first, after last) of the best local alignment, positions in the passage."""
    return align_path(item, passage)[:4]


def _chunks(items: DataFrame, key: str, text: str, chunk_words: int) -> Iterator[list[tuple]]:
    """Items dealt into chunks of about ``chunk_words`` words; one chunk is on the driver at a time."""
    named = items.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t is not null")
    words = named.agg(F.sum(F.size(F.split("t", r"\s+")))).first()[0] or 0
    count = max(1, -(-words // chunk_words))
    dealt = named.withColumn("chunk", F.pmod(F.xxhash64("k", "t"), F.lit(count)))
    for chunk in range(count):
        rows = [tuple(r) for r in dealt.where(F.col("chunk") == chunk).select("k", "t").collect()]
        if rows:
            yield sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def contaminated(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", chunk_words: int = CHUNK_WORDS,
) -> DataFrame:
    """(``key``, ``item_key``, share, words, first_word, end_word): one row per text and test item found in it.

    ``share`` is the alignment score over that of a verbatim copy; a long passage of a longer item has a small one.  Texts and items that are null or
    shorter than the n-gram match nothing.  Repeated rows of texts are reported once each, equal
    items each on their own; other columns are ignored; an empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    kinds = docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    schema = f"`{key}` {kinds[0]}, `{item_key}` {kinds[1]}, share double, words bigint, first_word bigint, end_word bigint"
    names = [key, item_key, "share", "words", "first_word", "end_word"]
    found = spark.createDataFrame([], schema)
    arrow_kinds = found.toArrow().schema.types
    for rows in _chunks(items, item_key, item_text, chunk_words):
        chunk = Items(rows)
        if not chunk.names:
            continue
        seeded = spark.sparkContext.broadcast(chunk)

        def search(batches: Iterator[pa.RecordBatch], seeded=seeded) -> Iterator[pa.RecordBatch]:
            items = seeded.value
            for batch in batches:
                out = [
                    (name, *match)
                    for name, value in zip(batch.column(0).to_pylist(), batch.column(1))
                    for match in items.matches(value.as_py())
                ]
                if out:
                    columns = [pa.array(column, kind) for column, kind in zip(zip(*out), arrow_kinds)]
                    yield pa.RecordBatch.from_arrays(columns, names)

        found = found.union(docs.select(key, text).mapInArrow(search, schema))
    return found


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the texts in which a test item was found.

    The text alone decides: rows go wherever their text stands, whatever their key, and a key that also
    stands on clean texts keeps those.  Repeated rows go or stay together; all columns are kept.
    """
    names, spare = docs.columns, [f"in_{i}" for i in range(len(docs.columns))]
    said = spare[names.index(text)]
    rows = docs.toDF(*spare).withColumn("mark", F.md5(F.coalesce(F.col(said).cast("string"), F.lit(""))))
    hit = land(contaminated(rows.select("mark", F.col(said).alias("said")), items, "mark", "said").select(F.col("mark").alias("hit")).distinct())
    kept = rows.join(hit, F.col("mark") == F.col("hit"), "left_anti")
    return kept.select(*[F.col(s).alias(n) for s, n in zip(spare, names)])
