"""SimHash near-duplicates by pigeonring filtering.

A 64-bit fingerprint is cut into a ring of seven segments.  If two fingerprints differ in at most
four bits, some segment starts a chain in which, for every length l, the first l segments differ in
at most ⌊4·l/7⌋ bits together (the pigeonring form of the pigeonhole principle).  So the start is
equal, so is one of the next two segments, and so are two of the next four: each start offers five
pairs, and its three equal segments, 27 or 28 bits, are the key under which candidates meet.  Under
a key, chains are followed segment by segment and drop out once over budget; what passes the last
segment is within four bits of the whole.

Equal fingerprints are folded first, so exact copies are one row.  Keys with one fingerprint end
before any pairing.  A key with very many is dealt in blocks, and each pair of blocks is a unit of
bounded size.  A unit returns a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import land, ship
from ledgerlens.llm.components import components
from ledgerlens.operators.stability import materialise

SHINGLE = 4
SEED = 42
BITS = 4  # links differ in this many bits at most
RING = (10, 9, 9, 9, 9, 9, 9)  # bits of the segments
BLOCK = 2048  # fingerprints of a key that meet in one unit, times two
HASHED = 65_536  # shingles whose bits are counted at once

_edges = np.cumsum((0, *RING))
MASKS = [((1 << int(hi)) - 1) ^ ((1 << int(lo)) - 1) for lo, hi in zip(_edges, _edges[1:])]
BUDGETS = [BITS * length // len(RING) for length in range(1, len(RING) + 1)]


def key_sets() -> list[tuple[int, int]]:
    """(start, mask of three segments that the budgets of a chain from this start leave equal)."""
    sets = []
    for start in range(len(RING)):
        for near in (1, 2):
            for far in range(near + 1, 5):
                at = {(start + step) % len(RING) for step in (0, near, far)}
                sets.append((start, sum(MASKS[i] for i in at)))
    return sets


KEYS = key_sets()


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: str | None) -> int:
    """SimHash over word shingles, repeats included; 0 for a text without words."""
    import xxhash

    words = text.encode("utf-8", "replace").lower().split() if text else []  # bytes: only A-Z lowered, ASCII blanks
    if not words:
        return 0
    shifted = [words[i:] for i in range(SHINGLE)] if len(words) >= SHINGLE else [[b" ".join(words)]]
    shingles = map(b" ".join, zip(*shifted))
    total, ones = len(shifted[-1]), np.zeros(64, np.int64)
    for begin in range(0, total, HASHED):
        n = min(HASHED, total - begin)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED, n)), np.uint64, n)
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > total).view(np.uint64)[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", mark: Column | None = None) -> DataFrame:
    """(``key``, fp), after it ``mark`` where given: the fingerprint as a signed long."""
    ship(df.sparkSession)
    if mark is not None:
        marked = df.select(F.col(key).alias("k"), mark.cast("bigint").alias("mark"), F.col(text).alias("t"))

        def compute_marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                fps = [_signed(fingerprint(value.as_py())) for value in batch.column(2)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64()), batch.column(1)], [key, "fp", "mark"])

        return marked.mapInArrow(compute_marked, f"`{key}` {df.schema[key].dataType.simpleString()}, fp bigint, mark bigint")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [_signed(fingerprint(value.as_py())) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], [key, "fp"])

    return df.select(key, text).mapInArrow(compute, f"`{key}` {df.schema[key].dataType.simpleString()}, fp bigint")


def within(one: np.uint64, others: np.ndarray, start: int) -> np.ndarray:
    """Positions of ``others`` whose chain from ``start`` keeps to its budgets, the last of which is the limit itself."""
    at = np.arange(len(others))
    differs = others ^ one
    total = np.zeros(len(others), np.uint8)
    for step, budget in enumerate(BUDGETS):
        mask = np.uint64(MASKS[(start + step) % len(RING)])
        total = total + np.bitwise_count(differs & mask)
        keep = total <= budget
        at, differs, total = at[keep], differs[keep], total[keep]
        if not len(at):
            break
    return at


def forest(fps: np.ndarray, start: int) -> list[tuple[int, int]]:
    """Links that connect what the chains from ``start`` connect; each fingerprint is reached once."""
    waiting, found, links = fps, [], []
    while found or len(waiting) > 1:
        if not found:
            found, waiting = [waiting[0]], waiting[1:]
        one = found.pop()
        at = within(one, waiting, start)
        if len(at):
            near = waiting[at]
            links.extend((int(one), int(other)) for other in near)
            found.extend(near)
            waiting = np.delete(waiting, at)
        if not len(waiting):
            break
    return links


def _unit_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by unit; a unit may cross batches and is kept until it is complete."""

    def links_of(columns: list[np.ndarray], begin: int, end: int) -> list[tuple[int, int]]:
        return forest(np.unique(columns[-1][begin:end]).view(np.uint64), KEYS[int(columns[0][begin])][0])

    def packed(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        flat = np.array(pairs, np.uint64).reshape(-1, 2).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["a", "b"])

    held: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            columns = [np.concatenate(pair) for pair in zip(held, columns)]
        changed = np.zeros(len(columns[0]) - 1, bool)
        for column in columns[:-1]:
            changed |= column[1:] != column[:-1]
        borders = [0, *(np.flatnonzero(changed) + 1).tolist()]
        pairs = [link for lo, hi in zip(borders, borders[1:]) if hi - lo > 1 for link in links_of(columns, lo, hi)]
        held = [column[borders[-1]:] for column in columns]
        if pairs:
            yield packed(pairs)
    if held is not None and len(held[0]) > 1:
        pairs = links_of(held, 0, len(held[0]))
        if pairs:
            yield packed(pairs)


def links(distinct: DataFrame, block: int = BLOCK) -> DataFrame:
    """(fp) without repeats → (a, b): links enough to connect all that is within the limit."""
    keyed = distinct.select("fp", F.posexplode(F.array(*[
        F.col("fp").bitwiseAND(F.lit(_signed(mask))) for _, mask in KEYS
    ])).alias("k", "bits")).select(F.col("k").cast("tinyint").alias("k"), "bits", "fp")
    shared = land(keyed.groupBy("k", "bits").count().where("count > 1"))
    last = (F.ceil(F.col("count") / F.lit(block)) - 1).cast("int")
    own = F.pmod(F.xxhash64("fp"), last + 1).cast("int")
    units = (
        keyed.join(shared, ["k", "bits"])
        .select("k", "bits", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), last)).alias("other"))
        .select("k", "bits", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")
    )
    dealt = units.repartition("k", "bits", "lo", "hi").sortWithinPartitions("k", "bits", "lo", "hi")
    return dealt.mapInArrow(_unit_links, "a bigint, b bigint")


def _groups(prints: DataFrame, key: str) -> DataFrame:
    """(fp, root, component_id): each fingerprint's component, by a fingerprint of it, and its least key."""
    classes = materialise(prints.groupBy("fp").agg(F.min(key).alias("first_key")))
    nodes = components(links(classes.select("fp"))).withColumnRenamed("node", "fp")
    named = classes.join(nodes, "fp")
    roots = named.groupBy("root").agg(F.min("first_key").alias("component_id"))
    linked = named.join(roots, "root").select(F.col("fp").alias("linked_fp"), "root", "component_id")
    alone = F.col("linked_fp").isNull()
    return classes.join(linked, F.col("fp") == F.col("linked_fp"), "left").select(
        "fp", F.when(alone, F.col("fp")).otherwise(F.col("root")).alias("root"),
        F.when(alone, F.col("first_key")).otherwise(F.col("component_id")).alias("component_id"),
    )


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``key``, fingerprint (16 hex digits), component_id (least key reachable over links).

    Null, empty and blank texts have fingerprint 0 and link like any other.  Repeated rows stay and
    share a component.  Rows with a null key get their component's least key, null where it has none.
    Other columns are ignored; an empty table gives an empty result.
    """
    prints = materialise(fingerprints(df, key, text))
    resolved = _groups(prints, key).select("fp", "component_id")
    return prints.join(resolved, "fp").select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
    )


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with one row of each group of near copies: the least key, then fingerprint, then hash of the text; null keys last.

    What goes or stays is a row's key together with its text, so a key that stands on several texts
    loses only the copies among them.  Rows that repeat both are one document and stay once.
    """
    # Texts travel under names of their own, so no column of the table can clash.
    names, spare = df.columns, [f"in_{i}" for i in range(len(df.columns))]
    rows = df.toDF(*spare)
    own, said = spare[names.index(key)], spare[names.index(text)]
    mark = F.xxhash64(F.coalesce(F.col(said).cast("string"), F.lit("")))
    prints = materialise(fingerprints(rows, own, said, mark).toDF("key", "fp", "mark"))
    identity = F.struct(F.col("key").isNull().alias("unnamed"), "key", "fp", "mark")
    # Equal fingerprints fold before components are joined: a hot text is one row there.
    best = prints.groupBy("fp").agg(F.min(identity).alias("least")).join(_groups(prints, "key").select("fp", "root"), "fp")
    kept = best.groupBy("root").agg(F.min("least").alias("least")).select("least.key", "least.mark")
    counted = land(prints.groupBy("key", "mark").agg(F.count("*").alias("n")).join(
        kept.select(F.col("key").alias("kept_key"), F.col("mark").alias("kept_mark")),
        F.col("key").eqNullSafe(F.col("kept_key")) & (F.col("mark") == F.col("kept_mark")), "left"))
    named = lambda part: part.select(F.col("key").alias("other_key"), F.col("mark").alias("other_mark"))
    same = F.col(own).eqNullSafe(F.col("other_key")) & (F.col("mark") == F.col("other_mark"))
    left = rows.withColumn("mark", mark).join(named(counted.where("kept_mark is null")), same, "left_anti")
    repeated = named(counted.where("kept_mark is not null and n > 1"))
    # Only rows that repeat key and text have to meet to become one.
    once = left.join(repeated, same, "left_anti").unionByName(left.join(repeated, same, "left_semi").dropDuplicates([own, "mark"]))
    return once.select(*[F.col(s).alias(n) for s, n in zip(spare, names)])
