"""Prefix trie over conversations by a splitter skeleton.

A conversation is a path: one digest per turn.  Paths are dealt into sorted ranges.  A node whose members
stand in two ranges is a prefix of the path at the border between them, so the prefixes of the borders
(the skeleton, as many paths as there are borders) are the only nodes that any range shares with
another.  Every range finishes all its other nodes in one pass over its sorted rows; for skeleton nodes
it hands on what it saw of them, and these partial aggregates are reduced by node.  The fold from the
skeleton's leaves to the root then has one row per skeleton node.

Ranges are cut by (path, conversation), so a path shared by a third of all conversations is cut like any
other; it only becomes part of the skeleton.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import land, ship
from ledgerlens.operators.stability import materialise, partition_count

WIDTH = 16  # bytes of a turn's digest
CHUNK = 4096  # conversation ids in one row of a skeleton node's list
FAMILY, LEAD = 5, 9

NODE, PARTIAL, IDS = range(3)
_OUT = pa.schema([
    ("kind", pa.int32()), ("skeleton", pa.int32()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
    ("ends_sha256", pa.string()), ("size", pa.int64()), ("ids", pa.string()),
])
_DDL = ("kind int, skeleton int, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
        "n_leaves bigint, saved_tokens bigint, ends_sha256 string, size bigint, ids string")
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
          near: Column | None = None) -> DataFrame:
    """(conv_id, near, turns): per conversation its turns in order as (digest, bytes of the text), null turns first.

    Null roles and texts are empty; rows without a conversation id belong to none.  Equal turn
    numbers follow their digests.  ``near`` deals conversations that will meet to one place.  A
    conversation is gathered in one row, 16 bytes and a length a turn.
    """
    said, who = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said).cast("binary"), 256)
    rows = df.select(
        F.col(key).cast("bigint").alias("conv_id"),
        F.struct(
            F.col(turn).isNotNull().alias("known"), F.coalesce(F.col(turn).cast("bigint"), F.lit(0)).alias("turn"),
            F.unhex(F.substring(digest, 1, 2 * WIDTH)).alias("digest"), F.octet_length(said).cast("bigint").alias("size"),
        ).alias("one"),
    ).where("conv_id is not null")
    rows = rows.select(F.col("conv_id") if near is None else near, "*").toDF("near", "conv_id", "one").repartition("near")
    return rows.groupBy("near", "conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))


def paths(sequences: DataFrame) -> DataFrame:
    """(conv_id, path, sizes) of (conv_id, turns)."""
    hexed = F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")
    return sequences.select("conv_id", F.unhex(hexed).alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes"))


def rebuilt(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Paths of conversations whose beginning comes from the first of their family of ``FAMILY`` ids.

    Conversation c has the first h turns of c − c % 5 (all if fewer, none if absent), then its own
    turns after its first h; h is the CRC-32 of its decimal id modulo ``LEAD``.
    """
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    own = turns(df, key, turn, role, text, family)
    lead = own.where("conv_id = near").select(F.col("near").alias("family"), F.slice("turns", 1, LEAD - 1).alias("lead"))
    joined = own.join(lead, F.col("near") == F.col("family"), "left").withColumn(
        "h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % LEAD).cast("int"))
    begin = F.when(F.col("lead").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("lead", F.lit(1), F.col("h")))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return paths(joined.select("conv_id", F.concat(begin, rest).alias("turns")))


def shared_turns(a: bytes, b: bytes) -> int:
    """Number of leading turns two paths share."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        middle = (low + high + 1) // 2
        if a[low * WIDTH:middle * WIDTH] == b[low * WIDTH:middle * WIDTH]:
            low = middle
        else:
            high = middle - 1
    return low


def skeleton(borders: list[tuple[bytes, bytes]]) -> list[bytes]:
    """The root and all prefixes that neighbouring ranges share; ``borders`` holds each range's least and greatest path, in order."""
    found = {b""}
    for (_, last), (first, _) in zip(borders, borders[1:]):
        found.update(first[:d * WIDTH] for d in range(1, shared_turns(last, first) + 1))
    return sorted(found)


class _Node:
    __slots__ = ("bone", "depth", "size", "least", "convs", "children", "leaves", "saved", "hash", "ids", "waiting")

    def __init__(self, bone: int | None, depth: int, size: int):
        self.bone, self.depth, self.size = bone, depth, size
        self.least, self.convs, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.hash = hashlib.sha256() if bone is None else None
        self.ids: list[int] = []  # a skeleton node's ends, until written
        self.waiting: list[list] = []  # finished children that need this node's least member

    def meet(self, least: int, convs: int) -> None:
        self.least = least if self.least is None else min(self.least, least)
        self.convs += convs


class RangeWalk:
    """One pass over the sorted paths of a range; memory: the open path and the children of its nodes."""

    def __init__(self, bones: dict[bytes, int]):
        self.bones, self.path, self.open, self.out = bones, b"", [], []

    def _ids(self, node: _Node) -> None:
        if node.ids:
            self.out.append([IDS, node.bone, node.ids[0], *[None] * 8, ",".join(map(str, node.ids))])
            node.ids = []

    def _close(self) -> None:
        node = self.open.pop()
        parent = self.open[-1] if self.open else None
        if parent:
            parent.meet(node.least, node.convs)
        if node.bone is not None:
            self._ids(node)
            self.out.append([PARTIAL, node.bone, node.least, node.depth, None, node.convs, node.children, node.leaves, node.saved,
                             None, node.size, None])
            return
        leaves, saved = max(node.leaves, 1), node.saved + (node.convs - 1) * node.size
        for row in node.waiting:
            row[4] = node.least
            self.out.append(row)
        row = [NODE, parent.bone, node.least, node.depth, None, node.convs, node.children, leaves, saved, node.hash.hexdigest(), None, None]
        parent.children, parent.leaves, parent.saved = parent.children + 1, parent.leaves + leaves, parent.saved + saved
        (self.out if parent.bone is not None else parent.waiting).append(row)

    def add(self, path: bytes, conv: int, sizes) -> None:
        if not self.open:
            self.open.append(_Node(self.bones[b""], 0, 0))
        same = shared_turns(self.path, path)
        while len(self.open) > same + 1:
            self._close()
        for depth in range(same + 1, len(path) // WIDTH + 1):
            bone = self.bones.get(path[:depth * WIDTH]) if self.open[-1].bone is not None else None
            self.open.append(_Node(bone, depth, sizes[depth - 1]))
        node, self.path = self.open[-1], path
        if node.bone is None:
            node.hash.update(f"{',' if node.least is not None else ''}{conv}".encode())
        else:
            node.ids.append(conv)
            if len(node.ids) >= CHUNK:
                self._ids(node)
        node.meet(conv, 1)

    def finish(self) -> None:
        while self.open:
            self._close()

    def rows(self) -> pa.RecordBatch:
        out, self.out = self.out, []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _OUT)], _OUT.names)


def _fold(bones: list[bytes], partial: dict, hashes: dict) -> list[tuple]:
    """(skeleton, the columns of a node) per skeleton node, from the leaves to the root."""
    place, below = {p: i for i, p in enumerate(bones)}, {}
    empty, rows = hashlib.sha256().hexdigest(), []
    for path in sorted(bones, key=len, reverse=True):
        i = place[path]
        if i not in partial:
            continue  # the root of an empty table
        seen = partial[i]
        children, leaves, saved = (a + b for a, b in zip((seen["children"], seen["leaves"], seen["saved"]), below.get(i, (0, 0, 0))))
        leaves, saved = (leaves if children else 1), saved + (seen["convs"] - 1) * seen["size"]
        parent = None
        if path:
            up = place[path[:-WIDTH]]
            parent = partial[up]["least"]
            below[up] = tuple(a + b for a, b in zip(below.get(up, (0, 0, 0)), (1, leaves, saved)))
        rows.append((i, seen["least"], len(path) // WIDTH, parent, seen["convs"], children, leaves, saved, hashes.get(i, empty)))
    return rows


def trie(sequences: DataFrame) -> DataFrame:
    """Nodes of the trie of (conv_id, path, sizes), ``conv_id`` unique: the columns ``COLUMNS``.

    A node's ``conv_id`` is its least member, ``ends_sha256`` the digest of the ascending ids that end
    at it.  An empty path ends at the root.  No rows give no nodes, not even a root.
    """
    spark = sequences.sparkSession
    ship(spark)
    order = ["path", "conv_id"]
    placed = materialise(
        land(sequences).repartitionByRange(partition_count(spark), *order).sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("range")))
    # Two paths per range, whatever the number of conversations.
    borders = sorted(tuple(r) for r in placed.groupBy("range").agg(F.min("path"), F.max("path")).collect())
    bones = skeleton([(bytes(a), bytes(b)) for _, a, b in borders])
    shared = spark.sparkContext.broadcast({path: i for i, path in enumerate(bones)})

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = RangeWalk(shared.value)
        for batch in batches:
            for conv, path, sizes in zip(*(batch.column(i).to_pylist() for i in range(3))):
                one.add(path, conv, sizes)
                if len(one.out) > 20_000:
                    yield one.rows()
        one.finish()
        if one.out:
            yield one.rows()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bone, digest = None, None
        done: list[tuple[int, str]] = []
        for batch in batches:
            for this, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if this == bone:
                    digest.update(b",")
                elif bone is not None:
                    done.append((bone, digest.hexdigest()))
                if this != bone:
                    bone, digest = this, hashlib.sha256()
                digest.update(ids.encode())
        if bone is not None:
            done.append((bone, digest.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in done], pa.int32()), pa.array([h for _, h in done], pa.string())], ["bone", "sha"])

    walked = land(placed.select("conv_id", "path", "sizes").mapInArrow(walk, _DDL))
    # One row per skeleton node from here on; a node's list of ends is hashed as a stream, in order.
    partial = {r["skeleton"]: r for r in walked.where(F.col("kind") == PARTIAL).groupBy("skeleton").agg(
        F.min("conv_id").alias("least"), F.sum("n_convs").alias("convs"), F.sum("n_children").alias("children"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.max("size").alias("size")).collect()}
    ends = walked.where(F.col("kind") == IDS).select("skeleton", "ids", "conv_id").repartition("skeleton")
    hashes = dict(tuple(r) for r in ends.sortWithinPartitions("skeleton", "conv_id").mapInArrow(hashed, "bone int, sha string").collect())
    types = "bone int, " + ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'bigint'}" for c in COLUMNS)
    top = spark.createDataFrame(_fold(bones, partial, hashes), types)
    least = F.broadcast(top.select("bone", F.col("conv_id").alias("up")))
    finished = walked.where(F.col("kind") == NODE).join(least, F.col("skeleton") == F.col("bone"), "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "up"))
    return finished.select(*COLUMNS).unionByName(top.select(*COLUMNS))


def sql() -> str:
    """The trie of rebuilt conversations in SQL: all prefixes, and every node against every node."""
    step = "CASE WHEN acc & 1 = 1 THEN xor(acc >> 1, 3988292384::UBIGINT) ELSE acc >> 1 END"
    return f"""
WITH crc AS MATERIALIZED (
 SELECT list(list_reduce(list_concat([b::UBIGINT], list_transform(range(8), lambda i: 0::UBIGINT)), lambda acc, i: {step}) ORDER BY b) AS t
 FROM (SELECT unnest(range(256)) AS b)),
said AS (
 SELECT conv_id, turn, coalesce(text, '') AS text, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS m
 FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({{'m': m, 'n': strlen(text)}} ORDER BY turn NULLS FIRST, m) AS s FROM said GROUP BY conv_id),
crcs AS MATERIALIZED (
 SELECT conv_id, s, CAST(xor(list_reduce(
   list_concat([4294967295::UBIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
   lambda acc, c: xor(acc >> 8, t[((xor(acc, c) & 255) + 1)::BIGINT])), 4294967295::UBIGINT) % {LEAD} AS BIGINT) AS h
 FROM own, crc),
built AS MATERIALIZED (
 SELECT a.conv_id, list_concat(coalesce(list_slice(b.s, 1, a.h), []), list_slice(a.s, a.h + 1, len(a.s))) AS s
 FROM crcs a LEFT JOIN crcs b ON b.conv_id = a.conv_id - a.conv_id % {FAMILY}),
prefixes AS (
 SELECT conv_id, d, len(s) AS n, list_aggregate(list_transform(list_slice(s, 1, d), lambda x: x.m), 'string_agg', '') AS k,
  CASE WHEN d > 0 THEN s[d].n ELSE 0 END AS size
 FROM (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM built)),
node AS MATERIALIZED (
 SELECT d, coalesce(k, '') AS k, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
 FROM prefixes GROUP BY d, coalesce(k, '')),
kids AS MATERIALIZED (SELECT p.d, p.k, count(c.k) AS n FROM node p LEFT JOIN node c ON c.d = p.d + 1 AND starts_with(c.k, p.k) GROUP BY ALL)
SELECT x.conv_id, x.d AS depth, up.conv_id AS parent_conv_id, x.n_convs, kids.n AS n_children,
 b.leaves AS n_leaves, b.saved AS saved_tokens, x.ends_sha256
FROM node x JOIN kids ON kids.d = x.d AND kids.k = x.k
LEFT JOIN node up ON up.d = x.d - 1 AND up.k = substr(x.k, 1, 32 * (x.d - 1))
JOIN (SELECT t.d, t.k, CAST(sum(s.saved) AS BIGINT) AS saved, count(*) FILTER (c.n = 0) AS leaves
 FROM node t JOIN node s ON s.d >= t.d AND starts_with(s.k, t.k) JOIN kids c ON c.d = s.d AND c.k = s.k GROUP BY ALL) b ON b.d = x.d AND b.k = x.k"""
