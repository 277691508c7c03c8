"""Approximate nearest neighbours by cross-polytope hashing.

A table turns unit vectors by a pseudo-rotation (three rounds of random signs and a Hadamard
transform) and assigns each to the nearest of the 2·d signed axes.  A query probes its nearest axes in
every table; what lies there is scored exactly against it.  Signed axes are taken in groups of
``GROUP``, so that a query meets a group's vectors once, with a mask of the axes it probes.

Axes tell directions, nearness is the inner product.  So the vectors of one length are hashed in bands
of similar norms, each against all queries.  A query probes its axes in order of closeness, down to a
share of them, and further where a band is so thin that fewer than ``CANDIDATES`` entries are to be
expected; thin bands are thus met whole, on the same path.  A query that still comes short, because
its axes lie empty, is scored against its whole class.

Equal vectors are folded into one entry with its least ids (as many as an answer can need), so one
vector held by a third of the rows is one candidate and one query.  A group of axes is dealt in
blocks of vectors and blocks of queries by counted size; the unit of work is a pair of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import ship
from ledgerlens.operators.stability import materialise

TABLES = 4
PROBES = 0.24  # share of the signed axes a query probes in a table, at least
CANDIDATES = 1000  # entries of a band that a query's probes should reach in a table, at least
GROUP = 16
NORM_STEPS = 8  # norms are counted in steps of 2^(1/8)
BAND_STEPS, BANDS = 4, 8  # bands above the middle norm: each 2^(1/2) wide, the last open; all shorter vectors are one
OPEN = -1  # stands for a table, and a band, that every query of a class visits whole
BLOCK = 4096  # vectors of a group in a unit
QUERY_BLOCK = 2048
SEED = 20240


def rotate(vectors: np.ndarray, table: int) -> np.ndarray:
    """Pseudo-rotation of the rows, padded to a power of two."""
    width = 1 << max(0, (vectors.shape[1] - 1).bit_length())
    out = np.zeros((len(vectors), width))
    out[:, : vectors.shape[1]] = vectors
    rng = np.random.default_rng((SEED, table, width))
    for _ in range(3):
        out = out * rng.choice((-1.0, 1.0), width)
        half = 1
        while half < width:
            pairs = out.reshape(len(out), -1, 2, half)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(out), width)
            half *= 2
        out = out / math.sqrt(width)
    return out


def signed_axes(rotated: np.ndarray) -> np.ndarray:
    """Closeness to the axes e1, −e1, e2, −e2, …"""
    return np.stack([rotated, -rotated], axis=2).reshape(len(rotated), -1)


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v) without repeated rows: ids with vectors that are not null, empty, zero, or with null or non-finite parts."""
    v = F.col("v")
    return (
        df.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
        .where("vec_id is not null and size(v) > 0")
        .where(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
        .select("vec_id", F.transform(v, lambda x: x + F.lit(0.0)).alias("v"))  # -0.0 becomes 0.0
        .distinct()
    )


_PLACE = "size int, band int, t int, g int, b int, id bigint, raw binary"


def _rows(size, band, table, group, value, ids, raw) -> pa.RecordBatch:
    n = len(ids)
    whole = lambda v: pa.array(np.broadcast_to(v, n).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [whole(size), whole(band), whole(table), whole(group), whole(value), pa.array(ids, pa.int64()), pa.array(raw, pa.binary())],
        [field.split(" ")[0] for field in _PLACE.split(", ")])


def _by_length(batch: pa.RecordBatch):
    """(length, rows of it, ids, vectors, vectors as bytes) of a batch (id, v, size, …)."""
    ids, sizes, raw = batch.column(0).to_numpy(), batch.column(2).to_numpy(), batch.column(1).to_pylist()
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        vectors = np.array([raw[i] for i in rows], np.float64)
        yield size, rows, ids[rows], vectors, [one.tobytes() for one in vectors]


def _closeness(vectors: np.ndarray, tables: int) -> Iterator[np.ndarray]:
    """Per table the closeness to the signed axes; scaled by the largest part first, so that no norm overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    for table in range(tables):
        yield signed_axes(rotate(unit, table))


def _placed(entries: DataFrame, tables: int) -> DataFrame:
    """Where entries (id, v, size, band) lie: one axis in every table."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands = batch.column(3).to_numpy()
            for size, rows, ids, vectors, packed in _by_length(batch):
                for table, near in enumerate(_closeness(vectors, tables)):
                    best = near.argmax(axis=1)
                    yield _rows(size, bands[rows], table, best // GROUP, best % GROUP, ids, packed)

    return entries.select("id", "v", "size", "band").mapInArrow(place, _PLACE)


def _visits(questions: DataFrame, tables: int, probes: float, least: int) -> DataFrame:
    """Groups that queries (id, v, size, bands) visit, b a mask of the axes probed there; ``bands`` tells band and size of all bands of their length."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands = batch.column(3).to_pylist()
            for size, rows, ids, vectors, packed in _by_length(batch):
                for table, near in enumerate(_closeness(vectors, tables)):
                    axes = near.shape[1]
                    order = np.argsort(-near, axis=1, kind="stable")
                    for band in bands[rows[0]]:
                        depth = min(axes, max(1, math.ceil(max(probes, least / band["n"]) * axes)))
                        visited = np.zeros((len(rows), -(-axes // GROUP) * GROUP), bool)
                        np.put_along_axis(visited, order[:, :depth], True, 1)
                        masks = visited.reshape(len(rows), -1, GROUP) @ (1 << np.arange(GROUP))
                        entry, group = np.nonzero(masks)
                        yield _rows(size, band["band"], table, group, masks[entry, group], ids[entry], [packed[i] for i in entry])

    return questions.select("id", "v", "size", "bands").mapInArrow(place, _PLACE)


def _whole(rows: DataFrame, asking: bool) -> DataFrame:
    """All rows (id, v, size) in, or all queries at, the one open group of their length."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, _, ids, _, packed in _by_length(batch):
                yield _rows(size, OPEN, OPEN, 0, int(asking), ids, packed)

    return rows.select("id", "v", "size").mapInArrow(place, _PLACE)


def _best(queries: np.ndarray, masks: np.ndarray, have: np.ndarray, axis: np.ndarray, ids: np.ndarray, k: int):
    """(query, entry, score) of each query's ``k`` best entries among those it probes, ties to the least id.

    Products by matrix multiplication only preselect: all entries within their rounding error of the
    k-th stay and are summed again in one fixed order.  A product that is not a number ranks last.
    """
    lowest = -np.finfo(np.float64).max
    with np.errstate(all="ignore"):
        rough = queries @ have.T
        rough = np.where(masks[:, None] >> axis[None, :] & 1, np.where(np.isnan(rough), lowest, np.maximum(rough, lowest)), -np.inf)
        if k < len(ids):
            kth = -np.partition(-rough, k - 1, axis=1)[:, k - 1]
            slack = 4 * (have.shape[1] + 2) * np.finfo(np.float64).eps * (np.abs(queries).sum(axis=1) * np.abs(have).max())
            border = np.where(np.isfinite(kth) & np.isfinite(slack), kth - slack, lowest)
            at, entry = np.nonzero((rough > -np.inf) & (rough >= border[:, None]))
        else:
            at, entry = np.nonzero(rough > -np.inf)
        # One order of summation for every pair: equal vectors get equal scores wherever they are met.
        exact = (have[entry] * queries[at]).sum(axis=1)
    exact = np.where(np.isnan(exact), lowest, exact)
    order = np.lexsort((ids[entry], -exact, at))
    at, entry, exact = at[order], entry[order], exact[order]
    first = np.searchsorted(at, at, side="left")
    kept = np.arange(len(at)) - first < k
    return at[kept], entry[kept], exact[kept]


def _score_unit(k: int):
    def score(entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"qid": [], "vid": [], "score": []}).astype({"qid": "int64", "vid": "int64", "score": "float64"})]
        if len(entries) and len(queries):
            have = np.frombuffer(b"".join(entries["raw"]), np.float64).reshape(len(entries), -1)
            want = np.frombuffer(b"".join(queries["raw"]), np.float64).reshape(len(queries), -1)
            axis, ids, names, masks = entries["b"].to_numpy(), entries["id"].to_numpy(), queries["id"].to_numpy(), queries["b"].to_numpy()
            for begin in range(0, len(queries), 256):
                part = slice(begin, begin + 256)
                at, entry, exact = _best(want[part], masks[part], have, axis, ids, k)
                out.append(pd.DataFrame({"qid": names[part][at], "vid": ids[entry], "score": exact}))
        return pd.concat(out)

    return score


def _middles(entries: DataFrame) -> DataFrame:
    """(size, middle): per length the step of the middle norm."""
    steps = entries.groupBy("size", "step").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("size")  # as many rows as steps: bounded by the range of doubles
    running = steps.withColumn("upto", F.sum("n").over(whole.orderBy("step"))).withColumn("n", F.sum("n").over(whole))
    return running.where(2 * F.col("upto") >= F.col("n")).groupBy("size").agg(F.min("step").alias("middle"))


def _scored(placed: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """(qid, vid, score, n): the ``k`` best entries that a query met, of those with equal scores the least ids."""
    unit = ["size", "band", "t", "g"]
    # One row per band, table and group of axes: bounded by the parameters and the length of vectors.
    loads = materialise(
        placed.groupBy(*unit).agg(F.count("*").alias("n")).join(visits.groupBy(*unit).agg(F.count("*").alias("m")), unit)
        .select(*unit, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("m") / QUERY_BLOCK).cast("int").alias("qblocks"))
    )
    spread = lambda own, other: F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(own)
    left = placed.join(F.broadcast(loads), unit).select(
        *unit, F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), spread("qblock", "qblocks"), "b", "id", "raw")
    right = visits.join(F.broadcast(loads), unit).select(
        *unit, spread("block", "blocks"), F.pmod(F.xxhash64("id"), F.col("qblocks")).cast("int").alias("qblock"), "b", "id", "raw")
    where = [*unit, "block", "qblock"]
    scored = left.groupBy(*where).cogroup(right.groupBy(*where)).applyInPandas(_score_unit(k), "qid bigint, vid bigint, score double")
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "vid")
    return scored.groupBy("qid", "vid").agg(F.first("score").alias("score")).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k)


def nearest(df: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = 20,
            tables: int = TABLES, probes: float = PROBES, candidates: int = CANDIDATES) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products found for rows whose id is divisible by ``every``.

    Vectors that are null, empty, zero, or hold null or non-finite parts take no part, nor do rows
    without an id; vectors of different lengths never meet.  Rows that repeat id and vector count
    once.  Ties go to the smaller id.  A query never finds its own id.  Other columns are ignored;
    an empty table gives no rows.  A query gets ``k`` rows, or all candidates if they are fewer.
    Products beyond the range of doubles are infinite; those that are no number come last, as the
    lowest double.  ``probes=1`` is the exact way: every query meets every vector of its length.
    """
    spark = df.sparkSession
    ship(spark)
    rows = materialise(usable(df, key, vector))
    by_vector = Window.partitionBy("v").orderBy("vec_id")
    # k + 1 ids of a vector: an answer needs k, one of which may be the query itself.
    least = rows.withColumn("n", F.row_number().over(by_vector)).where(F.col("n") <= k + 1)
    part = F.array_max(F.transform("v", F.abs))
    squares = F.aggregate("v", F.lit(0.0), lambda sum_, x: sum_ + (x / F.col("part")) * (x / F.col("part")))
    folded = (
        least.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("part", part)
        .select(F.element_at("ids", 1).alias("id"), "v", "ids", F.size("v").alias("size"),
                F.floor((F.log2("part") + F.log2(squares) / 2) * NORM_STEPS).alias("step"))
    )
    folded = materialise(folded)
    # Bands of similar norms above the middle one; the few steps of a band hold norms within a factor of 2^(1/2).
    band = F.least(F.greatest(F.floor((F.col("step") - F.col("middle")) / BAND_STEPS), F.lit(0)), F.lit(BANDS - 1)).cast("int")
    entries = materialise(folded.join(F.broadcast(_middles(folded)), "size").select("id", "v", "ids", "size", band.alias("band")))
    counted = entries.groupBy("size", "band").agg(F.count("*").alias("n"), F.sum(F.size("ids")).alias("n_ids"))
    # One row per length of vectors, with at most BANDS bands in it.
    classes = materialise(counted.groupBy("size").agg(
        F.sort_array(F.collect_list(F.struct("band", "n"))).alias("bands"), F.sum("n_ids").alias("n_ids")))
    asked = rows.where(F.col("vec_id") % every == 0)
    questions = materialise(
        asked.groupBy("v").agg(F.min("vec_id").alias("id")).withColumn("size", F.size("v")).join(classes, "size")
        .select("id", "v", "size", "bands", F.least(F.lit(k + 1), "n_ids").alias("due")))
    found = materialise(_scored(_placed(entries, tables), _visits(questions, tables, probes, candidates), k + 1))
    met = found.join(entries.select(F.col("id").alias("vid"), F.size("ids").alias("m")), "vid").groupBy("qid").agg(F.sum("m").alias("met"))
    short = materialise(
        questions.join(met, F.col("id") == F.col("qid"), "left").where(F.coalesce("met", F.lit(0)) < F.col("due")).select("id", "v", "size"))
    if not short.isEmpty():
        every_entry = entries.join(short.select("size").distinct(), "size", "left_semi")
        again = _scored(_whole(every_entry, False), _whole(short, True), k + 1)
        found = found.join(short.select(F.col("id").alias("qid")), "qid", "left_anti").unionByName(again)
    named = found.join(entries.select(F.col("id").alias("vid"), "ids"), "vid").select("qid", "score", F.explode("ids").alias("vec_id"))
    nearest_ids = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    answers = named.withColumn("n", F.row_number().over(nearest_ids)).where(F.col("n") <= k + 1).drop("n")
    askers = asked.join(questions.select(F.col("id").alias("qid"), "v"), "v").select(F.col("vec_id").alias("query_id"), "qid")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        askers.join(answers, "qid").where("vec_id <> query_id").withColumn("rank", F.row_number().over(own).cast("int"))
        .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
