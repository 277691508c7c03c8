"""Vector code compression by Ball k-means over whole-number components.

A vector is cut into equal parts; the parts of one position share a codebook.  An entry and the parts
assigned to it form a ball.  Its radius, the distance of its farthest part, defines its neighbours: the
entries at most two radii away.  Parts nearer to their entry than half the way to the nearest neighbour
are the ball's stable core and skip all work; outside it lie rings, one per neighbour in order of
distance, and a part is compared only with the neighbours whose rings reach it.  All comparisons are of
whole numbers, so nothing is rounded and ties are exact.

Rows travel as blocks (one row of a block table holds some thousand vectors).  A round reads the blocks,
moves parts between balls and writes the blocks with their new codes and sums beside them; what comes
back to the driver is one number per component of the codebooks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import discard, land_at, ship

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
BLOCK = 1 << 20  # components of a block
LIMIT = 1 << 62  # larger whole numbers are held at this


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """floor(SCALE · x)."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values.astype(np.float64) * SCALE)
    return np.clip(scaled, -float(LIMIT), float(LIMIT)).astype(np.int64)


def _exact(bound: int, width: int):
    """The fastest number type in which squared distances of components up to ``bound`` are exact."""
    largest = max(1, width) * (2 * bound) ** 2 * 4
    return np.float64 if largest < 1 << 53 else np.int64 if largest < 1 << 63 else object


def reassign(parts: np.ndarray, entries: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest entry, its squared distance, distances computed) for parts that ``own`` assigns to entries; ties to the lower index."""
    bound = max((int(np.abs(a).max()) for a in (parts, entries) if a.size), default=0)
    kind = _exact(bound, parts.shape[1])
    x, c = parts.astype(kind), entries.astype(kind)
    gaps = ((c[:, None] - c[None]) ** 2).sum(axis=2)
    best, distance = own.copy(), ((x - c[own]) ** 2).sum(axis=1)
    computed = len(x)
    for entry in np.unique(own):
        members = np.flatnonzero(own == entry)
        members = members[np.argsort(distance[members], kind="stable")]  # from the core outwards
        fourfold = 4 * distance[members]
        others = np.argsort(gaps[entry], kind="stable")
        others = others[(others != entry) & (gaps[entry][others] <= fourfold[-1])]  # the ball's neighbours
        # Where the ring of each neighbour begins: an entry farther than twice the part's distance cannot be nearer.
        begins = np.searchsorted(fourfold, gaps[entry][others], side="left")
        for other, begin in zip(others, begins):
            ring = members[begin:]
            other_distance = ((x[ring] - c[other]) ** 2).sum(axis=1)
            computed += len(ring)
            nearer = (other_distance < distance[ring]) | ((other_distance == distance[ring]) & (other < best[ring]))
            best[ring[nearer]], distance[ring[nearer]] = other, other_distance[nearer]
    return best, distance, computed


def totals(parts: np.ndarray, own: np.ndarray, entries: int) -> list[int]:
    """Per entry the sum of its parts' components, entry after entry."""
    width = parts.shape[1]
    if parts.size and int(np.abs(parts).max()) * len(parts) < 1 << 53:
        columns = [np.bincount(own, parts[:, j].astype(np.float64), entries) for j in range(width)]
        return [int(v) for v in np.stack(columns, axis=1).ravel()]
    sums = np.zeros((entries, width), object)
    np.add.at(sums, own, parts.astype(object))
    return sums.ravel().tolist()


@dataclass(frozen=True)
class Codes:
    """``rows``: vec_id, label, code, error; ``codebooks``: one matrix of whole numbers per position; ``computed``: distances per assignment."""

    rows: DataFrame
    codebooks: list[np.ndarray]
    computed: list[int]

    def digest(self) -> str:
        """SHA-256 of all components by position, entry and place, comma-joined."""
        return hashlib.sha256(",".join(str(int(v)) for book in self.codebooks for v in book.ravel()).encode()).hexdigest()


def _kept(df: DataFrame, key: str, vector: str, label: str | None) -> DataFrame:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    named: Column = F.lit(None).cast("int") if label is None else F.col(label)
    return (
        df.select(F.col(key).cast("bigint").alias("vec_id"), named.alias("label"), F.col(vector).cast("array<double>").alias("v"))
        .where(F.col("v").isNotNull() & F.forall("v", finite))
    )


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as whole numbers, extended to ``width``."""
    flat, lengths = vectors.flatten().to_numpy(zero_copy_only=False), vectors.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return whole_numbers(flat).reshape(-1, width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return whole_numbers(out)


def _schema(label_type: str) -> str:
    return f"ids array<bigint>, labels array<{label_type}>, raw binary, codes binary, sums array<decimal(38,0)>, counts array<bigint>, computed bigint"


def _lists(column: pa.Array) -> pa.ListArray:
    """A column as one list."""
    return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)


def _moved(raw: np.ndarray, codes: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """New codes, squared distances per part, and the distances computed."""
    found, distances, computed = np.empty_like(codes), [], 0
    for p, book in enumerate(books):
        own, distance, n = reassign(raw[:, p * book.shape[1]:(p + 1) * book.shape[1]], book, codes[:, p].astype(np.int64))
        found[:, p] = own
        distances.append(distance)
        computed += n
    return found, np.stack(distances, axis=1), computed


def compress(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str | None = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS) -> Codes:
    """Codes of all vectors, after ``rounds`` rounds over codebooks that start as the parts of the least ids.

    Rows whose vector is null or holds null or non-finite components take no part; zero and empty
    vectors do.  Shorter vectors are extended by zeros to the longest length, rounded up to a
    multiple of ``parts``.  Whole numbers beyond ±2^62 are held there, errors beyond a long at its
    maximum.  Equal ids start in order of their vectors, null ids come last; repeated rows stay
    repeated.  With fewer rows than ``entries`` there are as many entries as rows.  Other columns
    are ignored; an empty table gives no rows.  The codebooks (``entries`` times the length) are
    what the driver and every task hold.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    spark = df.sparkSession
    ship(spark)
    rows = _kept(df, key, vector, label)
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    width = max(1, -(-longest // parts)) * parts
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").toArrow()["v"].combine_chunks()
    start = _matrix(first, width)
    books = [start[:, p * (width // parts):(p + 1) * (width // parts)] for p in range(parts)]
    label_type = rows.schema["label"].dataType.simpleString()
    schema = _schema(label_type)
    names = [field.split(" ")[0] for field in schema.split(", ")]

    def block(ids, labels, raw: np.ndarray, codes: np.ndarray, sums: list[int], counts: list[int], computed: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [_lists(ids), _lists(labels), pa.array([raw.tobytes()], pa.binary()), pa.array([codes.tobytes()], pa.binary()),
             pa.array([sums], pa.list_(pa.decimal128(38, 0))), pa.array([counts], pa.list_(pa.int64())), pa.array([computed], pa.int64())],
            names)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, BLOCK // width)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                ids, labels, vectors = (batch.column(i).slice(at, step) for i in range(3))
                raw = _matrix(vectors, width)
                yield block(ids, labels, raw, np.zeros((len(raw), parts), np.uint8), [], [], 0)

    def opened(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels = batch.column(0)[i].values, batch.column(1)[i].values
                raw = np.frombuffer(batch.column(2)[i].as_buffer(), np.int64).reshape(-1, width)
                yield ids, labels, raw, np.frombuffer(batch.column(3)[i].as_buffer(), np.uint8).reshape(-1, parts)

    def turn(current: list[np.ndarray]):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, labels, raw, codes in opened(batches):
                codes, _, computed = _moved(raw, codes, current)
                sums, counts = [], []
                for p, book in enumerate(current):
                    n = book.shape[1]
                    sums += totals(raw[:, p * n:(p + 1) * n], codes[:, p].astype(np.int64), len(book))
                    counts += np.bincount(codes[:, p], minlength=len(book)).tolist()
                yield block(ids, labels, raw, codes, sums, counts, computed)
        return work

    def last(current: list[np.ndarray]):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, labels, raw, codes in opened(batches):
                codes, distances, _ = _moved(raw, codes, current)
                text = codes.tobytes().hex()
                errors = [min(sum(map(int, one)), (1 << 63) - 1) for one in distances]
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array([text[2 * parts * i:2 * parts * (i + 1)] for i in range(len(codes))], pa.string()),
                     pa.array(errors, pa.int64())], ["vec_id", "label", "code", "error"])
        return work

    state, path = land_at(rows.mapInArrow(gather, schema))
    computed = []
    if len(start):
        for _ in range(rounds):
            moved, moved_path = land_at(state.mapInArrow(turn(books), schema))
            discard(spark, path)  # the new state needs nothing of it
            state, path = moved, moved_path
            books = _updated(state, books)
            computed.append(state.agg(F.sum("computed")).first()[0])
    coded, _ = land_at(state.mapInArrow(last(books), f"vec_id bigint, label {label_type}, code string, error bigint"))
    discard(spark, path)
    return Codes(coded, books, computed)


def _updated(state: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Entries become the floor of their parts' mean; an entry without parts stays."""
    add = lambda column: {
        r["pos"]: int(r["s"]) for r in state.select(F.posexplode(column)).groupBy("pos").agg(F.sum("col").alias("s")).collect()}
    sums, counts = add("sums"), add("counts")  # one row per component and per entry of the codebooks
    out, at, entry = [], 0, 0
    for book in books:
        new = book.copy()
        for row in new:
            if counts[entry]:
                row[:] = [sums[at + j] // counts[entry] for j in range(len(row))]
            at, entry = at + len(row), entry + 1
        out.append(new)
    return out


def code_digest(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of :func:`compress`."""
    codes = compress(df, key, vector, label)
    longest = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    by_label = codes.rows.groupBy(F.col("label").alias("of")).agg(
        F.least(F.sum(F.col("error").cast("decimal(20,0)")).cast("decimal(38,0)"), longest).cast("bigint").alias("label_error"))
    return codes.rows.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256"))


def sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The digest of a table of equally long vectors in SQL: every part against every entry, round by round."""
    steps = [f"""kept AS (
 SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
piece AS MATERIALIZED (
 SELECT vec_id, label, p, list_slice(v, p * len(v) // {parts} + 1, (p + 1) * len(v) // {parts}) AS v
 FROM kept, (SELECT unnest(range({parts})) AS p)),
book0 AS MATERIALIZED (
 SELECT p, e, v AS c FROM (SELECT p, v, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM piece) WHERE e < {entries})"""]
    distance = "list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
 SELECT vec_id, label, p, v, min({{'d': CAST(d AS BIGINT), 'e': e}}) AS best
 FROM (SELECT vec_id, label, piece.p, v, e, {distance} AS d FROM piece JOIN book{r} ON piece.p = book{r}.p) GROUP BY ALL)""")
        if r < rounds:
            steps.append(f"""book{r + 1} AS MATERIALIZED (
 SELECT p, e, coalesce(m, c) AS c FROM book{r} LEFT JOIN (
  SELECT p AS mp, e AS me, list(m ORDER BY j) AS m FROM (
   SELECT p, e, j, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS m
   FROM (SELECT p, best.e AS e, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM near{r}) GROUP BY p, e, j) GROUP BY p, e)
 ON p = mp AND e = me)""")
    steps.append(f"""coded AS MATERIALIZED (
 SELECT vec_id, label, string_agg(format('{{:02x}}', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
 FROM near{rounds} GROUP BY vec_id, label),
digest AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, j)) AS codebooks_sha256
 FROM (SELECT p, e, unnest(c) AS x, generate_subscripts(c, 1) AS j FROM book{rounds}))""")
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, digest"""
