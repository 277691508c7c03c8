"""Sharding by a permutation-filled lookup table.

Every shard has its own permutation of the slots of a prime-sized table.  Shards take turns; in its
turn a shard claims the first slot of its order that is still free, until all are taken.  No shard
then holds over one slot more than another, and adding or removing a shard moves few keys.
A row's slot is a hash of its key; the table gives the shard.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import hash48

SHARDS = 32
SLOTS = 3301  # a prime about a hundred times the shards keeps shares within 1 %


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:12], 16)


def fill(shards: list[str], slots: int) -> list[int]:
    """Owner (index into ``shards``) of each slot.  ``slots`` must be a prime above the number of shards."""
    if slots <= len(shards) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)) or not shards:
        raise ValueError("slots must be a prime number above the number of shards, of which there must be one or more")
    offset = [_number(f"offset:{name}") % slots for name in shards]
    skip = [_number(f"skip:{name}") % (slots - 1) + 1 for name in shards]
    step = [0] * len(shards)
    owner = [-1] * slots
    for turn in range(slots):
        shard = turn % len(shards)
        while True:
            slot = (offset[shard] + step[shard] * skip[shard]) % slots
            step[shard] += 1
            if owner[slot] < 0:
                owner[slot] = shard
                break
    return owner


def lookup_table(spark: SparkSession, shards: list[str], slots: int) -> DataFrame:
    """slot, shard: exactly ``slots`` rows, whatever the data."""
    names = F.array(*map(F.lit, shards))
    owners = ",".join(map(str, fill(shards, slots)))
    filled = F.split(F.lit(owners), ",").cast("array<int>")
    return spark.range(1).select(F.posexplode(filled).alias("slot", "_owner")).select(
        "slot", F.element_at(names, F.col("_owner") + 1).alias("shard")
    )


def shard_names(count: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(count)]


def place(df: DataFrame, key: str = "doc_id", shards: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """``df`` with columns slot and shard; input columns of these names are replaced.

    The same key always lands in the same shard; null keys go where the empty text goes.  The table
    is broadcast: its rows are ``slots``, a parameter.  Repeated rows stay; an empty table stays empty.
    """
    names = shards or shard_names(SHARDS)
    table = lookup_table(df.sparkSession, names, slots).withColumnRenamed("slot", "_slot").withColumnRenamed("shard", "_shard")
    kept = [F.col(c) for c in df.columns if c.lower() not in ("slot", "shard")]
    hashed = df.select(*kept, (hash48(key) % F.lit(slots)).cast("int").alias("_at"))
    return hashed.join(F.broadcast(table), F.col("_at") == F.col("_slot")).select(
        *kept, F.col("_slot").alias("slot"), F.col("_shard").alias("shard")
    )


def sql(shards: int = SHARDS, slots: int = SLOTS) -> str:
    """The same placement in SQL: turns as a recursion whose state is the list of taken slots."""
    return f"""
WITH RECURSIVE shard AS (
  SELECT i, 'shard-' || lpad(i::VARCHAR, 5, '0') AS name,
         ('0x' || substr(md5('offset:shard-' || lpad(i::VARCHAR, 5, '0')), 1, 12))::BIGINT % {slots} AS start,
         ('0x' || substr(md5('skip:shard-' || lpad(i::VARCHAR, 5, '0')), 1, 12))::BIGINT % {slots - 1} + 1 AS skip
  FROM range({shards}) r(i)
),
orders AS MATERIALIZED (
  SELECT i, list((start + j * skip) % {slots} ORDER BY j) AS pref FROM shard, range({slots}) p(j) GROUP BY i
),
turns(turn, slot, taken) AS (
  SELECT -1::BIGINT, -1::BIGINT, repeat('0', {slots})
  UNION ALL
  SELECT turn + 1, free, substr(taken, 1, free) || '1' || substr(taken, free + 2) FROM (
    SELECT t.turn, t.taken, list_filter(o.pref, lambda s: substr(t.taken, s + 1, 1) = '0')[1] AS free
    FROM turns t JOIN orders o ON o.i = (t.turn + 1) % {shards} WHERE t.turn + 1 < {slots})
)
SELECT d.doc_id, t.slot::INTEGER AS slot, s.name AS shard
FROM documents d
JOIN turns t ON t.turn >= 0 AND t.slot = ('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '')), 1, 12))::BIGINT % {slots}
JOIN shard s ON s.i = t.turn % {shards}
"""
