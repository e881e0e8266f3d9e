"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized table: it begins at an
offset and moves on by a step, both from a hash of its name. Shards take turns; each claims the
first slot in its order that is free, until none is. A document's hash gives a slot and the slot a
shard, so adding or removing a shard moves few documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Production setting: shards, and slots (a prime over a hundred times the shards).
SHARDS, SLOTS = 32, 4099


def _hash(text: Column, part: int) -> Column:
    """A 32-bit number from one part of a text's MD5, which any SQL engine gives alike."""
    return F.conv(F.substring(F.md5(text), 1 + 8 * part, 8), 16, 10).cast("long")


def lookup_table(spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``slot, shard`` for every slot, filled in one row of ``slots`` turns; no input enters it."""
    if slots < 2 or any(slots % k == 0 for k in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("the number of slots must be a prime")
    if not 1 <= shards <= slots:
        raise ValueError("there must be between one shard and as many as there are slots")
    name = lambda k: F.concat(F.lit("shard-"), k.cast("string"))
    numbers = F.sequence(F.lit(0), F.lit(shards - 1))
    kind = "struct<owner:array<int>,next:array<bigint>,offset:array<bigint>,step:array<bigint>>"
    start = F.struct(
        F.array_repeat(F.lit(-1), slots).alias("owner"),
        F.array_repeat(F.lit(0), shards).alias("next"),
        F.transform(numbers, lambda k: _hash(name(k), 0) % slots).alias("offset"),
        F.transform(numbers, lambda k: _hash(name(k), 1) % (slots - 1) + 1).alias("step")).cast(kind)

    def turn(state: Column, number: Column) -> Column:
        shard = number % shards
        wishes = F.transform(
            F.sequence(F.get(state["next"], shard), F.lit(slots - 1).cast("long")),
            lambda j: F.struct(j.alias("place"), (
                (F.get(state["offset"], shard) + j * F.get(state["step"], shard)) % slots
            ).cast("int").alias("slot")))
        free = F.filter(wishes, lambda wish: F.get(state["owner"], wish["slot"]) < 0)
        claimed = F.transform(F.array(F.get(free, F.lit(0))), lambda wish: F.struct(
            F.transform(state["owner"],
                        lambda x, i: F.when(i == wish["slot"], shard).otherwise(x)).alias("owner"),
            F.transform(state["next"],
                        lambda x, i: F.when(i == shard, wish["place"] + 1).otherwise(x)).alias("next"),
            state["offset"].alias("offset"), state["step"].alias("step")))
        return F.get(claimed, F.lit(0)).cast(kind)

    filled = F.aggregate(F.sequence(F.lit(0), F.lit(slots - 1)), start, turn, lambda s: s["owner"])
    return spark.range(1).select(F.posexplode(filled).alias("slot", "shard"))


def assign_shards(docs: DataFrame, id_col: str = "doc_id", shards: int = SHARDS,
                  slots: int = SLOTS) -> DataFrame:
    """``doc_id, slot, shard`` for every row, without a shuffle.

    Only the id is read. A null id is hashed as an empty string; rows with one id share a shard.
    The table is broadcast: it has ``slots`` rows whatever the input.
    """
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    placed = docs.select(F.col(id_col).alias("doc_id"), (_hash(key, 0) % slots).cast("int").alias("slot"))
    return placed.join(F.broadcast(lookup_table(docs.sparkSession, shards, slots)), "slot").select(
        "doc_id", "slot", "shard")


SQL = f"""
WITH RECURSIVE
orders AS (
  SELECT list(('0x' || substr(md5('shard-' || k), 1, 8))::BIGINT % {SLOTS} ORDER BY k) AS off,
         list(('0x' || substr(md5('shard-' || k), 9, 8))::BIGINT % {SLOTS - 1} + 1 ORDER BY k) AS step
  FROM range({SHARDS}) t(k)),
claims AS (
  SELECT 0 AS turn, -1::BIGINT AS slot, list_transform(range({SLOTS}), lambda x: -1) AS owner
  UNION ALL
  SELECT turn + 1, pick,
         list_transform(owner, lambda x, i: CASE WHEN i - 1 = pick THEN turn % {SHARDS} ELSE x END)
  FROM (
    SELECT turn, owner, list_extract(list_filter(
             list_transform(range({SLOTS}), lambda j: (off[turn % {SHARDS} + 1] + j * step[turn % {SHARDS} + 1]) % {SLOTS}),
             lambda s: owner[s + 1] < 0), 1) AS pick
    FROM claims, orders WHERE turn < {SLOTS})),
filled AS (SELECT owner FROM claims WHERE turn = {SLOTS}),
lookup AS (SELECT unnest(range({SLOTS})) AS slot, unnest(owner) AS shard FROM filled)
SELECT d.doc_id, l.slot::INTEGER AS slot, l.shard::INTEGER AS shard
FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % {SLOTS} AS slot
      FROM documents) d JOIN lookup l USING (slot)
"""
