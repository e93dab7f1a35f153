"""Sharding by fixed virtual slots.

Records are hashed into thousands of slots that never change. Bytes and rows are counted for each slot, a table maps
slots to shards, and rebalancing edits that table only: records keep their slot. Every edit is a new version of the
map. Main path: DataFrame functions; only the slot totals (as many rows as there are slots) come to the driver.

Records that repeat (same id, size and checksum) are counted and numbered, and all but the first hash their number too: however often a
record stands in the table, its copies spread over all slots.

Defined cases: a NULL text has no bytes and the CRC-32 of nothing (0); a NULL id is a value like any other; equal rows
get places of their own in slots of their own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablemend.llm.common import fresh_folder, stored

SLOTS = 4096
OVERHEAD = 8  # bytes that each record takes besides its text
#: Copies of one record that are numbered in one go.
RUN = 4096


@dataclass
class SlotMap:
    """One version of the slot-to-shard map: slot -> (shard, place of its first record in the shard)."""

    version: int
    shards: int
    slots: dict[int, tuple[int, int]]


def slotted(documents: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot) for each record; the slot depends on the record and, for a copy, on its number."""
    text = F.col("text").cast("string")
    sized = documents.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    record = ["doc_id", "size", "text_crc32"]
    counted = sized.groupBy(*record).agg(F.count(F.lit(1)).alias("n"))
    # Numbers come in runs that are dealt over the tasks, so a record with very many copies is not written out by one.
    runs = counted.select(*record, "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / RUN))).alias("run"))
    runs = runs.repartition(*record, "run")
    last = F.least(F.col("n"), (F.col("run") + 1) * RUN) - 1
    numbered = runs.select(*record, F.explode(F.sequence(F.col("run") * RUN, last)).alias("copy"))
    own = F.xxhash64("doc_id", "text_crc32", "size")
    hashed = F.when(F.col("copy") == 0, own).otherwise(F.xxhash64("doc_id", "text_crc32", "size", "copy"))
    return numbered.select(*record, F.pmod(hashed, F.lit(slots)).cast("int").alias("virtual_slot"))


def slot_totals(records: DataFrame) -> list[tuple[int, int, int]]:
    """(slot, bytes, rows) of the slots in use: at most as many rows as there are slots."""
    totals = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    return sorted(tuple(r) for r in totals.collect())


def _placed(owner: dict[int, int], totals: list[tuple[int, int, int]], shards: int, version: int) -> SlotMap:
    """Give each slot its first place: slots of one shard follow each other by number."""
    free, slots = [0] * shards, {}
    for slot, _, n in totals:
        slots[slot] = (owner[slot], free[owner[slot]])
        free[owner[slot]] += n
    return SlotMap(version, shards, slots)


def first_map(totals: list[tuple[int, int, int]], shards: int) -> SlotMap:
    """Version 1: slots from the largest down, each to the shard with the fewest bytes, then rows, then number."""
    load = [(0, 0, shard) for shard in range(shards)]
    owner = {}
    for slot, size, n in sorted(totals, key=lambda t: (-t[1], t[0])):
        had, rows, shard = heapq.heappop(load)
        owner[slot] = shard
        heapq.heappush(load, (had + size, rows + n, shard))
    return _placed(owner, totals, shards, 1)


def rebalanced(old: SlotMap, totals: list[tuple[int, int, int]], shards: int) -> SlotMap:
    """The next version for at least as many shards: slots move from shards above the mean to new shards, or, if
    there are none, to those below it."""
    if shards < old.shards:
        raise ValueError("to take shards away, build a first map")
    owner = {slot: old.slots[slot][0] if slot in old.slots else slot % old.shards for slot, _, _ in totals}
    load = [0] * shards
    for slot, size, _ in totals:
        load[owner[slot]] += size
    mean = sum(load) / shards
    takers = range(old.shards, shards) if shards > old.shards else range(shards)
    for slot, size, _ in sorted(totals, key=lambda t: (-t[1], t[0])):
        least = min(takers, key=lambda s: (load[s], s))
        # A move must not leave the giver below the taker, so two shards never swap for ever.
        if load[owner[slot]] - size >= mean - size / 2 and load[least] + size <= mean + size / 2 and load[owner[slot]] - size >= load[least]:
            load[owner[slot]] -= size
            load[least] += size
            owner[slot] = least
    return _placed(owner, totals, shards, old.version + 1)


def map_table(spark: SparkSession, *versions: SlotMap) -> DataFrame:
    """Store versions of the map in the shared folder and read them back: version, shards, virtual_slot, shard, base."""
    folder = fresh_folder(spark, "slot-map")
    schema = "version int, shards int, virtual_slot int, shard int, base long"
    for v in versions:
        rows = [(v.version, v.shards, slot, shard, base) for slot, (shard, base) in sorted(v.slots.items())]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def assigned(records: DataFrame, slot_map: DataFrame, version: int) -> DataFrame:
    """Add shard and slot (the record's place in its shard, gapless from 0) by one version of the map.

    Places are counted within a virtual slot, a few thousandths of a percent of the records, and start at the
    slot's base; no shard meets in one task. The map is broadcast: it has at most as many rows as there are slots.
    """
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    ranked = records.withColumn("n", F.row_number().over(within))
    one = slot_map.where(F.col("version") == version).select("virtual_slot", "shard", "base")
    return ranked.join(F.broadcast(one), "virtual_slot").withColumn("slot", F.col("base") + F.col("n") - 1).drop("n", "base")


def shard_documents(documents: DataFrame, shards: int = 24, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, map_version and next_shard.

    Law `bytes`: shards hold nearly the same bytes. next_shard is the shard by the second version of the map, made
    for one shard more: rows that move go to the new shard.
    """
    spark = documents.sparkSession
    records = stored(slotted(documents, slots), "slotted")
    totals = slot_totals(records)
    first = first_map(totals, shards)
    second = rebalanced(first, totals, shards + 1)
    table = map_table(spark, first, second)
    later = table.where(F.col("version") == second.version).select("virtual_slot", F.col("shard").alias("next_shard"))
    return (
        assigned(records, table, first.version)
        .join(F.broadcast(later), "virtual_slot")
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.lit(first.version).alias("map_version"), "next_shard",
        )
    )
