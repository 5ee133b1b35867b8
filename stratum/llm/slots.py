"""Sharding by fixed virtual slots, with DataFrame operations only.

A record's hash picks one of thousands of slots, for good. Which shard a slot belongs to stands in a map of one row a
slot; the first version deals the slots out in turn, and rebalancing writes a new version that moves or swaps as few
slots as bring the shards' bytes together. Only slots that change hands move any data.

What reaches the driver is a row per slot (their number is a parameter). Places within a shard are numbered by slot and,
within it, by the tasks that read its rows: each piece of a slot counts its own rows and adds what the pieces before it
hold, so no task sees a whole shard, or a whole slot that very many equal rows share.

Null texts have no bytes and crc32 0; a null doc_id hashes like any value; records are told apart by doc_id and text,
so only wholly repeated rows are sure to share a slot, and each of them is kept; an empty table gives no rows and an
even map; other columns are not read.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.sources.scratch import materialize, new_folder

N_SLOTS = 4096
#: A slot's rows are numbered in so many pieces, by the task that read them, so one slot may hold any share of them.
PIECES = 64


def records(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot, piece): all that sharding reads of (doc_id, text)."""
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    slot = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(n_slots)).cast("int")
    piece = F.pmod(F.shiftright(F.monotonically_increasing_id(), 33), F.lit(PIECES)).cast("int")
    rows = docs.select("doc_id", size.alias("size"), crc.alias("text_crc32"), piece.alias("piece"))
    return rows.withColumn("virtual_slot", slot)


def slot_loads(rows: DataFrame) -> DataFrame:
    """(virtual_slot, bytes, rows) of every slot that has any."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def first_map(n_slots: int, n_shards: int) -> list[int]:
    return [slot % n_shards for slot in range(n_slots)]


def rebalanced(shard_of: list[int], load: dict[int, int], n_shards: int, tolerance: float = 1e-4) -> list[int]:
    """The map after edits: again and again the fullest shard gives the emptiest a slot, or swaps one with it, that
    halves their difference as nearly as can be, until that is within the tolerance or nothing helps."""
    shard_of = list(shard_of)
    held = [set() for _ in range(n_shards)]
    total = [0] * n_shards
    for slot, shard in enumerate(shard_of):
        if load.get(slot):
            held[shard].add(slot)
            total[shard] += load[slot]
    mean = sum(total) / n_shards
    for _ in range(len(shard_of) * 4):
        low, high = min(range(n_shards), key=total.__getitem__), max(range(n_shards), key=total.__getitem__)
        gap = total[high] - total[low]
        if gap <= tolerance * mean:
            break
        given = sorted((load[s], s) for s in held[high])
        taken = [(0, -1), *sorted((load[s], s) for s in held[low])]
        best, at = (gap, -1, -1), 0
        for size, slot in given:  # the difference after an exchange is gap - 2 * (size - back)
            while at + 1 < len(taken) and size - taken[at + 1][0] >= gap / 2:
                at += 1
            for back, other in taken[at : at + 2]:
                best = min(best, (abs(gap - 2 * (size - back)), slot, other))
        left, slot, other = best
        if left >= gap:
            break
        for s, a, b in ((slot, high, low), (other, low, high)):
            if s >= 0:
                held[a].remove(s)
                held[b].add(s)
                total[a], total[b] = total[a] - load[s], total[b] + load[s]
                shard_of[s] = b
    return shard_of


def grown(shard_of: list[int], load: dict[int, int], n_shards: int) -> list[int]:
    """The map with one more shard, which takes slots from the others up to its share; no other slot moves."""
    shard_of = list(shard_of)
    total = [0] * n_shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(n_shards)]
    for slot, shard in enumerate(shard_of):
        held[shard].append((load.get(slot, 0), slot))
        total[shard] += load.get(slot, 0)
    for slots in held:
        slots.sort()
    share, taken = sum(total) / (n_shards + 1), 0
    fullest = [(-t, shard) for shard, t in enumerate(total)]
    heapq.heapify(fullest)
    while fullest and taken < share:
        _, shard = heapq.heappop(fullest)
        if not held[shard]:
            continue
        size, slot = held[shard].pop()
        if taken + size <= share or not taken:
            shard_of[slot] = n_shards
            taken += size
            total[shard] -= size
        heapq.heappush(fullest, (-total[shard], shard))
    return shard_of


def save_map(spark: SparkSession, folder: str, version: int, shard_of: list[int]) -> None:
    """Version `version` of the map: (version, virtual_slot, shard). Earlier versions stay as they are."""
    listed = F.split(F.lit(",".join(map(str, shard_of))), ",")
    rows = spark.range(len(shard_of)).select(
        F.lit(version).alias("version"), F.col("id").cast("int").alias("virtual_slot"),
        F.get(listed, F.col("id").cast("int")).cast("int").alias("shard"),
    )
    rows.coalesce(1).write.mode("append").parquet(folder)


def load_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    stored = spark.read.schema("version int, virtual_slot int, shard int").parquet(folder)
    return stored.filter(F.col("version") == version).drop("version")


def place(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Each record with its shard and its place there, from 0 without gaps. `rows` are stored; the map has a row a slot."""
    own = Window.partitionBy("virtual_slot", "piece").orderBy("doc_id", "text_crc32", "size")
    earlier = Window.partitionBy("shard").orderBy("virtual_slot", "piece").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before")
    pieces = rows.groupBy("virtual_slot", "piece").agg(F.count("*").alias("rows"))  # N_SLOTS x PIECES at most
    pieces = pieces.join(F.broadcast(slot_map), "virtual_slot").select("virtual_slot", "piece", "shard", before)
    return (
        rows.withColumn("row", F.row_number().over(own))
        .join(F.broadcast(pieces), ["virtual_slot", "piece"])
        .withColumn("slot", F.col("before") + F.col("row") - 1)
        .drop("before", "row", "piece")
    )


def shard_by_bytes(
    docs: DataFrame, n_shards: int = 16, n_slots: int = N_SLOTS, folder: str | None = None
) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot, shard, slot) by the rebalanced map, version 2 in `folder`."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "slot-map")
    rows = materialize(records(docs, n_slots), "slot-records")
    loads = materialize(slot_loads(rows), "slot-loads")
    load = {r.virtual_slot: r.bytes for r in loads.collect()}
    shard_of = first_map(n_slots, n_shards)
    save_map(spark, folder, 1, shard_of)
    save_map(spark, folder, 2, rebalanced(shard_of, load, n_shards))
    return place(rows, load_map(spark, folder, 2))


def write_shards(docs: DataFrame, slot_map: DataFrame, path: str, n_slots: int = N_SLOTS) -> None:
    """All columns of the documents in a folder per shard; shards are cut into many files by their slots."""
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    slot = F.pmod(F.xxhash64(F.col("doc_id"), crc), F.lit(n_slots)).cast("int")
    rows = docs.drop("virtual_slot", "shard").withColumn("virtual_slot", slot)
    rows = rows.join(F.broadcast(slot_map), "virtual_slot").repartition("virtual_slot").drop("virtual_slot")
    rows.write.partitionBy("shard").parquet(path)
