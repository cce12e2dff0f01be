"""Operator 6: sharding by fixed virtual slots.

Records are hashed into a fixed number of virtual slots, thousands of them whatever the size of the data. One aggregation
gives bytes and rows of each slot; its result has as many rows as there are slots at most, which bounds what reaches the
driver and what is broadcast. The slot-to-shard map is made there (largest slots first, each to the lightest shard), kept
as a versioned table, and edited when rebalancing: only the slots that must move change shard. A record's place in its
shard is the offset of its virtual slot plus its rank there, so no task sees a whole shard.

Defined results: a null text has size 8 and checksum 0; records with null or repeated ids are hashed by id and text;
equal records share a slot; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import shared_dir

SLOTS = 8192


@dataclass(frozen=True)
class SlotMap:
    """The shard of each virtual slot, in one version."""

    shards: int
    slots: list[int]
    version: int = 1
    moved: list[int] = field(default_factory=list)

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(self.version, self.shards, i, s) for i, s in enumerate(self.slots)]
        return spark.createDataFrame(rows, "version int, shards int, virtual_slot int, shard int").coalesce(1)

    def save(self, spark: SparkSession, path: str) -> None:
        """Adds this version; a version that is there is never written over."""
        self.frame(spark).write.mode("error").parquet(f"{path}/v={self.version}")

    @staticmethod
    def load(spark: SparkSession, path: str, version: int) -> SlotMap:
        rows = spark.read.parquet(f"{path}/v={version}").orderBy("virtual_slot").collect()
        return SlotMap(rows[0]["shards"], [r["shard"] for r in rows], version)


def first_map(sizes: dict[int, int], shards: int, slots: int = SLOTS) -> SlotMap:
    """Largest slots first, each to the shard that is lightest so far (then holds fewest slots)."""
    out, heap = [0] * slots, [(0, 0, s) for s in range(shards)]
    for slot in sorted(range(slots), key=lambda s: (-sizes.get(s, 0), s)):
        load, n, shard = heap[0]
        heapq.heapreplace(heap, (load + sizes.get(slot, 0), n + 1, shard))
        out[slot] = shard
    return SlotMap(shards, out)


def rebalanced(old: SlotMap, sizes: dict[int, int], shards: int, slack: float = 0.01) -> SlotMap:
    """The next version for `shards` shards: slots of shards that are gone, and those above the mean, move; no others."""
    mean = sum(sizes.values()) / max(1, shards)
    load = [0] * shards
    held: list[list[int]] = [[] for _ in range(shards)]
    homeless = []
    for slot, shard in enumerate(old.slots):
        if shard >= shards:
            homeless.append(slot)
        else:
            load[shard] += sizes.get(slot, 0)
            held[shard].append(slot)
    for shard in range(shards):
        for slot in sorted(held[shard], key=lambda s: (-sizes.get(s, 0), s)):
            size = sizes.get(slot, 0)
            if size and load[shard] - size >= mean * (1 - slack):
                load[shard] -= size
                homeless.append(slot)
    out = list(old.slots)
    heap = [(load[s], s) for s in range(shards)]
    heapq.heapify(heap)
    for slot in sorted(homeless, key=lambda s: (-sizes.get(s, 0), s)):
        now, shard = heap[0]
        heapq.heapreplace(heap, (now + sizes.get(slot, 0), shard))
        out[slot] = shard
    return SlotMap(shards, out, old.version + 1, [i for i, (a, b) in enumerate(zip(old.slots, out, strict=True)) if a != b])


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot)"""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sized = docs.select(F.col("doc_id").cast("long"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return sized.withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int"))


def slot_sizes(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """Bytes and rows of each virtual slot: as many entries as there are slots at most."""
    return {r[0]: (r[1], r[2]) for r in rows.groupBy("virtual_slot").agg(F.sum("size"), F.count(F.lit(1))).collect()}


def shard(docs: DataFrame, shards: int = 24, slots: int = SLOTS, slot_map: SlotMap | None = None, keep_at: str | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, virtual_slot, map_version); slot: place in the shard, without gaps from 0."""
    spark = docs.sparkSession
    rows = records(docs, slots)
    sizes = slot_sizes(rows)
    slot_map = slot_map or first_map({k: v[0] for k, v in sizes.items()}, shards, slots)
    if keep_at:
        slot_map.save(spark, keep_at)
    ahead, table = [0] * slot_map.shards, []
    for slot, to in enumerate(slot_map.slots):
        table.append((slot, to, ahead[to]))
        ahead[to] += sizes.get(slot, (0, 0))[1]
    placed = F.broadcast(spark.createDataFrame(table, "virtual_slot int, shard int, ahead long"))
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return rows.withColumn("rank", rank).join(placed, "virtual_slot").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("ahead") + F.col("rank") - 1).alias("slot"), "virtual_slot", F.lit(slot_map.version).alias("map_version")
    )


def map_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/millrace-slot-maps/{name}"
