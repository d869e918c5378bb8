"""Sharding by fixed virtual slots.

Every record is hashed into one of ``SLOTS`` virtual slots.  Only the slot ->
shard map says where a slot lives, so the map (a table of ``SLOTS`` rows, with a
version) is all that changes when shards are added or bytes drift: records are
never hashed anew.  Bytes per slot are one partial aggregate; the map is packed
largest slot first onto the least loaded shard, and :func:`rebalance` edits an
existing map by moving as few slots as it can.

Law ``bytes``: shards hold nearly equal numbers of bytes.

Nulls: a null text has no bytes (its record still weighs ``OVERHEAD``), a null
id hashes like any other value.  Rows that repeat an id and a text are numbered, and
every one but the first is hashed with its number, so that copies spread over all slots;
equal texts under different ids are different records.  An empty table gives an empty
result and a map of empty slots.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediafeat.llm.common import scratch

SLOTS = 4096      # virtual slots; fixed for the life of a data set
OVERHEAD = 8      # bytes that a record weighs besides its text
CHUNK = 1 << 16   # copies of one row that a task numbers at a time
MAP_SCHEMA = "version int, vslot int, shard int, bytes long, rows long, first long"


def records(docs: DataFrame, slots: int = SLOTS, chunk: int = CHUNK) -> DataFrame:
    """doc_id, size, text_crc32, vslot of every row; the text is read once, and only its
    hashes are grouped.

    Equal rows are counted where they are read, so a row that is repeated without end
    reaches its group as one row per task; its copies are dealt out again in chunks."""
    text = F.coalesce(F.col("text"), F.lit(""))
    kinds = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(F.col("doc_id"), text).alias("_h")).groupBy("doc_id", "size", "text_crc32", "_h").agg(F.count(F.lit(1)).alias("_n"))
    many = (kinds.where(F.col("_n") > chunk)
            .withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(chunk).cast("long"))))
            .withColumn("_n", F.least(F.col("_n") - F.col("_from"), F.lit(chunk))).repartition("_h", "_from"))
    copies = kinds.where(F.col("_n") <= chunk).withColumn("_from", F.lit(0).cast("long")).unionByName(many).withColumn(
        "_j", F.explode(F.sequence(F.col("_from"), F.col("_from") + F.col("_n") - 1)))
    spread = F.when(F.col("_j") == 0, F.col("_h")).otherwise(F.xxhash64("_h", "_j"))
    return copies.select("doc_id", "size", "text_crc32", F.pmod(spread, F.lit(slots)).cast("int").alias("vslot"))


def slot_bytes(recs: DataFrame) -> DataFrame:
    """Bytes and rows of every slot that has rows (at most ``SLOTS`` rows)."""
    return recs.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def pack(weights: dict[int, int], shards: int) -> dict[int, int]:
    """Slot -> shard, the heaviest slot first onto the lightest shard."""
    heap = [(0, s) for s in range(shards)]
    where = {}
    for slot in sorted(weights, key=lambda k: (-weights[k], k)):
        load, shard = heapq.heappop(heap)
        where[slot] = shard
        heapq.heappush(heap, (load + weights[slot], shard))
    return where


def rebalance(where: dict[int, int], weights: dict[int, int], shards: int, slack: float = 0.02) -> dict[int, int]:
    """The next version of a map: slots leave shards above ``1 + slack`` times the
    mean (or that no longer exist) for the lightest shard; all others stay."""
    load = [0] * shards
    homeless = []
    for slot in sorted(weights):
        shard = where.get(slot, -1)
        if 0 <= shard < shards:
            load[shard] += weights[slot]
        else:
            homeless.append(slot)
    out = {k: v for k, v in where.items() if 0 <= v < shards}
    ceiling = sum(weights.values()) / max(shards, 1) * (1 + slack)
    for slot in sorted((k for k in out if k in weights), key=lambda k: (weights[k], k)):
        if load[out[slot]] > ceiling and load[out[slot]] - weights[slot] >= ceiling / (1 + slack) * (1 - slack):
            load[out[slot]] -= weights[slot]
            homeless.append(slot)
            del out[slot]
    heap = [(b, s) for s, b in enumerate(load)]
    heapq.heapify(heap)
    for slot in sorted(homeless, key=lambda k: (-weights[k], k)):
        b, s = heapq.heappop(heap)
        out[slot] = s
        heapq.heappush(heap, (b + weights[slot], s))
    return out


def map_frame(spark, where: dict[int, int], stats: dict[int, tuple[int, int]], shards: int, version: int = 1) -> DataFrame:
    """The map as a table: one row per slot with its shard, weight and the number
    of its shard's rows that lie in earlier slots."""
    seen = [0] * shards
    rows = []
    for slot in sorted(where):
        size, n = stats.get(slot, (0, 0))
        rows.append((version, slot, where[slot], size, n, seen[where[slot]]))
        seen[where[slot]] += n
    return spark.createDataFrame(rows, MAP_SCHEMA)


def build_map(recs: DataFrame, shards: int, path: str | None = None) -> DataFrame:
    """Version 1 of the map for these records; written to ``path`` if given (one
    folder per version).  The driver holds one row per slot, never more."""
    stats = {r.vslot: (r.bytes, r.rows) for r in slot_bytes(recs).collect()}
    frame = map_frame(recs.sparkSession, pack({k: v[0] for k, v in stats.items()}, shards), stats, shards)
    if path:
        frame.coalesce(1).write.parquet(f"{path}/version=1")
    return frame


def edit_map(recs: DataFrame, current: DataFrame, shards: int, path: str | None = None, slack: float = 0.02) -> DataFrame:
    """The next version of a stored map for records that have changed or for
    another number of shards."""
    stats = {r.vslot: (r.bytes, r.rows) for r in slot_bytes(recs).collect()}
    old = current.select("version", "vslot", "shard").collect()
    version = max((r.version for r in old), default=0) + 1
    where = rebalance({r.vslot: r.shard for r in old}, {k: v[0] for k, v in stats.items()}, shards, slack)
    frame = map_frame(recs.sparkSession, where, stats, shards, version)
    if path:
        frame.coalesce(1).write.parquet(f"{path}/version={version}")
    return frame


def place(recs: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Every record with its shard and its gapless position there (slots in
    order, then ids).  Rows are numbered slot by slot, so no task sorts a shard."""
    w = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    return (recs.join(F.broadcast(slot_map.select("vslot", "shard", "first")), "vslot")  # at most SLOTS rows
            .select("doc_id", "size", "text_crc32", "vslot", "shard",
                    (F.row_number().over(w) - 1 + F.col("first")).cast("long").alias("slot")))


def shard_documents(docs: DataFrame, shards: int, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, vslot, shard, slot of every document."""
    recs = scratch(records(docs, slots), "shard-records")
    return place(recs, build_map(recs, shards, map_path))
