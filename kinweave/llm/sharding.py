"""Sharding by fixed virtual slots.

Records are hashed by id and text checksum into a fixed number of virtual slots, so many
records of one id (or of none) spread over slots. The bytes of
each slot are summed, and a versioned table maps slots to shards. Rebalancing
loads the last version of that table, edits it and stores it as the next one; it never
rehashes a record. The slot table has ``slots`` rows whatever the input, so it is the
only thing that reaches the driver, and the only thing that is broadcast.

Nulls: a null text counts no bytes; a null id hashes like a value of its own.
Repeated rows share a virtual slot and get positions of their own.
An empty table gives an empty result and an even map. A text of any length
is one record; one that outweighs a shard has a shard with little else, and the
others are balanced among themselves. Other columns of the input, clashing ones too, are dropped.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import _util

SLOTS = 4096


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """Size in UTF-8 bytes plus 1, CRC-32 of the text and virtual slot of each record."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(F.col(id_col), F.crc32(text.cast("binary"))), F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def slot_load(recs: DataFrame, slots: int = SLOTS) -> list[tuple[int, int]]:
    """Rows and bytes of every slot: two sums per slot, pre-aggregated by each task."""
    found = recs.groupBy("virtual_slot").agg(F.count("*").alias("n"), F.sum("size").alias("b")).collect()
    load = [(0, 0)] * slots
    for r in found:
        load[r.virtual_slot] = (r.n, r.b)
    return load


def even_map(shards: int, slots: int = SLOTS) -> list[int]:
    """Version 0: slots dealt round robin."""
    return [s % shards for s in range(slots)]


def rebalance(to_shard: list[int], weight: list[int], shards: int) -> list[int]:
    """Edit a map until no single move or swap of slots between the heaviest
    and the lightest shard brings the two closer. A heaviest shard that can't improve (it
    holds a slot that outweighs the gap) is then left as it is, and the rest go on
    without it. Works on the slot table alone."""
    to_shard = list(to_shard)
    held: list[set[int]] = [set() for _ in range(shards)]
    total = [0] * shards
    for s, k in enumerate(to_shard):
        held[k].add(s)
        total[k] += weight[s]
    active = set(range(shards))
    for _ in range(8 * len(to_shard)):
        if len(active) < 2:
            break
        hi = max(active, key=lambda k: (total[k], k))
        lo = min(active, key=lambda k: (total[k], k))
        gap = total[hi] - total[lo]
        best = (gap, -1, -1)
        light = sorted((weight[s], s) for s in held[lo])
        keys = [w for w, _ in light]
        for s in held[hi]:
            if weight[s]:
                best = min(best, (abs(gap - 2 * weight[s]), s, -1))
            # the partner that leaves the two nearest to each other
            at = _bisect(keys, weight[s] - gap / 2)
            for w, t in light[max(0, at - 1) : at + 1]:
                best = min(best, (abs(gap - 2 * (weight[s] - w)), s, t))
        left, s, t = best
        if left >= gap:
            active.remove(hi)
            continue
        for slot, a, b in ((s, hi, lo), *(((t, lo, hi),) if t >= 0 else ())):
            held[a].remove(slot)
            held[b].add(slot)
            to_shard[slot] = b
            total[a] -= weight[slot]
            total[b] += weight[slot]
    return to_shard


def _bisect(keys: list[int], x: float) -> int:
    import bisect

    return bisect.bisect_left(keys, x)


def grow(to_shard: list[int], weight: list[int], shards: int) -> list[int]:
    """One more shard: slots move from the heaviest shards into the new one only."""
    to_shard, new = list(to_shard), shards
    total = [0] * (shards + 1)
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for s, k in enumerate(to_shard):
        total[k] += weight[s]
        heapq.heappush(held[k], (-weight[s], s))
    goal = sum(weight) / (shards + 1)
    while True:
        k = max(range(shards), key=lambda i: (total[i], -i))
        while held[k] and total[new] - held[k][0][0] > goal:
            heapq.heappop(held[k])
        if not held[k] or total[k] <= goal:
            return to_shard
        w, s = heapq.heappop(held[k])
        to_shard[s] = new
        total[k] += w
        total[new] -= w


def store_map(spark: SparkSession, path: str, version: int, to_shard: list[int], load: list[tuple[int, int]]) -> DataFrame:
    """Write a version of the map and read it back: ``version, virtual_slot, shard, rows,
    bytes, base``; ``base`` is the position in its shard of a slot's first record."""
    rows = []
    base: dict[int, int] = {}
    for s, k in enumerate(to_shard):
        rows.append((s, k, *load[s], base.get(k, 0)))
        base[k] = base.get(k, 0) + load[s][0]
    df = spark.createDataFrame(rows, "virtual_slot int, shard int, rows long, bytes long, base long")
    df.coalesce(1).write.mode("overwrite").parquet(f"{path}/version={version}")
    return load_map(spark, path).filter(F.col("version") == version)


def load_map(spark: SparkSession, path: str) -> DataFrame:
    """All stored versions; a new path gets an empty table."""
    schema = "virtual_slot int, shard int, rows long, bytes long, base long, version int"
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy("version").parquet(path)
    return spark.read.schema(schema).parquet(path)


def latest(spark: SparkSession, path: str) -> tuple[int, list[int]]:
    """Number and slots' shards of the last stored version, -1 and none where there is none."""
    stored = load_map(spark, path)
    version = stored.agg(F.max("version")).first()[0]
    if version is None:
        return -1, []
    return version, [r.shard for r in stored.filter(F.col("version") == version).orderBy("virtual_slot").collect()]


def assign(docs: DataFrame, shards: int = 16, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``law = 'bytes'``: shard sizes near equal after the map has been edited
    by the bytes of each slot. ``slot`` is a record's place in its shard,
    gapless from 0. Places follow slot, id and checksum, so they depend on the
    records alone. ``grown_shard`` belongs to the law ``key`` and is null.

    ``path``: where versions of the map are kept; the last one there is edited (with slots
    moved into the new ones only, if there are more shards than before). A new path, or
    none, begins with version 0, slots dealt round robin."""
    spark = docs.sparkSession
    path = path or _util.shared_dir(spark)
    recs = records(docs, id_col, text_col, slots)
    load = slot_load(recs, slots)
    weight = [b for _, b in load]
    version, held = latest(spark, path)
    if not held:
        version, held = 0, even_map(shards, slots)
        store_map(spark, path, version, held, load)
    if len(held) != slots or max(held) >= shards:
        raise ValueError("the stored map has other slots, or more shards")
    for more in range(max(held) + 1, shards):
        held = grow(held, weight, more)
    current = store_map(spark, path, version + 1, rebalance(held, weight, shards), load).drop("version", "rows", "bytes")
    place = F.row_number().over(Window.partitionBy("virtual_slot").orderBy(id_col, "text_crc32", "size"))
    # broadcast: exactly `slots` rows
    return recs.withColumn("place", place).join(F.broadcast(current), "virtual_slot").select(
        id_col,
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("base") + F.col("place") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )
