"""Sharding by fixed virtual slots, with DataFrame functions only.

Records are hashed into a fixed number of slots (thousands), bytes are added up per slot, and a
small table says which shard holds which slot. Only that table changes when shards are
added; it is kept in versions. A record never changes its slot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palate.llm.common import stage

N_SLOTS = 4096


def with_slots(records: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_slots: int = N_SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot) of each record; size is UTF-8 bytes plus 1.

    A null text counts as empty (size 1, checksum 0). Null ids are hashed with their text, as
    every record is, so many records of one id do not meet in one slot. Equal rows each count.
    Other columns are not looked at, whatever their names."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return records.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(F.col(id_col), text), F.lit(n_slots)).cast("int").alias("virtual_slot"),
    )


def slot_weights(slotted: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """(virtual_slot, bytes, n_rows) of all slots, empty ones included: n_slots rows."""
    spark = slotted.sparkSession
    full = slotted.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n_rows"))
    every = spark.range(n_slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(full, "virtual_slot", "left").fillna(0, ["bytes", "n_rows"])


def _heaviest_first(weights: DataFrame, *extra: str) -> DataFrame:
    row = F.struct((-F.col("bytes")).alias("neg"), F.col("virtual_slot").alias("slot"), *extra)
    return weights.agg(F.sort_array(F.collect_list(row)).alias("slots"), F.sum("bytes").alias("total"))


def _least(loads: Column) -> Column:
    return (F.array_position(loads, F.array_min(loads)) - 1).cast("int")


def _put(loads: Column, where: Column, size: Column) -> Column:
    return F.transform(loads, lambda x, i: F.when(i == where, x + size).otherwise(x))


def new_map(weights: DataFrame, n_shards: int) -> DataFrame:
    """Version 0 of the map, (version, virtual_slot, shard): heaviest slot first, each to the
    shard with the fewest bytes so far, ties to the lower number. A fold over the slots, whose
    number is fixed, whatever the number of records."""

    def step(acc: Column, s: Column) -> Column:
        to = _least(acc["loads"])
        return F.struct(_put(acc["loads"], to, -s["neg"]).alias("loads"), F.concat(acc["map"], F.array(F.struct(s["slot"].alias("virtual_slot"), to.alias("shard")))).alias("map"))

    start = F.struct(F.array_repeat(F.lit(0).cast("long"), n_shards).alias("loads"), F.expr("cast(array() as array<struct<virtual_slot:int,shard:int>>)").alias("map"))
    folded = _heaviest_first(weights).select(F.aggregate("slots", start, step)["map"].alias("map"))
    return folded.select(F.inline("map")).select(F.lit(0).alias("version"), "virtual_slot", "shard")


def grow_map(current: DataFrame, weights: DataFrame, n_shards: int) -> DataFrame:
    """The next version of a map for n_shards shards, more than it names: slots only move into
    the new shards, heaviest first, as long as that leaves the old shard at least the mean and
    the new one at most. All other slots stay."""
    joined = _heaviest_first(weights.join(current, "virtual_slot"), "shard", "version")
    old = F.aggregate(
        "slots",
        F.array_repeat(F.lit(0).cast("long"), n_shards),
        lambda acc, s: _put(acc, s["shard"], -s["neg"]),
    )

    def step(acc: Column, s: Column) -> Column:
        fresh = F.slice(acc["loads"], acc["old_n"] + 1, F.lit(n_shards))
        to = (acc["old_n"] + _least(fresh)).cast("int")
        size, left = -s["neg"], F.element_at(acc["loads"], s["shard"] + 1)
        moves = (s["shard"] < acc["old_n"]) & (left - size >= acc["mean"]) & (F.array_min(fresh) + size <= acc["mean"])
        loads = F.when(moves, _put(_put(acc["loads"], to, size), s["shard"], s["neg"])).otherwise(acc["loads"])
        entry = F.struct((s["version"] + 1).alias("version"), s["slot"].alias("virtual_slot"), F.when(moves, to).otherwise(s["shard"]).alias("shard"))
        return F.struct(loads.alias("loads"), acc["old_n"].alias("old_n"), acc["mean"].alias("mean"), F.concat(acc["map"], F.array(entry)).alias("map"))

    start = F.struct(
        F.col("loads"),
        F.col("old_n"),
        (F.col("total") / n_shards).alias("mean"),
        F.expr("cast(array() as array<struct<version:int,virtual_slot:int,shard:int>>)").alias("map"),
    )
    ready = joined.select("slots", "total", old.alias("loads"), (F.array_max(F.transform("slots", lambda s: s["shard"])) + 1).alias("old_n"))
    return ready.select(F.aggregate("slots", start, step)["map"].alias("map")).select(F.inline("map"))


def assign(slotted: DataFrame, slot_map: DataFrame) -> DataFrame:
    """slotted with its shard and slot, the row's place in the shard, gapless from 0.

    Rows are numbered inside their virtual slot; the rows of the shard's earlier virtual slots
    are added, a running sum over the map. The map has a fixed number of rows."""
    counts = slotted.groupBy("virtual_slot").agg(F.count("*").alias("n_rows")).join(F.broadcast(slot_map), "virtual_slot")
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("virtual_slot", "shard", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return slotted.withColumn("place", place).join(F.broadcast(offsets), "virtual_slot").select(*slotted.columns, "shard", (F.col("first") + F.col("place") - 1).alias("slot"))


def save_map(slot_map: DataFrame, path: str, version: int) -> None:
    """Keep a map as a version below path, a folder that all nodes share. A version is written once; writing it
    again is an error, as records may lie where it says."""
    slot_map.select("virtual_slot", "shard").write.mode("errorifexists").parquet(f"{path.rstrip('/')}/version={version:06d}")


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(version, virtual_slot, shard) of a kept version, the latest by default. An unknown version, or a path without any, is an
    error."""
    kept = spark.read.schema("virtual_slot int, shard int, version int").option("basePath", path).parquet(path)
    if version is None:
        version = kept.agg(F.max("version")).first()[0]
    found = kept.filter(F.col("version") == F.lit(version))
    if version is None or found.isEmpty():
        raise ValueError(f"{path} has no version {version} of a map")
    return found.select("version", "virtual_slot", "shard")


def rebalance(spark: SparkSession, path: str, records: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", n_slots: int = N_SLOTS) -> DataFrame:
    """Edit the latest kept map for n_shards shards by the bytes that its slots hold now, keep the result as the next
    version, and return it."""
    current = load_map(spark, path)
    version = current.first()["version"] + 1
    weights = slot_weights(with_slots(records, id_col, text_col, n_slots), n_slots)
    save_map(grow_map(current, weights, n_shards), path, version)
    return load_map(spark, path, version)


def shard_documents(records: DataFrame, n_shards: int = 16, n_slots: int = N_SLOTS, id_col: str = "doc_id", text_col: str = "text", slot_map: DataFrame | None = None) -> DataFrame:
    """Every record with its shard: (doc_id, size, text_crc32, virtual_slot, shard, slot).

    Law: bytes. Shards hold nearly equal bytes, up to about the lightest slot that was dealt
    last. An empty table gives no rows. One record larger than a fair share fills its shard.
    ``slot_map`` is a kept map, which says where the slots lie; by default one is made for these records."""
    slotted = stage(with_slots(records, id_col, text_col, n_slots), "slotted")
    if slot_map is None:
        slot_map = stage(new_map(slot_weights(slotted, n_slots), n_shards), "slot-map-v0")
    return assign(slotted, slot_map.select("virtual_slot", "shard"))
