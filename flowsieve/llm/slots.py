"""Sharding by fixed virtual slots.

Records hash into ``slots`` virtual slots (thousands; never changed), bytes are added up per slot,
and a versioned map sends each slot to a shard. Version 1 deals the slots out evenly. Rebalancing
edits the newest version into the next: slots stay where they are as long as their shard is below
the mean, and the others go to the lightest shard. Only the map changes, never a record's slot.
Everything is DataFrame and SQL functions; the map has ``slots`` rows per version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowsieve.llm.common import row_struct, stored, unpacked

SLOTS = 4096
OUTPUT = ["size", "law", "shard", "slot", "grown_shard", "virtual_slot"]


def hash_slot(key: Column, slots: int = SLOTS) -> Column:
    """Virtual slot of a record: a digest of its key as text; a null key counts as empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % slots).cast("int")


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("bigint") + 1


def slot_bytes(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Bytes and rows of every slot, empty ones included: ``slots`` rows.

    ``records`` has virtual_slot and size. Each task adds up before the shuffle.
    """
    found = records.groupBy("virtual_slot").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")
    )
    every = records.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(F.broadcast(found), "virtual_slot", "left").na.fill(0, ["bytes", "rows"])


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 1: runs of neighbouring slots, as even in number as can be."""
    return spark.range(slots).select(
        F.lit(1).alias("version"),
        F.col("id").cast("int").alias("virtual_slot"),
        F.floor(F.col("id") * shards / slots).cast("int").alias("shard"),
    )


def edited_map(newest: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """The next version of a map over the given bytes per slot, for ``shards`` shards.

    Slots are visited from the largest to the smallest. A slot stays in its shard while that
    shard remains at or below the mean; otherwise it goes to the lightest shard (the lowest number
    among equals). More shards than before leave the new ones empty at first, so they fill from
    slots that others give up. Input and state are the ``slots`` rows of one version: a single
    fold over one array, whatever the size of the data.
    """
    item = F.struct(
        (-F.col("bytes")).alias("less"),
        F.col("virtual_slot").alias("slot"),
        F.col("shard").alias("now"),
        F.col("bytes").alias("bytes"),
    )
    gathered = newest.join(F.broadcast(loads), "virtual_slot").agg(
        F.array_sort(F.collect_list(item)).alias("items"),
        (F.sum("bytes") / shards).alias("mean"),
        (F.max("version") + 1).alias("version"),
    )
    start = F.struct(
        F.array_repeat(F.lit(0).cast("bigint"), shards).alias("load"),
        F.array().cast("array<struct<slot:int,shard:int>>").alias("out"),
    )

    def put(state, item):
        load = state["load"]
        stays = (item["now"] < shards) & (
            F.coalesce(F.get(load, item["now"]), F.lit(0)) + item["bytes"] <= F.col("mean")
        )
        lightest = (F.array_position(load, F.array_min(load)) - 1).cast("int")
        shard = F.when(stays, item["now"]).otherwise(lightest)
        return F.struct(
            F.transform(
                load, lambda x, i: F.when(i == shard, x + item["bytes"]).otherwise(x)
            ).alias("load"),
            F.concat(
                state["out"], F.array(F.struct(item["slot"].alias("slot"), shard.alias("shard")))
            ).alias("out"),
        )

    return gathered.select(
        "version", F.explode(F.aggregate("items", start, put)["out"]).alias("one")
    ).select("version", F.col("one.slot").alias("virtual_slot"), F.col("one.shard").alias("shard"))


def newest_version(maps: DataFrame) -> DataFrame:
    """The rows of the highest version of a map table."""
    return maps.join(
        F.broadcast(maps.agg(F.max("version").alias("version"))), "version", "left_semi"
    )


def write_version(version: DataFrame, path: str) -> None:
    """Add a version to a map table on shared storage. A version is one partition; writing it
    again replaces it, so a repeated job leaves one copy."""
    version.write.partitionBy("version").mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(path)


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("virtual_slot int, shard int, version int").parquet(path)


def place_records(docs: DataFrame, newest: DataFrame, key: str = "doc_id") -> DataFrame:
    """Columns of ``docs`` (with virtual_slot and size) with shard and slot.

    ``slot`` is the row's place in its shard, gapless from 0: places are counted inside each
    virtual slot, and the slot's start is the number of rows in the shard's lower virtual slots.
    No task holds a shard; a window task holds virtual slots, each 1 / 4096 of the keys. Rows that
    repeat a key are ordered by size; equal rows are interchangeable.
    """
    counts = docs.groupBy("virtual_slot").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = newest.join(F.broadcast(counts), "virtual_slot").select(
        "virtual_slot", "shard", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("virtual_slot").orderBy(F.asc_nulls_last(key), "size")
    placed = docs.withColumn("_place", F.row_number().over(inside) - 1)
    return (
        placed.join(F.broadcast(starts), "virtual_slot")
        .withColumn("slot", (F.col("_start") + F.col("_place")).cast("bigint"))
        .drop("_start", "_place")
    )


def shard_documents(
    docs: DataFrame,
    shards: int,
    path: str,
    slots: int = SLOTS,
    text: str = "text",
    size: str | None = None,
    keys: list[str] | None = None,
) -> DataFrame:
    """All columns of ``docs`` with size, law, shard, slot, grown_shard and virtual_slot.

    Law ``bytes``: shard sizes (UTF-8 bytes plus 1 a row) differ by no more than the rows of a
    slot. The map at ``path`` gets version 1 and a version rebalanced over these rows, which
    places them. ``size`` names a column that already holds the sizes. Null keys and texts count as
    empty; an empty table gives an empty table and still a full map. An input column with an
    output's name is replaced.

    A record's key is its doc_id and the checksum of its text, so that rows without a doc_id, or of
    one, spread over the slots; or what the columns ``keys`` hold. Rows of one key share a slot.
    """
    spark = docs.sparkSession
    own = [F.col(f"`{k}`") for k in keys or ["doc_id"]]
    if not keys:
        own.append(F.crc32(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")))
    named = F.concat_ws("|", *[F.coalesce(k.cast("string"), F.lit("")) for k in own])
    sized = docs.select(
        row_struct(docs),
        F.col("doc_id").alias("_key"),
        hash_slot(named, slots).alias("virtual_slot"),
        (F.col(f"`{size}`") if size else text_size(F.col(f"`{text}`"))).alias("size"),
    )
    loads = stored(slot_bytes(sized.select("virtual_slot", "size"), slots), "slot-bytes")
    write_version(first_map(spark, shards, slots), path)
    write_version(edited_map(newest_version(read_versions(spark, path)), loads, shards), path)
    newest = newest_version(read_versions(spark, path)).select("virtual_slot", "shard")
    placed = place_records(sized, newest, "_key")
    columns = dict(
        law=F.lit("bytes"), grown_shard=F.lit(None).cast("int"), shard=F.col("shard").cast("int")
    )
    placed = placed.withColumns(columns)
    return placed.select(*unpacked(placed, docs.columns, OUTPUT), *OUTPUT)
