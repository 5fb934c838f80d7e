"""Sharding over fixed virtual slots.

Records are hashed into a fixed number of slots (thousands). Bytes are added up per
slot, and a versioned table says which shard each slot lives in. Rebalancing edits that
table: slots stay where they are while their shard has room, the rest moves. Records are
never rehashed, so a new version moves whole slots only.

Rows that are equal in id and text would all hash to one slot. Where they are so many that they outweigh
an eighth of a slot's share, the hash takes the row's place in the table as well, so a third of all rows may be equal
and shards stay even. There are at most eight times as many such groups as slots.

DataFrame operations only. What is gathered in one task has one row per slot.

Defined results: a null text has no bytes and the checksum of empty text; a null id is
hashed like any value; repeated rows are placed one by one, and few of them share a slot;
an empty table gives an empty result and a map all the same; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from headway.llm.common import kept
from headway.session import run_folder

#: Virtual slots; fixed for the life of a data set.
SLOTS = 4096
#: Bytes each record counts besides its text.
RECORD_BYTES = 8


def measured(docs: DataFrame, slots: int = SLOTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One narrow row per record: key, size, checksum and virtual slot."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(whole) + F.lit(RECORD_BYTES)).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
    )
    return rows.withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int"))


def spread(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Rows of large groups of equal ones dealt to many slots. ``rows`` are kept, so that their places stay what they are."""
    most = max(1, rows.count() // (8 * slots))
    equal = ["doc_id", "text_crc32", "size"]
    many = rows.groupBy(*equal).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select(
        *[F.col(c).alias(f"__{c}") for c in equal], F.lit(True).alias("__many")
    )
    same = F.lit(True)
    for c in equal:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    salted = F.pmod(F.xxhash64("doc_id", "text_crc32", "row"), F.lit(slots)).cast("int")
    # At most 8 x slots groups: a side whose size is bounded by the plan, whatever the table.
    found = rows.join(F.broadcast(many), same, "left")
    return found.withColumn("virtual_slot", F.when(F.col("__many"), salted).otherwise(F.col("virtual_slot"))).select(rows.columns)


def slot_loads(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Records and bytes of every slot, empty ones included."""
    every = rows.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    loads = rows.groupBy("virtual_slot").agg(F.count(F.lit(1)).alias("records"), F.sum("size").alias("bytes"))
    return every.join(loads, "virtual_slot", "left").na.fill(0, ["records", "bytes"])


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 0: slots dealt round, before anything is known of their sizes."""
    slot = F.col("id").cast("int")
    return spark.range(slots).select(
        F.lit(0).alias("version"), slot.alias("virtual_slot"), F.pmod(slot, F.lit(shards)).cast("int").alias("shard")
    )


def rebalanced(current: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """The next version of a map, near equal in bytes, with few slots moved.

    In each shard the largest slots stay while their sum is within the mean; slots of
    shards that no longer exist and all others are dealt, largest first, each to the shard
    with the fewest bytes.
    """
    placed = current.join(loads, "virtual_slot")
    mean = (placed.agg(F.sum("bytes").alias("all")).first()["all"] or 0) / shards
    order = W.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot").rowsBetween(W.unboundedPreceding, 0)
    marked = placed.withColumn("running", F.sum("bytes").over(order)).withColumn(
        "stays", (F.col("running") <= F.lit(mean)) & (F.col("shard") < shards)
    )
    # One row: the loads that stay, and the slots to deal. Both are bounded by the number of slots.
    held = F.filter(F.collect_list(F.when(F.col("stays"), F.struct("shard", "bytes"))), lambda x: x.isNotNull())
    free = F.collect_list(F.when(~F.col("stays"), F.struct((-F.col("bytes")).alias("less"), "virtual_slot")))
    one = marked.agg(F.max("version").alias("version"), held.alias("held"), F.array_sort(free).alias("free"))
    start = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.aggregate(
            F.filter("held", lambda h: h["shard"] == s), F.lit(0).cast("long"), lambda a, h: a + h["bytes"]
        ),
    )
    none = F.array().cast("array<struct<virtual_slot:int,shard:int>>")

    def deal(state, slot):
        least = (F.array_position(state["loads"], F.array_min(state["loads"])) - 1).cast("int")
        loads_ = F.transform(state["loads"], lambda x, i: F.when(i == least, x - slot["less"]).otherwise(x))
        dealt = F.struct(slot["virtual_slot"].alias("virtual_slot"), least.alias("shard"))
        return F.struct(loads_.alias("loads"), F.concat(state["dealt"], F.array(dealt)).alias("dealt"))

    moved = (
        one.withColumn("loads", start)
        .select("version", F.aggregate("free", F.struct(F.col("loads"), none.alias("dealt")), deal)["dealt"].alias("dealt"))
        .select("version", F.inline("dealt"))
    )
    stay = marked.where("stays").select("version", "virtual_slot", "shard")
    return stay.unionByName(moved).withColumn("version", F.col("version") + 1)


def store_version(slot_map: DataFrame, path: str) -> None:
    """Add a version to a stored map; a version that is there already is replaced."""
    (
        slot_map.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("version").parquet(path)
    )


def stored_version(spark: SparkSession, path: str, version: int) -> DataFrame:
    table = spark.read.schema("virtual_slot int, shard int, version int").parquet(path)
    return table.where(F.col("version") == version).select("version", "virtual_slot", "shard")


def assigned(rows: DataFrame, slot_map: DataFrame, loads: DataFrame) -> DataFrame:
    """Every record with its shard and its place in it, numbered from 0 without gaps.

    A place is the records in earlier slots of the shard plus the rank inside the slot, so
    no shard is ever sorted as a whole.
    """
    earlier = W.partitionBy("shard").orderBy("virtual_slot").rowsBetween(W.unboundedPreceding, -1)
    table = slot_map.join(loads, "virtual_slot").select(
        "virtual_slot", "shard", F.coalesce(F.sum("records").over(earlier), F.lit(0)).alias("before")
    )
    inside = W.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    ranked = rows.withColumn("rank", F.row_number().over(inside) - 1)
    return ranked.join(table, "virtual_slot").select(
        "doc_id", "size", "text_crc32", "virtual_slot", "shard",
        (F.col("before") + F.col("rank")).cast("long").alias("slot"),
    )


def shard_documents(docs: DataFrame, shards: int = 24, slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """Place all documents: measure, add up, store version 0 and the rebalanced version 1, assign by the latter."""
    spark = docs.sparkSession
    path = path or f"{run_folder(spark)}/slot-map"
    rows = spread(kept(measured(docs, slots)), slots)
    loads = kept(slot_loads(rows, slots))
    store_version(first_map(spark, shards, slots), path)
    store_version(rebalanced(stored_version(spark, path, 0), loads, shards), path)
    return assigned(rows, stored_version(spark, path, 1), loads)


def op2_slot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23, near equal in bytes."""
    placed = shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
