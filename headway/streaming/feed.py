"""The landing folder of polls as a stream.

The feed is polled every few minutes and each poll lands as one JSON file. The stream runs the batch
transformations on newly landed files and counts vehicles per hour, each once a minute.

What a vehicle was seen in is state: a bit for each minute of its last ``KEEP_DAYS`` days, held by the state store, so a
micro-batch costs what it brings and reads back counts only. Days are event time: a vehicle's newest day moves the
window, and its older days leave the state. A ping before the window is late; whether it is a repeat is not known any more, so it
goes to a side table, and its day is counted from all its stored pings. Nothing is
dropped: whatever the order of the files, the figures equal the batch ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from headway.operators.pings import explode_snapshots, key_trips
from headway.session import run_folder
from headway.sources.writers import write_partitioned

#: Days before a vehicle's newest one for which its minutes are remembered.
KEEP_DAYS = 7
MINUTES = 1440
_ROWS = "vid string, tmstmp string, rt string, hour string, data_date date, late boolean"
_STATE = "days array<int>, seen array<binary>"


def snapshot_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Landed JSON files, one row each."""
    docs = (
        spark.readStream.format("text").option("wholetext", True)
        .option("maxFilesPerTrigger", files_per_batch).load(path)
    )
    return docs.select("value", F.col("_metadata.file_path").alias("scrape_file"))


def keyed_pings(docs: DataFrame) -> DataFrame:
    """Keyed pings of documents, batch or stream, repeats included."""
    pings, _ = explode_snapshots(docs)
    return key_trips(pings.filter(F.col("data_time").isNotNull()))


def _timed(pings: DataFrame) -> DataFrame:
    return pings.select(
        F.col("vid").cast("string").alias("vid"), "tmstmp", "rt", F.date_format("data_time", "yyyy-MM-dd HH").alias("hour"),
        F.to_date("data_date").alias("data_date"),
        F.unix_date(F.to_date("data_time")).alias("day"), (F.hour("data_time") * 60 + F.minute("data_time")).alias("minute"),
    )


def _counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy("data_date", "hour", "rt").agg(F.count(F.lit(1)).alias("pings"))


def hourly_pings(pings: DataFrame) -> DataFrame:
    """Pings per day, clock hour and route; a vehicle seen twice in one minute counts once."""
    return _counted(_timed(pings).dropDuplicates(["vid", "tmstmp"]))


def remember(
    days: dict[int, bytearray], rows: pd.DataFrame, keep_days: int
) -> pd.DataFrame:
    """Rows not seen before, marked, and all that are late; ``days`` takes up their minutes and loses days out of the window."""
    newest = max([*days, *rows["day"].tolist()])
    late = rows["day"] < newest - keep_days
    fresh = []
    for day, minute, old in zip(rows["day"].tolist(), rows["minute"].tolist(), late.tolist()):
        bit = 1 << (minute % 8)
        seen = None if old else days.setdefault(day, bytearray(MINUTES // 8))
        fresh.append(old or not seen[minute // 8] & bit)
        if not old:
            seen[minute // 8] |= bit
    for day in [d for d in days if d < newest - keep_days]:
        del days[day]
    return rows.assign(late=late)[fresh]


def first_sightings(pings: DataFrame, keep_days: int = KEEP_DAYS) -> DataFrame:
    """A stream's pings without repeats; late ones are marked and may be repeats."""

    def see(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        days = {d: bytearray(b) for d, b in zip(*state.get)} if state.exists else {}
        for rows in parts:
            if len(rows):
                yield remember(days, rows, keep_days)[["vid", "tmstmp", "rt", "hour", "data_date", "late"]]
        state.update((list(days), [bytes(b) for b in days.values()]))

    return _timed(pings).groupBy("vid").applyInPandasWithState(see, _ROWS, _STATE, "append", GroupStateTimeout.NoTimeout)


def _of_days(spark: SparkSession, root: str, days: Sequence[str], schema: str, below: str = "") -> DataFrame:
    """The rows of a table's days, which are its folders; no other folder is listed."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    paths = [p for p in (f"{root}/data_date={d}{below}" for d in days) if files.exists(hadoop.Path(p))]
    return spark.read.schema(schema).option("basePath", root).parquet(*paths) if paths else spark.createDataFrame([], schema)


def write_batch(batch: DataFrame, number: int, base: str) -> None:
    """Write one micro-batch's pings and its part of the counts, and add up the days it touched.

    Both lie under (day, batch), so a batch that is run again replaces itself. A day's counts are the sum of its parts; where a
    day has late pings, they are counted from its stored ones.
    """
    spark = batch.sparkSession
    # Everything below reads the batch; its state is worked out once.
    batch.write.mode("overwrite").parquet(f"{base}/incoming")
    rows = spark.read.schema(_ROWS).parquet(f"{base}/incoming")
    write_partitioned(rows.withColumn("batch", F.lit(number)), f"{base}/pings", ["data_date", "late", "batch"])
    parts = _counted(rows.filter(~F.col("late")))
    write_partitioned(parts.withColumn("batch", F.lit(number)), f"{base}/parts", ["data_date", "batch"])
    days = [str(r["data_date"]) for r in rows.select("data_date").distinct().collect()]
    late = _of_days(spark, f"{base}/pings", days, f"{_ROWS}, batch int", "/late=true").select("data_date").distinct()
    late_days = [str(r["data_date"]) for r in late.collect()]
    plain = _of_days(spark, f"{base}/parts", [d for d in days if d not in late_days], "data_date date, hour string, rt string, pings long, batch int")
    again = _of_days(spark, f"{base}/pings", late_days, f"{_ROWS}, batch int").dropDuplicates(["vid", "tmstmp"])
    counts = plain.groupBy("data_date", "hour", "rt").agg(F.sum("pings").alias("pings")).unionByName(_counted(again))
    write_partitioned(counts, f"{base}/hours", ["data_date"])


def run_once(pings: DataFrame, base: str, keep_days: int = KEEP_DAYS) -> StreamingQuery:
    """Process what has landed, then stop. Progress and state live in ``base``, so the next run goes on from there."""
    return (
        first_sightings(pings, keep_days).writeStream.foreachBatch(lambda batch, number: write_batch(batch, number, base))
        .outputMode("append").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    )


def replay_hourly(
    spark: SparkSession, table: DataFrame, to_documents: Callable[[DataFrame], DataFrame], files: int = 5
) -> DataFrame:
    """Land a table as files, stream them one per micro-batch and return the hourly counts.

    Files are dealt by hash, so every batch brings rows of all hours and most of them late.
    """
    base = run_folder(spark)
    table.repartition(files, F.xxhash64(*table.columns)).write.parquet(f"{base}/landing")
    rows = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/landing")
    run_once(keyed_pings(to_documents(rows)), base).awaitTermination()
    return spark.read.parquet(f"{base}/hours").select("hour", "rt", "pings")
