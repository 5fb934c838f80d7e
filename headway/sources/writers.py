"""Sinks. Each write is idempotent: running it again leaves the same table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from headway.functions.keys import normal_pid


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace the partitions present in ``df`` and leave all others.

    Rows are rebalanced by key: adaptive execution cuts a key holding much of the data into several
    tasks of the advisory size and puts small keys together, whatever their number.
    """
    (
        df.hint("rebalance", *by).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_by_stop(
    df: DataFrame, path: str, table: str, keys: Sequence[str] = ("rt", "stop_id"), order: Sequence[str] = ("bus_stop_time",),
    buckets: int = 64,
) -> None:
    """A table dealt to buckets by ``keys`` and sorted within them, so that windows, joins and sums by them need no shuffle.

    The number of buckets is part of the layout: tables that are joined have the same. Rows are dealt before they are written, so a
    bucket is one file.
    """
    dealt = df.repartition(buckets, *keys)
    (
        dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys, *order)
        .option("path", path).saveAsTable(table)
    )


def table_by_stop(
    spark: SparkSession, path: str, table: str, schema: str, keys: Sequence[str] = ("rt", "stop_id"),
    order: Sequence[str] = ("bus_stop_time",), buckets: int = 64,
) -> DataFrame:
    """Name a table that another session wrote by ``write_by_stop`` with the same layout."""
    by, sort = ", ".join(keys), ", ".join([*keys, *order])
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet CLUSTERED BY ({by}) SORTED BY ({sort}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table)


def append_merge(existing: DataFrame | None, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Existing rows plus a batch, where a key in the batch replaces its old rows.

    Applying the same batch twice changes nothing.
    """
    if existing is None:
        return batch
    kept = existing.join(batch.select(*key).distinct(), list(key), "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def append_all(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Plain UNION ALL, for callers that know the batch to be new."""
    return batch.unionByName(existing, allowMissingColumns=True)


def with_day(df: DataFrame, time: str | Column = "data_time", out: str = "day") -> DataFrame:
    t = F.col(time) if isinstance(time, str) else time
    return df.withColumn(out, F.to_date(t))


def write_pull(df: DataFrame, path: str, pull_date: str, time: str | Column = "data_time") -> None:
    """Add one pull's rows to their days.

    A day is the union of its pulls and a pull replaces only itself, so repeating
    one neither doubles nor loses rows.
    """
    dated = with_day(df, time).withColumn("pull_date", F.lit(pull_date).cast("date"))
    write_partitioned(dated, path, ["day", "pull_date"])


def split_by_pattern(pings: DataFrame) -> DataFrame:
    """Pings with a usable pattern id, ready to be partitioned by it."""
    return pings.withColumn("pid", normal_pid("pid")).filter(F.col("pid").isNotNull())


def publish(df: DataFrame, path: str, version: str) -> None:
    """Write a table under its version; earlier versions stay."""
    df.write.mode("overwrite").parquet(f"{path}/version={version}")


def versions(spark: SparkSession, path: str) -> DataFrame:
    """Versions of a published table, newest first, marked ``latest`` and ``previous``."""
    names = spark.read.parquet(path).select(F.col("version").cast("string").alias("version")).distinct()
    # One row per publication: small by nature, ranked without a window over one partition.
    top = names.orderBy(F.desc("version")).limit(2).agg(
        F.max("version").alias("latest"), F.min("version").alias("previous")
    )
    return top.select(
        "latest", F.when(F.col("previous") != F.col("latest"), F.col("previous")).alias("previous")
    )


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest version; the filter prunes to its folder."""
    latest = versions(spark, path).first()["latest"]
    table = spark.read.parquet(path)
    return table.filter(F.col("version").cast("string") == latest).drop("version")
