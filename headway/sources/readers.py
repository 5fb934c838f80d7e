"""Scans with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from headway import schemas
from headway.constants import REQUIRED_FEED_TABLES


def read_ping_days(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Daily ping CSV files."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(schemas.PINGS).option("header", True).csv(paths)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """One row per JSON file: ``value`` and ``scrape_file``."""
    docs = spark.read.text(path, wholetext=True)
    return docs.select("value", F.col("_metadata.file_path").alias("scrape_file"))


def wanted_days(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Dates in ``[start, end)``."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("a"), F.date_sub(F.lit(end).cast("date"), 1).alias("b")
    )
    return bounds.filter("a <= b").select(F.explode(F.sequence("a", "b")).alias("data_date"))


def missing_days(wanted: DataFrame, held: DataFrame) -> DataFrame:
    """Days asked for and not held yet."""
    return wanted.join(held.select("data_date").distinct(), "data_date", "left_anti")


def day_report(wanted: DataFrame, found: DataFrame) -> DataFrame:
    """Each wanted day with the rows it brought; days without any are failures."""
    rows = found.groupBy("data_date").agg(F.count(F.lit(1)).alias("rows"))
    return (
        wanted.join(rows, "data_date", "left")
        .withColumn("rows", F.coalesce("rows", F.lit(0)))
        .withColumn("status", F.when(F.col("rows") > 0, "success").otherwise("failed"))
    )


def high_water_mark(df: DataFrame, date: str | Column = "data_date") -> DataFrame:
    """Latest day held and the day the next run starts with."""
    d = F.col(date) if isinstance(date, str) else date
    return df.agg(F.max(d).alias("max_date")).withColumn("next_date", F.date_add("max_date", 1))


def key_from_file_name(path: Column) -> Column:
    """First run of digits in a file's name."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    return F.nullif(F.regexp_extract(name, r"\d+", 0), F.lit(""))


def file_inventory(spark: SparkSession, path: str, folder: str | None = None) -> DataFrame:
    """Keys of a folder whose file names carry them, or the names of the folders they lie in, as ``<folder>=<key>``.

    Only names are read, not contents.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    key = key_from_file_name(F.col("path"))
    if folder is not None:
        key = F.nullif(F.regexp_extract("path", rf"/{folder}=([^/]+)/[^/]+$", 1), F.lit(""))
    return files.select(key.alias("pid")).filter("pid is not null").distinct()


def read_pattern_points(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PATTERN_POINTS).parquet(path)


def first_lines(spark: SparkSession, paths: Sequence[str], at_once: int = 16) -> list[str]:
    """The first line of each file, by whatever file system it lies in: one short read a file."""
    hadoop, java = spark._jvm.org.apache.hadoop, spark._jvm.java
    settings = spark._jsc.hadoopConfiguration()

    def first(path: str) -> str:
        where = hadoop.fs.Path(path)
        stream = where.getFileSystem(settings).open(where)
        try:
            return java.io.BufferedReader(java.io.InputStreamReader(stream, "UTF-8"), 4096).readLine() or ""
        finally:
            stream.close()

    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(first, paths))


def read_gtfs(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A GTFS text table of all extracted feeds below ``root``, all strings, absent columns NULL.

    A feed is the folder its tables lie in, each a file or a folder of files; its name becomes ``feed_id``. Columns are taken by header
    name, since feeds order them differently: files with equal headers are one scan, so there are as
    many scans as there are different headers, however many feeds. Only the first line of a file is read for that.
    """
    fields = schemas.GTFS[table].fields
    files = spark.read.format("binaryFile").load(f"{root}/*/{table}.txt").filter("length > 0").select("path")
    paths = [r["path"] for r in files.collect()]
    same: dict[str, list[str]] = {}
    for path, header in zip(paths, first_lines(spark, paths)):
        same.setdefault(header, []).append(path)
    scans = []
    for group in same.values():
        raw = spark.read.option("header", True).csv(group)
        have = {c.strip().lstrip("\ufeff"): c for c in raw.columns}
        cols = [
            (F.col(f"`{have[f.name]}`") if f.name in have else F.lit(None).cast("string")).alias(f.name) for f in fields
        ]
        feed = F.regexp_extract(F.col("_metadata.file_path"), rf"([^/]+)/{table}\.txt(?:/[^/]*)?$", 1).alias("feed_id")
        scans.append(raw.select(feed, *cols))
    if not scans:
        raise FileNotFoundError(f"no {table}.txt in the folders of {root}")
    return reduce(DataFrame.unionByName, scans)


def feed_tables(spark: SparkSession, root: str) -> DataFrame:
    """``(feed_id, table)`` of all extracted feeds below ``root``, from file names alone."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.txt").load(root).select("path")
    )
    return files.select(
        F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("feed_id"),
        F.regexp_extract("path", r"([^/]+)\.txt$", 1).alias("table"),
    )


def incomplete_feeds(tables: DataFrame, required: Sequence[str] = REQUIRED_FEED_TABLES) -> DataFrame:
    """Feeds that lack a required table, with the names of what is missing."""
    absent = [
        F.when(~F.coalesce(F.max(F.col("table") == t), F.lit(False)), F.lit(t)) for t in required
    ]
    return (
        tables.groupBy("feed_id")
        .agg(F.array_compact(F.array(*absent)).alias("missing"))
        .filter(F.size("missing") > 0)
    )


def read_feed_versions(spark: SparkSession, path: str, since: str, one_document: bool = True) -> DataFrame:
    """Published feed versions whose calendar starts at ``since`` or later.

    A file is one document, or has one on every line.
    """
    docs = spark.read.schema(schemas.FEED_VERSIONS).option("multiLine", one_document).json(path)
    return docs.select(F.inline("feed_versions")).filter(
        F.col("earliest_calendar_date").try_cast("date") >= F.lit(since).cast("date")
    )


def polygons(features: DataFrame, name: str = "community") -> DataFrame:
    """GeoJSON features to ``(community, parts)``, one row per feature with a polygon or several."""
    kind, text = F.col("geometry.type"), F.col("geometry.coordinates")
    parts = F.when(
        kind == "MultiPolygon", F.from_json(text, "array<array<array<array<double>>>>")
    ).when(kind == "Polygon", F.array(F.from_json(text, "array<array<array<double>>>")))
    corner = lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))
    named = F.transform(parts, lambda part: F.transform(part, lambda ring: F.transform(ring, corner)))
    return features.select(F.col("properties")[name].alias("community"), named.alias("parts")).filter("parts IS NOT NULL")


def read_areas(spark: SparkSession, path: str, name: str = "community") -> DataFrame:
    """Boundary polygons from GeoJSON."""
    docs = spark.read.schema(schemas.GEOJSON).option("multiLine", True).json(path)
    return polygons(docs.select(F.inline("features")), name)


def read_stops(spark: SparkSession, path: str, id_column: str = "stop_id") -> DataFrame:
    """Stop points from a CSV with longitude and latitude columns."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(
        F.col(id_column).alias("stop_id"),
        F.col("lon").try_cast("double").alias("lon"), F.col("lat").try_cast("double").alias("lat"),
    )
