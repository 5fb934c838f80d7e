"""Session defaults and the shared folder for checkpoints."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the plans rely on or profit from; a cluster's own settings win.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Plans are built from many small columns; recording where each was made costs more than the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: int = 8, memory: str = "8g", **more: str) -> SparkSession:
    """A session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("headway")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        # Test data is small: without this a few megabytes end up in one task.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in {**SETTINGS, **more}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A folder all executors share: ``spark.checkpoint.dir``, or where that is unset one in the warehouse."""
    return spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_headway"


def run_folder(spark: SparkSession) -> str:
    """A new folder below the shared one, removed when the application ends."""
    mine = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
    _removed_at_exit(spark, mine)
    return f"{mine}/{uuid.uuid4().hex}"


def _removed_at_exit(spark: SparkSession, path: str) -> None:
    """Have the file system drop a folder when the driver's JVM ends."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(where)
    files.deleteOnExit(where)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by keys to as many tasks as the session shuffles to, for few bytes that make much work.

    Adaptive execution goes by bytes: it would put such rows together into little more tasks than there are cores, so that
    most cores wait for the last of them.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def staged(df: DataFrame) -> DataFrame:
    """The same rows, computed once and read back from the shared folder.

    For results that several later steps read: without it each of them would run
    everything before it again. Files outlive lost executors and go with the application.
    """
    path = f"{run_folder(df.sparkSession)}/stage"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
