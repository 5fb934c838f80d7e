"""Metrics of actual service kept up to date by day, without reading history.

A store holds, for every service date and calendar day, what its visits add to the metric tables: counts of values and
visits per hour. All of it is additive. A run takes whole service dates, new or corrected, works out what they add now, takes
away what they added before, and appends the difference, spread over the periods, to the state. Metrics are made from the
state alone, whose size follows stops, periods and distinct values, not days.

* Segment and cumulative times stay within a trip, and a trip within its service date.
* Headways stay within a calendar day but for the last one of each stop, which ends at the stop's next visit on whatever
  day. First and last visits, one narrow row for each route, stop and day, are kept as edges; where a day changes, the headways
  that cross into it, out of it or over it are repaired by the edges of its stops.
* Values are held for the finest periods; the others are made of whole parts of these when metrics are made.
* Bus counts per slot longer than a day are sums over days, so visits per slot are the state, and how often each count
  occurs is counted when metrics are made.
* ``last_full_month`` moves with ``as_of`` and equals ``month_abs`` of that month; bus counts are taken from there.

Everything a run writes lies under its number and counts only once its commit is written, last. A run that broke off is
written over by the next one; a run that brings the same dates again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from headway.functions.clock import floor_to, seconds_between
from headway.operators.metrics import KINDS, STOP_KEYS, STOP_METRICS, _metric_code, _names, packs_by_period
from headway.operators.periods import BY_NAME, LIVE_PERIODS, alike, fan_out, finest, period_number
from headway.operators.ranks import SHORT_PACK, histogram, stack_values
from headway.operators.visits import daytime, segment_times
from headway.session import staged

VISIT = "rt string, pid string, stop_id string, trip_id string, stop_sequence long, bus_stop_time timestamp_ntz"
_VALUE = "rt string, pid string, stop_id string, at timestamp_ntz, metric tinyint, value long, n long"
#: Columns of the stored tables besides ``run``, and the column that names the part of a table a run replaces.
TABLES = {
    "visits": (f"{VISIT}, day date, service_date date", "service_date"),
    "trips": (f"{_VALUE}, service_date date", "service_date"),
    "days": (f"{_VALUE}, day date", "day"),
    "edges": ("rt string, stop_id string, first timestamp_ntz, last timestamp_ntz, last_pid string, day date", "day"),
}
_AT = [*STOP_KEYS, "at", "metric", "value"]
_STATE_KEYS = [*STOP_KEYS, "__period", "__code", "metric"]
_STATE = "rt string, pid string, stop_id string, __period tinyint, __code int, metric tinyint"
_STATES = {"values": f"{_STATE}, value long, n long", "slots": f"{_STATE}, __slot timestamp_ntz, n long"}
_HEADWAY, _PREVIOUS, _CUMULATIVE, _BUSES = (_metric_code(KINDS[0], m) for m in STOP_METRICS)


class MetricStore:
    """Additive metrics of actual visits below one folder, which all executors share."""

    def __init__(self, spark: SparkSession, base: str, periods: Sequence[str] = LIVE_PERIODS):
        self.spark, self.base = spark, base
        self.periods = tuple(p for p in periods if p != "last_full_month")
        if len(self.periods) < len(periods) and "month_abs" not in periods:
            raise ValueError("period last_full_month is made from month_abs")
        self.last_full_month = len(self.periods) < len(periods)

    # --- runs -------------------------------------------------------------------

    def runs(self) -> list[int]:
        """Numbers of the committed runs, in order: one row a run."""
        commits = self._there(f"{self.base}/commits", "kind string, part date, run int")
        return sorted(r["run"] for r in commits.select("run").distinct().collect())

    def _there(self, path: str, schema: str) -> DataFrame:
        """A stored table, empty before its first write."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path.removesuffix("/*"))
        if not where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def _current(self, table: str, parts: DataFrame | None = None) -> DataFrame:
        """The rows of a table that count: of each date those of the last committed run that brought it.

        ``parts``: only these dates; other folders are not read, as both columns are partitions.
        """
        schema, unit = TABLES[table]
        commits = self._there(f"{self.base}/commits", "kind string, part date, run int").where(F.col("kind") == unit)
        if parts is not None:
            commits = commits.join(parts.select(F.col(unit).alias("part")).distinct(), "part", "left_semi")
        last = commits.groupBy(F.col("part").alias(unit)).agg(F.max("run").alias("run"))
        # Partitions are few and known before the scan, so they are named in the filter: no other file is opened.
        keep = [(r[unit], r["run"]) for r in last.collect()]
        rows = self._there(f"{self.base}/{table}", f"{schema}, run int")
        if not keep:
            return rows.limit(0).drop("run")
        dates = F.col(unit).isin([d for d, _ in keep]) & F.col("run").isin(sorted({r for _, r in keep}))
        return rows.where(dates).join(last, [unit, "run"], "left_semi").drop("run")

    def _write(self, df: DataFrame, table: str, run: int) -> None:
        _, unit = TABLES[table]
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(unit).parquet(f"{self.base}/{table}/run={run}")

    # --- one run ----------------------------------------------------------------

    def add(self, visits: DataFrame) -> int:
        """Take in whole service dates; dates that are there already are replaced. Returns the run's number.

        ``visits``: columns of ``VISIT`` and ``service_date``. A date without visits is left as it is.
        """
        run = max(self.runs(), default=-1) + 1
        schema, _ = TABLES["visits"]
        columns = [c.split()[0] for c in schema.split(", ")]
        self._write(visits.withColumn("day", F.to_date("bus_stop_time")).select(*columns), "visits", run)
        fresh = self.spark.read.schema(schema).parquet(f"{self.base}/visits/run={run}")
        dates = staged(fresh.select("service_date").distinct())
        before = self._current("visits", dates)
        days = staged(daytime(fresh).select("day").union(daytime(before).select("day")).distinct())

        self._write(self._trip_values(daytime(fresh)), "trips", run)
        trips = self._signed("trips", dates, run)

        # Other service dates with visits on the same calendar days, read by their own dates.
        beside = self._beside(days, dates)
        now = staged(daytime(fresh.unionByName(beside)).join(days, "day", "left_semi"))
        self._write(self._day_values(now), "days", run)
        inner = self._signed("days", days, run)
        self._write(self._edges(now), "edges", run)
        across = self._across(days, run)

        values = trips.unionByName(inner.where(F.col("metric") != _BUSES)).unionByName(across)
        changed = values.groupBy(*_AT).agg(F.sum("n").alias("n")).where("n != 0")
        spread = fan_out(changed, "at", finest(self.periods), None)
        self._append("values", spread.groupBy(*_STATE_KEYS, "value").agg(F.sum("n").alias("n")), run)
        counts = inner.where(F.col("metric") == _BUSES).groupBy(*_AT).agg(F.sum("n").alias("n")).where("n != 0").drop("value")
        slots = fan_out(counts, "at", self.periods, None, with_slot=True)
        self._append("slots", slots.groupBy(*_STATE_KEYS, "__slot").agg(F.sum("n").alias("n")), run)

        parts = dates.select(F.lit("service_date").alias("kind"), F.col("service_date").alias("part")).unionByName(
            days.select(F.lit("day").alias("kind"), F.col("day").alias("part"))
        )
        covered = fresh.select(F.col("service_date"), F.col("day")).distinct()
        covered.write.mode("overwrite").parquet(f"{self.base}/covered/run={run}")
        parts.coalesce(1).write.mode("overwrite").parquet(f"{self.base}/commits/run={run}")
        return run

    def _append(self, state: str, delta: DataFrame, run: int) -> None:
        delta.where("n != 0").write.mode("overwrite").parquet(f"{self.base}/{state}/run={run}")

    def _signed(self, table: str, parts: DataFrame, run: int) -> DataFrame:
        """What the parts add now, and with a minus what they added before."""
        schema, unit = TABLES[table]
        now = self.spark.read.schema(schema).parquet(f"{self.base}/{table}/run={run}")
        before = self._current(table, parts).withColumn("n", -F.col("n"))
        return now.unionByName(before).drop(unit)

    def _beside(self, days: DataFrame, dates: DataFrame) -> DataFrame:
        """Visits on these days of service dates that the run does not bring."""
        covered = self._there(f"{self.base}/covered", "service_date date, day date, run int").join(days, "day", "left_semi")
        others = covered.select("service_date").distinct().join(dates, "service_date", "left_anti")
        return self._current("visits", others).join(days, "day", "left_semi")

    def _values(self, df: DataFrame, unit: str, values: dict[int, str]) -> DataFrame:
        """How often each value occurs, NULL too, at each time that periods tell apart."""
        narrow = df.select(*STOP_KEYS, unit, alike("bus_stop_time", self.periods).alias("at"), *values.values())
        stacked = stack_values(narrow, [*STOP_KEYS, unit, "at"], {code: F.col(c).cast("long") for code, c in values.items()})
        return stacked.groupBy(*_AT, unit).agg(F.count(F.lit(1)).alias("n"))

    def _trip_values(self, visits: DataFrame) -> DataFrame:
        timed = segment_times(visits)
        return self._values(timed, "service_date", {_PREVIOUS: STOP_METRICS[1], _CUMULATIVE: STOP_METRICS[2]})

    def _day_values(self, visits: DataFrame) -> DataFrame:
        """Headways that end on their day, and visits per hour."""
        following = F.lead("bus_stop_time").over(W.partitionBy("rt", "stop_id", "day").orderBy("bus_stop_time", "trip_id", "pid", "stop_sequence"))
        gaps = visits.withColumn("gap", seconds_between("bus_stop_time", following)).where(F.col("gap").isNotNull())
        hours = visits.groupBy(*STOP_KEYS, "day", floor_to("hour", "bus_stop_time").alias("at")).agg(F.count(F.lit(1)).alias("n"))
        counts = hours.select(*STOP_KEYS, "at", F.lit(_BUSES).cast("tinyint").alias("metric"), F.lit(None).cast("long").alias("value"), "day", "n")
        return self._values(gaps, "day", {_HEADWAY: "gap"}).unionByName(counts)

    def _edges(self, visits: DataFrame) -> DataFrame:
        last = F.max(F.struct("bus_stop_time", "trip_id", "pid"))
        ends = visits.groupBy("rt", "stop_id", "day").agg(F.min("bus_stop_time").alias("first"), last.alias("last"))
        return ends.select("rt", "stop_id", "first", F.col("last.bus_stop_time").alias("last"), F.col("last.pid").alias("last_pid"), "day")

    def _across(self, days: DataFrame, run: int) -> DataFrame:
        """Headways from the last visit of a day to the stop's next one, for stops whose edges changed: now, less before."""
        now_here = self.spark.read.schema(TABLES["edges"][0]).parquet(f"{self.base}/edges/run={run}")
        all_before = self._current("edges")
        stops = now_here.select("rt", "stop_id").union(
            all_before.join(days, "day", "left_semi").select("rt", "stop_id")
        ).distinct()
        before = all_before.join(stops, ["rt", "stop_id"], "left_semi")
        now = before.join(days, "day", "left_anti").unionByName(now_here)

        def gaps(edges: DataFrame, sign: int) -> DataFrame:
            following = F.lead("first").over(W.partitionBy("rt", "stop_id").orderBy("day"))
            return edges.select(
                "rt", F.col("last_pid").alias("pid"), "stop_id", F.col("last").alias("bus_stop_time"),
                seconds_between("last", following).alias("value"), F.lit(sign).cast("long").alias("n"),
            )

        both = gaps(now, 1).unionByName(gaps(before, -1))
        at = alike("bus_stop_time", self.periods).alias("at")
        return both.select(*STOP_KEYS, at, F.lit(_HEADWAY).cast("tinyint").alias("metric"), "value", "n")

    # --- results ----------------------------------------------------------------

    def _compacted(self) -> int:
        """The last run whose differences, and all before, are in one table; -1 without one."""
        done = self._there(f"{self.base}/compactions/*", "upto int").agg(F.max("upto").alias("upto")).first()["upto"]
        return -1 if done is None else done

    def _state(self, state: str, keys: Sequence[str]) -> DataFrame:
        """A state table as committed runs add up."""
        upto = self._compacted()
        rows = self._there(f"{self.base}/{state}", f"{_STATES[state]}, run int")
        rows = rows.where(F.col("run").isin([r for r in self.runs() if r > upto] or [-1])).drop("run")
        if upto >= 0:
            rows = rows.unionByName(self._there(f"{self.base}/compacted/upto={upto}/{state}", _STATES[state]))
        return rows.groupBy(*keys).agg(F.sum("n").alias("n")).where("n != 0")

    def _histograms(self) -> tuple[DataFrame, DataFrame]:
        """Of times, for the finest periods, and of bus counts, for all but the last full month."""
        # Stores of earlier versions hold values for other periods, too.
        held = F.col("__period").isin([period_number(p) for p in finest(self.periods)])
        values = self._state("values", [*_STATE_KEYS, "value"]).where(held)
        # A NULL value keeps its group alive and counts for nothing.
        values = values.withColumn("n", F.when(F.col("value").isNotNull(), F.col("n")).otherwise(F.lit(0)))
        slots = self._state("slots", [*_STATE_KEYS, "__slot"]).withColumnRenamed("n", "value")
        return values, histogram(slots, _STATE_KEYS).select(*values.columns)

    def metrics(self, as_of: str | None = None, stats: Sequence[str] = SHORT_PACK) -> DataFrame:
        """All four metrics of actual service as ``stop_metrics`` gives them for the visits that count."""
        values, counts = self._histograms()
        periods = list(self.periods)
        if self.last_full_month:
            if as_of is None:
                raise ValueError("period last_full_month needs as_of")
            month = BY_NAME["month_abs"].code(F.add_months(F.lit(as_of).cast("date"), -1).cast("timestamp_ntz"))
            newest = counts.where((F.col("__period") == period_number("month_abs")) & (F.col("__code") == month))
            whole = BY_NAME["last_full_month"]
            counts = counts.unionByName(newest.withColumns({
                "__period": F.lit(period_number(whole.name)).cast("tinyint"), "__code": whole.code(F.lit(None)).cast("int"),
            }))
            periods.append(whole.name)
        return packs_by_period(values, STOP_KEYS, _names(KINDS[:1]), periods, stats, as_of, counts)

    def compact(self) -> None:
        """Put the differences of all committed runs into one table; it counts once its marker is written."""
        runs = self.runs()
        if not runs or runs[-1] == self._compacted():
            return
        for state, keys in (("values", [*_STATE_KEYS, "value"]), ("slots", [*_STATE_KEYS, "__slot"])):
            self._state(state, keys).write.mode("overwrite").parquet(f"{self.base}/compacted/upto={runs[-1]}/{state}")
        self.spark.range(1).select(F.lit(runs[-1]).alias("upto")).write.mode("overwrite").parquet(f"{self.base}/compactions/upto_{runs[-1]}")
