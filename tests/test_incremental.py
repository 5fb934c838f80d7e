import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from headway.operators import metrics as M
from headway.operators.periods import OLDER_PERIODS
from headway.plans.incremental import MetricStore

SCHEMA = "rt string, pid string, stop_id string, trip_id string, stop_sequence long, bus_stop_time timestamp_ntz, service_date date"


def _day(chance, day, salt, stops=5, late=True):
    """Visits of a service date; some trips run past midnight, into the next morning."""
    start, out = dt.datetime(2024, 1, 1) + dt.timedelta(days=day), []
    for trip in range(4):
        t = start + dt.timedelta(hours=26 if late and trip == 3 else 6 + 4 * trip, minutes=chance.randrange(120))
        for seq in range(stops):
            t += dt.timedelta(seconds=chance.randrange(30, 5000))
            if chance.random() < 0.8:
                out.append((f"R{trip % 2}", "1", f"s{seq}", f"{salt}-{day}-{trip}", seq, t, start.date()))
    return out


def _rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=str)


def _whole(spark, days, periods, as_of):
    data = [r for rows in days.values() for r in rows]
    return _rows(M.stop_metrics(spark.createDataFrame(data, SCHEMA).drop("service_date"), "actual", periods, as_of))


@pytest.mark.parametrize("periods,as_of", [(M.LIVE_PERIODS, "2024-02-10"), (OLDER_PERIODS, None)])
def test_runs_add_up_to_a_rebuild(spark, tmp_path, periods, as_of):
    """New days, older days, corrected days (emptier, and with stops that vanish), and a run repeated."""
    chance = random.Random(5)
    store, held = MetricStore(spark, str(tmp_path / "store"), periods), {}
    batches = [{d: _day(chance, d, "a") for d in (3, 4, 5, 8)}, {d: _day(chance, d, "b") for d in (0, 6, 31, 40)}]
    batches.append({4: _day(chance, 4, "c", stops=2, late=False), 8: _day(chance, 8, "c", stops=9)})
    batches.append(batches[-1])
    for i, batch in enumerate(batches):
        assert store.add(spark.createDataFrame([r for rows in batch.values() for r in rows], SCHEMA)) == i
        held.update(batch)
        if i in (0, 2):
            assert _rows(store.metrics(as_of)) == _whole(spark, held, periods, as_of)
    want = _whole(spark, held, periods, as_of)
    assert _rows(store.metrics(as_of)) == want
    # The repeated run brought no difference.
    assert spark.read.parquet(f"{store.base}/values/run=3").count() == 0
    store.compact()
    assert _rows(store.metrics(as_of)) == want
    held[9] = _day(chance, 9, "d")
    store.add(spark.createDataFrame(held[9], SCHEMA))
    assert _rows(store.metrics(as_of)) == _whole(spark, held, periods, as_of)


def test_a_run_that_broke_off_does_not_count(spark, tmp_path, monkeypatch):
    chance = random.Random(6)
    store = MetricStore(spark, str(tmp_path / "store"), ("hour", "month_abs"))
    first, second = ({d: _day(chance, d, "a")} for d in (1, 2))
    store.add(spark.createDataFrame(first[1], SCHEMA))
    before = _rows(store.metrics())
    plain = MetricStore._append
    monkeypatch.setattr(MetricStore, "_append", lambda self, state, delta, run: (plain(self, state, delta, run), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        store.add(spark.createDataFrame(second[2], SCHEMA))
    monkeypatch.undo()
    assert _rows(store.metrics()) == before and store.runs() == [0]
    assert store.add(spark.createDataFrame(second[2], SCHEMA)) == 1
    assert _rows(store.metrics()) == _whole(spark, {**first, **second}, ("hour", "month_abs"), None)


def test_a_run_reads_its_own_days(spark, tmp_path):
    """Visits of other dates are not opened, but for dates that reach into a changed day."""
    chance = random.Random(7)
    store = MetricStore(spark, str(tmp_path / "store"), ("hour", "month_abs"))
    store.add(spark.createDataFrame([r for d in range(6) for r in _day(chance, d, "a", late=False)], SCHEMA))
    one = spark.createDataFrame([(dt.date(2024, 1, 3),)], "service_date date")
    rows = store._current("visits", one)
    assert rows.count() > 0 and rows.filter("service_date <> '2024-01-03'").count() == 0
    plan = rows._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "service_date=" not in line and "PartitionFilters" in line)
    assert "service_date" in scan.split("PartitionFilters: [")[1].split("]")[0]
    days = spark.createDataFrame([(dt.date(2024, 1, 3),)], "day date")
    assert store._beside(days, one).count() == 0


def test_edges_of_a_store(spark, tmp_path):
    store = MetricStore(spark, str(tmp_path / "store"))
    assert store.metrics("2024-02-10").count() == 0 and store.runs() == []
    store.add(spark.createDataFrame([], SCHEMA))
    assert store.metrics("2024-02-10").count() == 0
    with pytest.raises(ValueError):
        MetricStore(spark, "x", ("hour", "last_full_month"))
    with pytest.raises(ValueError):
        store.metrics()
