import math
import random
import statistics

import pytest

from headway.operators import ranks as R


def nearest(values, q):
    return sorted(values)[math.floor(q * (len(values) - 1) + 0.5)]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 11, 500])
def test_pack_against_sorted_lists(spark, n):
    rnd = random.Random(n)
    data = [("g", rnd.randrange(50)) for _ in range(n)] + [("g", None), ("empty", None)]
    df = spark.createDataFrame(data, "k string, v long")
    hist = R.histogram(R.stack_values(df, ["k"], {0: "v"}), ["k", "metric"])
    out = {r.k: r for r in R.ranked_pack(hist, ["k"], stats=R.LONG_PACK).collect()}
    values = [v for k, v in data if k == "g" and v is not None]
    g = out["g"]
    assert g["count"] == n
    assert g["median"] == statistics.median(values)
    assert (g["q25"], g["q75"]) == (nearest(values, 0.25), nearest(values, 0.75))
    assert g["mean"] == pytest.approx(statistics.mean(values))
    assert (g["min"], g["max"]) == (min(values), max(values))
    assert g["std"] == (pytest.approx(statistics.stdev(values), abs=1e-9) if n > 1 else None)
    assert out["empty"]["count"] == 0 and out["empty"]["median"] is None


def test_weighted_median_half_counts(spark):
    df = spark.createDataFrame([("a", 10.0, 2), ("a", 20.0, 3), ("a", 30.0, 5), ("a", None, 0)], "k string, v double, w long")
    assert [tuple(r) for r in R.weighted_median(df, ["k"], "v", "w", "m").collect()] == [("a", 20.0)]
    shares = R.with_weights(df, ["k"], "w").collect()
    assert sum(r.weight_share for r in shares) == pytest.approx(1.0)


def test_group_medians_ignore_nulls(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", 3.0, 5.0), ("a", None, None)], "k string, x double, y double")
    assert [tuple(r) for r in R.group_medians(df, ["k"], ["x", "y"]).collect()] == [("a", 2.0, 5.0)]


def test_whole_periods_are_made_of_their_parts(spark):
    """Only the finest periods are counted; others, of one part or of several, equal those counted by themselves."""
    import datetime as dt
    import random

    from headway.operators import metrics as M

    chance = random.Random(3)
    start = dt.datetime(2022, 11, 20)
    data = [
        ("R", "1", chance.choice(["s", None]), start + dt.timedelta(minutes=chance.randrange(800_000)), chance.choice([None, *range(9)]))
        for _ in range(400)
    ] + [("R", "1", "lone", dt.datetime(2024, 1, 5, 8), 7), ("R", "1", "lone", None, 3)]
    visits = spark.createDataFrame(data, "rt string, pid string, stop_id string, bus_stop_time timestamp_ntz, v long")
    as_of = "2023-06-15"
    counted = M.value_histogram(visits, M.STOP_KEYS, "bus_stop_time", {0: "v"}, as_of=as_of)
    assert counted.select("__period").distinct().count() == 3
    whole = M.period_metrics(visits, "m", "v", as_of=as_of)
    for name in M.LIVE_PERIODS:
        alone = M.period_metrics(visits, "m", "v", periods=[name], as_of=as_of)
        got = sorted(map(tuple, whole.where(f"period = '{name}'").collect()), key=str)
        assert got and got == sorted(map(tuple, alone.collect()), key=str)
