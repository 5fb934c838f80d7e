"""Bucketed operators against plain windows, with one key holding most rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window as W, functions as F

from headway.operators import ordered as O


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    data = []
    for i in range(3000):
        key = "hot" if rnd.random() < 0.7 else f"k{rnd.randrange(20)}"
        at = start + dt.timedelta(seconds=rnd.randrange(10 * 86400))
        data.append((key, at, i, rnd.randrange(9)))
    return spark.createDataFrame(data, "k string, t timestamp_ntz, i long, v long")


@pytest.mark.parametrize("bucket", ["hour", "day", "month"])
def test_next_previous_sum_number(skewed, bucket):
    w = W.partitionBy("k").orderBy("t", "i")
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    plain = skewed.select(
        "i", F.lead("t").over(w), F.lag("t").over(w), F.row_number().over(w).cast("long"), F.sum("v").over(upto),
        F.max("v").over(W.partitionBy("k")),
    )
    args = (("k",), "t", ("i",))
    cut = O.bucketed_next(skewed, *args, "nx", bucket)
    cut = O.bucketed_previous(cut, *args, "pv", bucket)
    cut = O.bucketed_row_number(cut, *args, "rn", bucket)
    cut = O.bucketed_running_sum(cut, *args, "v", "run", bucket, {"top": "v"})
    got = cut.select("i", "nx", "pv", F.col("rn").cast("long"), "run", "top")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


def test_first_per_group(skewed):
    got = O.first_per_group(skewed, ["k"], [F.col("t"), F.col("i")])
    w = W.partitionBy("k").orderBy("t", "i")
    want = skewed.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
