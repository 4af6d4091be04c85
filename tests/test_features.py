import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.operators.features import (forward_fill, ffill_zeros, run_feature_steps,
                                          smoothed_increment, time_bucket_avg)


def _series(spark, values, key="a"):
    return spark.createDataFrame([(key, i, float(v) if v is not None else None) for i, v in enumerate(values)],
                                 "sn string, t long, c double")


def test_counter_reset_example(spark):
    # 5,9,4,2,8,8,1 -> (first row dropped) 4,4,4,6,0,0
    out = smoothed_increment(_series(spark, [5, 9, 4, 2, 8, 8, 1]), "sn", "t", ["c"]).orderBy("t")
    assert [r.c for r in out.collect()] == [4.0, 4.0, 4.0, 6.0, 0.0, 0.0]


def test_increment_two_entities_interleaved(spark):
    a = _series(spark, [1, 2, 4, 7], "a")
    b = _series(spark, [10, 20, 5, 6], "b")
    out = smoothed_increment(a.unionByName(b), "sn", "t", ["c"]).orderBy("sn", "t").collect()
    assert [(r.sn, r.c) for r in out] == [("a", 1.0), ("a", 2.0), ("a", 3.0),
                                          ("b", 10.0), ("b", 10.0), ("b", 1.0)]


def test_ffill_zeros_leading_stays_null(spark):
    out = ffill_zeros(_series(spark, [0, 0, 3, 0, None, 5, 0]), "sn", "t", ["c"]).orderBy("t")
    assert [r.c for r in out.collect()] == [None, None, 3.0, 3.0, 3.0, 5.0, 5.0]


def test_forward_fill_fallback_counts_zeros(spark):
    a = _series(spark, [0, 0, 4], "a")          # mean over all rows incl. zeros = (0+0+4+8)/4 = 3
    b = _series(spark, [8], "b")
    out = forward_fill(a.unionByName(b), "sn", "t", ["c"]).orderBy("sn", "t").collect()
    assert [r.c for r in out] == [3.0, 3.0, 4.0, 8.0]
    out2 = forward_fill(a.unionByName(b), "sn", "t", ["c"], fallback_excludes_zero=True).orderBy("sn", "t")
    assert [r.c for r in out2.collect()][:2] == [6.0, 6.0]


def test_bucket_average_carries_first_non_null(spark):
    df = spark.createDataFrame([("a", 0, 1.0, None), ("a", 0, 2.0, "x"), ("a", 1, 4.0, "y")],
                               "sn string, t long, c double, m string")
    out = time_bucket_avg(df, "sn", "t", ["c"]).orderBy("t").collect()
    assert [(r.c, r.m) for r in out] == [(1.5, "x"), (4.0, "y")]


def test_step_runner_prerequisites(spark):
    df = _series(spark, [5, 9, 4, 2, 8, 8, 1])
    only_log = run_feature_steps(df, "sn", "t", ["c"], steps=("log",)).orderBy("t")
    assert len(only_log.collect()) == 6  # hourly + incr ran first (first row dropped)
    with pytest.raises(ValueError):
        run_feature_steps(df, "sn", "t", ["c"], steps=("bogus",))
