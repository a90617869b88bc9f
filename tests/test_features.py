import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegrid.grid import Grid
from tidegrid.operators.features import aqi_tier, feature_table, history_features
from tidegrid.operators.scaling import (
    minmax_fit,
    minmax_inverse,
    minmax_scale,
    read_bounds,
    select_features,
)
from tidegrid.operators.sequences import sequence_windows
from tidegrid.operators.splitting import check_ratios, cv_folds, time_split

START = dt.datetime(2024, 1, 1)
SCHEMA = "series_id string, ts timestamp_ntz, target double"


@pytest.fixture(scope="module")
def walk(spark):
    rng = np.random.default_rng(3)
    rows = [
        (name, START + dt.timedelta(hours=i), float(v))
        for name in ("a", "b")
        for i, v in enumerate(rng.normal(50, 20, 150))
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_tier_limits(spark):
    values = [0.0, 12.0, 12.1, 35.4, 35.5, 55.4, 55.5, 150.4, 150.5, 250.4, 250.5, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.t for r in df.select(aqi_tier(F.col("v")).alias("t")).collect()]
    assert got == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


@pytest.mark.parametrize("chunk,shift,windows", [(30, 0, (3, 24)), (64, 1, (6, 60))])
def test_history_equals_pandas(walk, chunk, shift, windows):
    """Chunked lags and rolling values, by lags and by frames, equal the plain ones."""
    df = history_features(walk, Grid(chunk_cells=chunk), mean_windows=windows,
                          std_windows=windows, shift=shift)
    got = df.toPandas().sort_values(["series_id", "ts"]).reset_index(drop=True)
    for name, part in got.groupby("series_id"):
        target = part.target.reset_index(drop=True)
        for k in (1, 3, 6, 12, 24):
            np.testing.assert_array_equal(part[f"lag_{k}h"], target.shift(k))
        for w in windows:
            rolling = target.shift(shift).rolling(w)
            np.testing.assert_allclose(part[f"rolling_mean_{w}h"], rolling.mean(), rtol=1e-9)
            np.testing.assert_allclose(part[f"rolling_std_{w}h"], rolling.std(), rtol=1e-7)


def test_feature_table_drops_incomplete_rows(spark, walk):
    table = feature_table(walk, Grid(chunk_cells=50))
    assert table.count() == 2 * (150 - 24)
    hole = walk.withColumn("aux", F.when(F.col("ts") != START + dt.timedelta(hours=100), 1.0))
    assert feature_table(hole, Grid(chunk_cells=50)).count() == 2 * (150 - 24 - 1)
    assert not [c for c in table.columns if c.startswith("_")]


def test_ratios():
    check_ratios(0.7, 0.1, 0.2)
    with pytest.raises(ValueError):
        check_ratios(0.7, 0.1, 0.1)


@pytest.mark.parametrize("n", [10, 29, 33])
def test_split_truncates(spark, n):
    rows = [("a", START + dt.timedelta(hours=i), 1.0) for i in range(n)]
    df = time_split(spark.createDataFrame(rows, SCHEMA), Grid(chunk_cells=7))
    got = [(r.split, r.split_row) for r in df.orderBy("ts").collect()]
    train, val = int(n * 0.7), int(n * 0.1)
    expected = [("train", i + 1) for i in range(train)]
    expected += [("val", i + 1) for i in range(val)]
    expected += [("test", i + 1) for i in range(n - train - val)]
    assert got == expected


def test_split_joins_without_a_sort(spark):
    rows = [("a", START + dt.timedelta(hours=i), 1.0) for i in range(40)]
    plan = time_split(spark.createDataFrame(rows, SCHEMA), Grid(chunk_cells=7))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "SortMergeJoin" not in physical and "BroadcastHashJoin" in physical


@pytest.mark.parametrize("n", [4, 17])
def test_folds(spark, n):
    rows = [("a", START + dt.timedelta(hours=i), float(i)) for i in range(n)]
    df = cv_folds(spark.createDataFrame(rows, SCHEMA), Grid(chunk_cells=5), n_splits=3)
    tiles = [len(t) for t in np.array_split(np.arange(n), 4)]
    edges = np.cumsum([0, *tiles])
    got = {(r.fold, r.role, r.target) for r in df.collect()}
    expected = set()
    for fold in (1, 2, 3):
        expected |= {(fold, "train", float(i)) for i in range(edges[fold])}
        expected |= {(fold, "val", float(i)) for i in range(edges[fold], edges[fold + 1])}
    assert got == expected


def test_select_features(spark):
    df = spark.createDataFrame(
        [(1, True, "3", "x", "1.5"), (2, False, "oops", "y", None)],
        "n int, b boolean, t string, words string, d string",
    )
    typed, features = select_features(df)
    assert features == ["n", "b", "t", "d"]
    assert [tuple(r) for r in typed.select(*features).collect()] == [
        (1, 1, 3.0, 1.5),
        (2, 0, None, None),
    ]
    many = spark.range(50).select(F.col("id").cast("string").alias("s"), "id")
    assert select_features(many)[1] == ["id"]


def test_scaling_by_train_rows(spark):
    df = spark.createDataFrame(
        [("train", 0.0, 5.0), ("train", 10.0, 5.0), ("test", 20.0, 6.0)],
        "split string, x double, c double",
    )
    bounds = read_bounds(minmax_fit(df, ["x", "c"]))
    assert bounds == {"x": (0.0, 10.0), "c": (5.0, 5.0)}
    scaled = minmax_scale(df, bounds)
    assert [(r.x, r.c) for r in scaled.collect()] == [(0.0, 0.0), (1.0, 0.0), (2.0, 1.0)]
    back = minmax_inverse(scaled, "c", bounds["c"], "again")
    assert [r.again for r in back.collect()] == [5.0, 5.0, 6.0]


def test_sequences_equal_brute_force(spark):
    n, length = 40, 5
    rows = [("a", i + 1, float(i), float(i * i), "train") for i in range(n)]
    df = spark.createDataFrame(
        rows, "series_id string, split_row bigint, u double, v double, split string"
    )
    got = sequence_windows(df, ["u", "v"], Grid(chunk_cells=6), length=length)
    table = {r.split_row: r.window for r in got.collect()}
    assert sorted(table) == list(range(length + 1, n + 1))
    for row, window in table.items():
        i = row - 1
        assert window == [[float(k), float(k * k)] for k in range(i - length, i)]




@pytest.mark.parametrize(("w", "shift", "chunk"), [(720, 0, 1024), (50, 1, 64), (49, 0, 7)])
def test_long_windows_equal_pandas(spark, w, shift, chunk):
    """Windows beyond the lags, over holes and far from zero."""
    rng = random.Random(w)
    start = dt.datetime(2024, 1, 1)
    values = {name: [1e6 + rng.gauss(0, 3) if rng.random() > 0.002 else None for _ in range(1700)] for name in ("a", "b")}
    rows = [(name, start + dt.timedelta(hours=i), v) for name, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, target double")
    out = history_features(df, Grid(chunk_cells=chunk), lags=(), mean_windows=(w,), std_windows=(w,), shift=shift)
    got = out.orderBy("series_id", "ts").toPandas()
    for name, vs in values.items():
        rolled = pd.Series(vs, dtype=float).shift(shift).rolling(w)
        mine = got[got.series_id == name]
        np.testing.assert_allclose(mine[f"rolling_mean_{w}h"].astype(float), rolled.mean(), rtol=1e-12)
        np.testing.assert_allclose(mine[f"rolling_std_{w}h"].astype(float), rolled.std(), rtol=1e-5)
    assert got[f"rolling_mean_{w}h"].notna().any()
