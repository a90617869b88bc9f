import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.functions.quantiles import exact_quantiles
from tidegrid.operators.drift import drift_report, drift_summary, target_boxplot, target_shift
from tidegrid.operators.quality import (
    clip_outliers,
    correlation_matrix,
    dtype_counts,
    duplicate_rows,
    iqr_outliers,
    missing_values,
)
from tidegrid.operators.scoring import forecast_metrics, histogram


@pytest.mark.parametrize("limit", [10, 100_000])
def test_quantiles_with_and_without_narrowing(spark, limit):
    """Skewed values, heavy ties and a constant, above and below the limit."""
    rng = np.random.default_rng(5)
    n = 4000
    columns = {
        "skewed": np.exp(rng.normal(0, 4, n)),
        "tied": rng.integers(0, 3, n).astype(float),
        "mixed": np.where(rng.random(n) < 0.4, 7.0, rng.normal(0, 100, n)),
        "constant": np.full(n, 2.5),
    }
    rows = list(zip(*[c.tolist() for c in columns.values()]))
    df = spark.createDataFrame(rows, list(columns)).repartition(4)
    probs = (0.0, 0.1, 0.25, 0.5, 0.999, 1.0)
    got = exact_quantiles(df, {c: F.col(c) for c in columns}, probs, limit, accuracy=50)
    for name, values in columns.items():
        np.testing.assert_allclose(got[name], np.quantile(values, probs), rtol=1e-12)


@pytest.mark.parametrize("limit", [60, 100_000])
def test_many_measures_share_the_limit(spark, limit):
    rng = np.random.default_rng(6)
    values = rng.normal(size=(400, 60)).round(2)
    df = spark.createDataFrame(values.tolist(), [f"c{i}" for i in range(60)])
    got = exact_quantiles(df, {c: F.col(c) for c in df.columns}, (0.25, 0.75), limit, accuracy=50)
    for i in range(60):
        np.testing.assert_allclose(got[f"c{i}"], np.quantile(values[:, i], (0.25, 0.75)), rtol=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(df, {"v": F.col("v")}, (0.5,)) == {"v": [None]}


def test_outliers_and_clipping(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = iqr_outliers(df, ["v"]).first()
    assert (row.q1, row.q3, row.outliers) == (2.0, 4.0, 1)
    assert [r.v for r in clip_outliers(df, ["v"]).collect()] == [1.0, 2.0, 3.0, 4.0, 7.0, None]


def test_correlation_equals_numpy(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(1e6, 1, 500)
    rows = [
        (float(x), float(2 * x + rng.normal()), None if i % 5 == 0 else float(-x + rng.normal()), 3.0)
        for i, x in enumerate(a)
    ]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double")
    got = {
        (r.column_a, r.column_b): r.correlation
        for r in correlation_matrix(df, ["a", "b", "c", "k"]).collect()
    }
    assert len(got) == 16
    full = np.array([r[:2] for r in rows])
    assert math.isclose(got["a", "b"], np.corrcoef(full.T)[0, 1], rel_tol=1e-9)
    present = np.array([(r[0], r[2]) for r in rows if r[2] is not None])
    assert math.isclose(got["c", "a"], np.corrcoef(present.T)[0, 1], rel_tol=1e-9)
    assert got["a", "a"] == 1.0
    assert got["k", "k"] is None and got["a", "k"] is None


def test_correlation_of_a_wide_table_reads_it_once(spark):
    """300 columns with holes, over partitions whose means are far apart."""
    rng = np.random.default_rng(8)
    values = rng.normal(0, 1, (240, 300)) + np.repeat([0, 1e5, -3e4, 7.0], 60)[:, None] * (np.arange(300) % 3 == 0)
    values[:, 1] = 2.5
    holes = rng.random(values.shape) < 0.2
    # constant where the other is present
    values[:, 4] = np.where(holes[:, 5], values[:, 4], 0.1)
    holes[:, 4] = False
    rows = [[None if h else float(v) for v, h in zip(*r)] for r in zip(values, holes)]
    names = [f"c{i}" for i in range(300)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names)).repartition(5)
    seen = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    got = {(r.column_a, r.column_b): r.correlation for r in correlation_matrix(df.mapInArrow(counting, df.schema), names).collect()}
    assert len(got) == 300 * 300 and seen.value == 240
    frame = np.where(holes, np.nan, values)
    for a, b in [(0, 3), (0, 2), (7, 9), (250, 13), (299, 298), (6, 6)]:
        both = ~(np.isnan(frame[:, a]) | np.isnan(frame[:, b]))
        assert math.isclose(got[f"c{a}", f"c{b}"], np.corrcoef(frame[both, a], frame[both, b])[0, 1], rel_tol=1e-7)
        assert got[f"c{a}", f"c{b}"] == got[f"c{b}", f"c{a}"]
    assert got["c1", "c1"] is None and got["c1", "c0"] is None
    assert got["c4", "c5"] is None and got["c4", "c6"] is not None


def test_correlation_of_nothing(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    for table in (df, df.limit(0)):
        assert [r.correlation for r in correlation_matrix(table, ["a", "b"]).collect()] == [None] * 4


def test_missing_and_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2.0)], "a int, b double")
    rows = {r.column: (r.missing_count, r.missing_pct) for r in missing_values(df, ["a", "b"]).collect()}
    assert rows == {"a": (0, 0.0), "b": (2, 66.67)}
    assert duplicate_rows(df, ["a", "b"]).first().duplicate_rows == 1
    assert dtype_counts(df) == {"int": 1, "double": 1}


def test_drift_limits(spark):
    rows = [("train", 10.0, 0.0, 1.0), ("train", 20.0, 0.0, 1.0)]
    rows += [("test", 13.0, 5.0, 1.2), ("test", 23.0, 5.0, 1.2)]
    df = spark.createDataFrame(rows, "split string, a double, zero double, b double")
    report = drift_report(df, ["a", "zero", "b"])
    got = {r.column: (r.mean_change_pct, r.drift_detected) for r in report.collect()}
    assert got["a"] == (20.0, False)
    assert got["zero"] == (0.0, False)
    assert math.isclose(got["b"][0], 20.0) and got["b"][1] == (got["b"][0] > 20)
    assert drift_summary(report).first().checked_columns == 3
    shift = target_shift(df, "a").first()
    assert shift.shift_pct == 20.0 and shift.alert


def test_boxplot_whiskers(spark):
    rows = [("train", float(v)) for v in (1, 2, 3, 4, 100)] + [("test", 5.0)]
    df = spark.createDataFrame(rows, "split string, v double")
    got = {r.split: r for r in target_boxplot(df, "v").collect()}
    assert (got["train"].whisker_low, got["train"].whisker_high) == (1.0, 4.0)
    assert got["train"].outliers == 1
    assert got["test"].median == got["test"].whisker_high == 5.0


def test_metrics_conventions(spark):
    df = spark.createDataFrame(
        [("m", 1.0, 2.0), ("m", 2.0, 2.0), ("c", 3.0, 3.0), ("d", 3.0, 4.0), ("d", 3.0, 4.0)],
        "g string, actual double, predicted double",
    )
    got = {r.g: r for r in forecast_metrics(df, by=["g"]).collect()}
    assert (got["m"].mae, got["m"].mape, got["m"].mse, got["m"].r2) == (0.5, 0.5, 0.5, -1.0)
    assert got["m"].rmse == 0.707107 and got["m"].accuracy == 0.5
    assert got["c"].r2 == 1.0 and got["d"].r2 == 0.0


def test_histogram_equals_numpy(spark):
    values = np.random.default_rng(0).normal(size=300)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    rows = histogram(df, "v", bins=7).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=7)
    assert [r.n for r in rows] == counts.tolist()
    np.testing.assert_allclose([r.bin_start for r in rows], edges[:-1])
    density, _ = np.histogram(values, bins=7, density=True)
    np.testing.assert_allclose([r.density for r in rows], density)
    same = histogram(df.select(F.lit(2.0).alias("v")), "v", bins=3).orderBy("bin").collect()
    assert [r.n for r in same] == [0, 300, 0]
