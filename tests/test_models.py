import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from compare import difference
from tidegrid.grid import Grid
from tidegrid.operators import models
from tidegrid.operators.forecasting import (
    origins,
    recursive_linear,
    recursive_model,
    recursive_window_linear,
    recursive_window_model,
    window_origins,
)
from tidegrid.operators.models import estimator, train_model, train_staged
from tidegrid.operators.sequences import sequence_windows
from tidegrid.operators.window_linear import train_window_linear
from tidegrid.plans.dataset import prepare_dataset, transform_new
from tidegrid.plans.training import run_training
from tidegrid.session import settle
from tidegrid.sources.artifacts import load_metrics, load_model, load_processor, save_processor

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def readings(spark):
    rng = random.Random(4)
    rows = [
        (name, START + dt.timedelta(hours=i), 50 + 20 * math.sin(i / 4) + rng.random(), str(i % 3))
        for name in ("a", "b")
        for i in range(160)
        if rng.random() > 0.05
    ]
    return spark.createDataFrame(
        rows, "series_id string, ts timestamp_ntz, target double, weather_code string"
    )


def test_unknown_model():
    with pytest.raises(ValueError):
        estimator("prophet")


def test_training_saves_and_reloads(spark, readings, tmp_path):
    base = str(tmp_path / "out")
    run = run_training(readings, "Random_Forest", save_to=base, trees=5, depth=4)
    metrics = {(r.stage, r.metric): r.value for r in run.metrics.collect()}
    assert len(metrics) == 3 * 12
    assert metrics["single_step_metrics", "r2"] > 0.5
    assert metrics["train_metrics", "mae"] == metrics["single_step_metrics", "mae"]
    saved = load_metrics(spark, f"{base}/metrics", "stage string, metric string, value double")
    assert {(r.stage, r.metric): r.value for r in saved.collect()} == metrics

    fitted = load_processor(spark, f"{base}/processors")
    assert fitted.features == run.fitted.features and fitted.bounds == run.fitted.bounds
    before = transform_new(readings, run.fitted).orderBy("series_id", "ts").collect()
    after = settle(transform_new(readings, fitted))
    assert after.orderBy("series_id", "ts").collect() == before

    model = load_model(f"{base}/models")
    ours = run.model.transform(after).agg(F.sum("prediction")).first()[0]
    theirs = model.transform(after).agg(F.sum("prediction")).first()[0]
    assert math.isclose(ours, theirs)
    assert run.forecast.filter("predicted IS NULL").count() == 0
    assert spark.read.parquet(f"{base}/reports/drift").count() == len(fitted.features) + 1


def test_text_features_survive_saving(spark, readings, tmp_path):
    mood = (F.hour("ts") % 3).cast("string")
    _, fitted = prepare_dataset(readings.withColumn("mood", mood))
    assert fitted.texts == ["mood"]
    save_processor(spark, fitted, str(tmp_path / "p"))
    fresh = readings.withColumn("mood", F.when(F.hour("ts") == 5, "x").otherwise(mood))
    out = transform_new(fresh, load_processor(spark, str(tmp_path / "p")))
    found = out.select("mood", (F.hour("ts") == 5).alias("unreadable")).collect()
    assert found and all((r.mood is None) == r.unreadable for r in found)


def test_sequence_training(readings):
    run = run_training(readings, "lstm", length=6, trees=3, depth=3)
    rows = run.forecast.collect()
    assert min(r.split_row for r in rows) == 1
    assert all(math.isfinite(r.predicted) for r in rows)


def test_recursion_by_model_equals_recursion_by_fold(spark):
    rng = random.Random(9)
    rows = [("a", START + dt.timedelta(hours=i), rng.random()) for i in range(60)]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, target double")
    starts = settle(origins(df, Grid(chunk_cells=30)))
    assert starts.count() == 60 - 23
    latest = starts.orderBy("origin").first().history
    assert latest == [r[2] for r in rows[:24]][::-1]

    features = ["lag_1h", "lag_24h", "rolling_mean_3h"]
    train = spark.createDataFrame(
        [("train", *(rng.random() for _ in range(4))) for _ in range(50)],
        "split string, lag_1h double, lag_24h double, rolling_mean_3h double, target double",
    )
    model = train_model(train, "linear", features)
    fitted = model.stages[-1]
    weights = dict(zip(features, fitted.coefficients.toArray().tolist()))
    one = recursive_linear(starts, weights, fitted.intercept, horizon=5)
    two = recursive_model(starts, model, horizon=5, settle_every=2)
    joined = one.join(two.withColumnRenamed("predicted", "other"), ["series_id", "origin", "step", "ts"])
    gaps = joined.select(F.max(F.abs(F.col("predicted") - F.col("other"))), F.count("*")).first()
    assert gaps[1] == 37 * 5 and gaps[0] < 1e-9


WINDOWED = ["target", "aux", "lag_2h", "rolling_mean_3h", "rolling_std_3h", "hour", "pm2_5_tier"]
LENGTH = 5


def windowed_rows(n=40, names=("a", "b")):
    rng = random.Random(6)
    return [
        (name, START + dt.timedelta(hours=i), *[float(rng.randrange(1, 90)) for _ in WINDOWED])
        for name in names
        for i in range(n)
    ]


def tier(value):
    return float(sum(value > limit for limit in (12.0, 35.4, 55.4, 150.4, 250.4)))


def stepped(window, origin, weights, intercept, horizon):
    """The recursion row by row."""
    window, out = [list(r) for r in window], []
    for k in range(1, horizon + 1):
        p = intercept + sum(w * x for row, ws in zip(window, weights) for x, w in zip(row, ws))
        history = [p, *[r[0] for r in reversed(window)]]
        mean = sum(history[:3]) / 3
        std = math.sqrt(sum((v - mean) ** 2 for v in history[:3]) / 2)
        hour = float((origin + dt.timedelta(hours=k)).hour)
        window = [*window[1:], [p, window[-1][1], history[2], mean, std, hour, tier(p)]]
        out.append(p)
    return out


def test_window_recursion_equals_loop(spark):
    schema = "series_id string, ts timestamp_ntz, " + ", ".join(f"`{c}` double" for c in WINDOWED)
    rows = windowed_rows()
    # a missing row and an incomplete one: no window reaches over them
    rows = [r if r[1].day == 1 or r[1].hour != 3 else (*r[:3], None, *r[4:]) for r in rows if r[:2] != ("b", rows[10][1])]
    df = spark.createDataFrame(rows, schema)
    weights = [[0.03 * (1 + (i + j) % 4) for j in range(len(WINDOWED))] for i in range(LENGTH)]
    starts = window_origins(df, WINDOWED, Grid(chunk_cells=8), LENGTH)
    known = {(r[0], r[1]): list(r[2:]) for r in rows if None not in r}
    spans = {}
    for name, ts in known:
        times = [ts - dt.timedelta(hours=LENGTH - 1 - k) for k in range(LENGTH)]
        if all((name, t) in known for t in times):
            spans[name, ts] = [known[name, t] for t in times]
    assert {(r.series_id, r.origin): [list(x) for x in r.window] for r in starts.collect()} == spans
    got = {}
    for r in recursive_window_linear(starts, WINDOWED, weights, 2.0, horizon=6).collect():
        got.setdefault((r.series_id, r.origin), {})[r.step] = r.predicted
    for key, window in spans.items():
        wanted = stepped(window, key[1], weights, 2.0, 6)
        assert [got[key][k] for k in range(1, 7)] == pytest.approx(wanted, rel=1e-9)


def test_window_model_recursion_equals_linear(spark):
    """A fitted linear model on scaled windows, step by step and as one fold."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import LinearRegression

    schema = "series_id string, ts timestamp_ntz, " + ", ".join(f"`{c}` double" for c in WINDOWED)
    df = spark.createDataFrame(windowed_rows(), schema)
    starts = settle(window_origins(df, WINDOWED, Grid(), LENGTH))
    samples = starts.select(array_to_vector(F.flatten("window")).alias("features"), F.element_at(F.element_at("window", 1), 1).alias("y"))
    model = Pipeline(stages=[LinearRegression(labelCol="y", regParam=0.5)]).fit(samples)
    fitted = model.stages[-1]
    flat = [float(w) for w in fitted.coefficients]
    weights = [flat[i : i + len(WINDOWED)] for i in range(0, len(flat), len(WINDOWED))]
    keys = ("series_id", "origin", "step", "ts")

    def collected(table):
        return {tuple(r[k] for k in keys): r.predicted for r in table.collect()}

    one = collected(recursive_window_linear(starts, WINDOWED, weights, float(fitted.intercept), horizon=5))
    two = collected(recursive_window_model(starts, model, WINDOWED, horizon=5, length=LENGTH, settle_every=2))
    assert one.keys() == two.keys() and all(math.isclose(one[k], two[k], rel_tol=1e-6, abs_tol=1e-6) for k in one)
    # scaling what the model sees changes what it says, but for the identity
    same = recursive_window_model(starts, model, WINDOWED, horizon=5, length=LENGTH, bounds={c: (0.0, 1.0) for c in WINDOWED})
    assert all(math.isclose(v, two[k], rel_tol=1e-6, abs_tol=1e-6) for k, v in collected(same).items())


def test_window_recursion_refuses_what_it_cannot_know(spark):
    starts = spark.createDataFrame([], "series_id string, origin timestamp_ntz, window array<array<double>>")
    with pytest.raises(ValueError):
        recursive_window_linear(starts, ["target", "lag_24h"], [[0.0, 0.0]] * 3)
    with pytest.raises(ValueError):
        recursive_window_linear(starts, ["aux"], [[0.0]] * 3)


def test_staged_validation_cuts_the_ensemble(spark):
    """Noise makes more trees worse on the validation rows; the cut model is their prefix."""
    rng = random.Random(1)
    rows = [(("train", "val", "test")[i % 3], float(x), float(x > 5) + rng.gauss(0, 1)) for i in range(600) for x in [rng.randrange(11)]]
    df = spark.createDataFrame(rows, "split string, x double, target double")
    model, table = train_staged(df, ["x"], trees=12, depth=4)
    errors = {r.trees: (r.train_error, r.val_error, r.kept) for r in table.collect()}
    assert sorted(errors) == list(range(1, 13))
    kept = [k for k, (_, _, is_kept) in errors.items() if is_kept]
    assert len(kept) == 1 and errors[kept[0]][1] == min(v for _, v, _ in errors.values()) and kept[0] < 12
    assert model.stages[-1].getNumTrees == kept[0]
    wrong = model.transform(df.filter("split = 'val'")).select(F.avg((F.col("prediction") - F.col("target")) ** 2)).first()[0]
    assert math.isclose(wrong, errors[kept[0]][1], rel_tol=1e-9)
    whole, table = train_staged(df.filter("split <> 'val'"), ["x"], trees=3, depth=2)
    assert whole.stages[-1].getNumTrees == 3 and [r.kept for r in table.orderBy("trees").collect()] == [False, False, True]


def test_importance_is_of_all_features_in_forests_of_full_size(spark, monkeypatch):
    sf, forests, train = "/root/testdata/sf0.001", [], models.train_model

    def kept(*args, **params):
        forests.append(train(*args, **params))
        return forests[-1]

    monkeypatch.setattr(models, "train_model", kept)
    query = entry.queries()["feature_importance"]
    found = {r.feature: r for r in query(spark, sf).collect()}
    table = entry.queries()["feature_table"](spark, sf)
    assert sorted(found) == sorted(set(table.columns) - {"series_id", "ts", "target"})
    assert all(r.not_negative and r.shares_sum_to_one for r in found.values())
    ranked = sorted((r.rank, name) for name, r in found.items() if r.rank is not None)
    assert ranked == [(1, "sin_hour"), (2, "cos_hour"), (3, "weather_code")]
    sizes = [m.stages[-1] for m in forests]
    assert {(m.getNumTrees, m.getMaxDepth()) for m in sizes} == {(models.TREES, models.DEPTH)}
    assert max(m.numFeatures for m in sizes) == len(found)
    monkeypatch.undo()
    assert difference(spark, sf, query, entry.oracle_sql()["feature_importance"]) is None


def test_window_linear_equals_a_fit_on_windows(spark):
    """Series of many lengths, chunks shorter and longer than the window, two splits."""
    rng = np.random.default_rng(4)
    rows = []
    for name, n in (("a", 70), ("b", 4), ("c", 5), ("d", 6), ("e", 33), ("f", 8)):
        values = np.cumsum(rng.normal(0, 1, (n, 2)), 0) + 100
        rows += [(name, "train", i + 1, *map(float, v), float(v[0] * 0.5 + rng.normal())) for i, v in enumerate(values)]
        rows += [(name, "test", i + 1, 1e6, 1e6, 1e6) for i in range(9)]
    df = spark.createDataFrame(rows, "series_id string, split string, split_row int, u double, v double, target double")
    for length, chunk in ((5, 7), (3, 1000), (1, 4)):
        grid = Grid(chunk_cells=chunk)
        windows = sequence_windows(df.filter("split = 'train'"), ["u", "v"], grid, length).collect()
        x = np.array([np.ravel(r.window) for r in windows])
        y = np.array([r.target for r in windows])
        model = train_window_linear(df, ["u", "v"], grid, length)
        assert model.rows == len(windows) and len(model.weights) == length
        wanted = np.linalg.lstsq(np.column_stack([x, np.ones(len(x))]), y, rcond=None)[0]
        assert np.ravel(model.weights) == pytest.approx(wanted[:-1], rel=1e-5, abs=1e-6)
        assert model.intercept == pytest.approx(wanted[-1], rel=1e-4, abs=1e-4)
    with pytest.raises(ValueError):
        train_window_linear(df, ["u"], Grid(), 500)
