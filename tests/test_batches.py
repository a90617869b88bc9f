import datetime as dt
import random

import pytest

from tidegrid.grid import Grid
from tidegrid.operators.features import feature_table
from tidegrid.plans.batches import LOOK_BACK, SeriesState, transform_batch, transform_batches
from tidegrid.plans.cleaning import clean_readings
from tidegrid.plans.dataset import Fitted, scaled_features

START = dt.datetime(2023, 1, 1)
SCHEMA = "series_id string, ts timestamp_ntz, target double, aux double, weather_code string"
DAY = Grid(freq_seconds=86_400, chunk_cells=64)
FEATURES = ["aux", "weather_code", "lag_1h", "lag_24h", "rolling_mean_24h", "rolling_std_6h", "month"]
LIMIT = 3


def rows(rng):
    """Three daily series with holes beyond the limit, one of which begins late."""
    out = []
    for name, first, last in (("a", 0, 820), ("b", 30, 800), ("c", 500, 815)):
        missing = 0
        for day in range(first, last):
            missing = missing - 1 if missing else (rng.randrange(2, 12) if rng.random() < 0.03 else 0)
            if missing:
                continue
            value = None if rng.random() < 0.1 else round(rng.random() * 50, 3)
            out.append((name, START + dt.timedelta(days=day), value, float(day % 17), rng.choice(["1", "2", None])))
    return out


@pytest.fixture(scope="module")
def readings(spark):
    return spark.createDataFrame(rows(random.Random(12)), SCHEMA)


@pytest.fixture(scope="module")
def fitted(spark):
    encoding = spark.createDataFrame([("1", 0), ("2", 1), ("nan", 2)], "label string, code int")
    return Fitted("target", FEATURES, {c: (0.0, 10.0) for c in [*FEATURES, "target"]}, encoding)


def cut(readings, *days):
    times = [START + dt.timedelta(days=d) for d in days]
    return [readings.filter(f"ts >= '{a}' AND ts < '{b}'") for a, b in zip(times, times[1:])]


def collected(df):
    return {(r.series_id, r.ts): tuple(round(x, 9) for x in r[2:]) for r in df.collect()}


def one_run(readings, fitted):
    cleaned, _ = clean_readings(readings, DAY, LIMIT, encoding=fitted.encoding, snap=False)
    return collected(scaled_features(feature_table(cleaned, DAY, "target"), fitted, DAY))


def test_last_batch_equals_one_run(spark, readings, fitted):
    """Gaps, medians, lags and rolling values over the borders of three batches."""
    parts = cut(readings, 0, 400, 641, 900)
    state = None
    for part in parts[:-1]:
        given, state = transform_batch(part, fitted, state, DAY, LIMIT)
        assert given.count() > 0
    last, _ = transform_batch(parts[-1], fitted, state, DAY, LIMIT, flush=True)
    whole = one_run(readings, fitted)
    found = collected(last)
    done = {r.series_id: r._done for r in state.marks.collect()}
    epoch = dt.datetime(1970, 1, 1)
    assert found == {k: v for k, v in whole.items() if (k[1] - epoch).days > done.get(k[0], -1)}
    assert len(found) > 400


def test_batches_give_each_row_once(spark, readings, fitted):
    got = transform_batches(cut(readings, 0, 300, 305, 306, 900), fitted, DAY, LIMIT)
    keys = [(r.series_id, r.ts) for r in got.collect()]
    assert len(keys) == len(set(keys)) and set(keys) == set(one_run(readings, fitted))


def test_state_is_small_and_published_whole(spark, readings, fitted, tmp_path):
    path = str(tmp_path / "state")
    assert SeriesState.load(spark, path) is None
    parts = cut(readings, 0, 641, 900)
    _, state = transform_batch(parts[0], fitted, None, DAY, LIMIT)
    state.save(path)
    sizes = state.tail.groupBy("series_id").count().collect()
    assert max(r["count"] for r in sizes) <= 2 * (LOOK_BACK + LIMIT)
    # a save that did not come to its end does not count
    state.marks.limit(0).write.parquet(f"{path}/2/marks")
    loaded = SeriesState.load(spark, path)
    ours, _ = transform_batch(parts[1], fitted, state, DAY, LIMIT, flush=True)
    theirs, _ = transform_batch(parts[1], fitted, loaded, DAY, LIMIT, flush=True)
    assert collected(ours) == collected(theirs)
    loaded.save(path)
    assert SeriesState.load(spark, path).marks.count() == 3


def test_an_empty_batch_changes_nothing(spark, readings, fitted):
    parts = cut(readings, 0, 300, 300)
    _, state = transform_batch(parts[0], fitted, None, DAY, LIMIT)
    none, again = transform_batch(parts[1], fitted, state, DAY, LIMIT)
    assert none.count() == 0
    assert sorted(again.marks.collect()) == sorted(state.marks.collect())
    total = "sum(_n)"
    assert again.pools.selectExpr(total).first() == state.pools.selectExpr(total).first()
