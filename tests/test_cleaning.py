import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegrid.grid import Grid
from tidegrid.operators.encoding import encode, fit_encoding, rank_in_ranges
from tidegrid.operators import gaps
from tidegrid.operators.gaps import counted_medians, fill_seasonal, interpolate
from tidegrid.operators.naming import drop_columns, normalize_columns, resolve_target
from tidegrid.operators.regrid import (
    collapse_duplicates,
    nan_to_null,
    parse_time,
    regrid,
    snap_regular_offset,
)
from tidegrid.plans.cleaning import clean_raw, clean_readings
from tidegrid.sources.readings import as_series, scan_readings

START = dt.datetime(2024, 1, 1)
SCHEMA = "series_id string, ts timestamp_ntz, target double"


def hours(n, minutes=0):
    return START + dt.timedelta(hours=n, minutes=minutes)


def series(spark, values, name="a"):
    rows = [(name, hours(i), v) for i, v in enumerate(values) if v is not None]
    return spark.createDataFrame(rows, SCHEMA)


def values_of(df, column="target"):
    return [r[column] for r in df.orderBy("series_id", "ts").collect()]


def test_normalize_and_drop(spark):
    raw = spark.createDataFrame(
        [(1.0, 2.0, 3, 4.0)],
        ["pm2_5 (μg/m³)", "snowfall (cm)", "weather_code ()", "methane_μg/m³"],
    )
    named = normalize_columns(raw)
    assert named.columns == ["pm2_5_(μg/m³)", "snowfall_(cm)", "weather_code", "methane_μg/m³"]
    assert drop_columns(named).columns == ["pm2_5_(μg/m³)", "weather_code"]


def test_resolve_target():
    assert resolve_target(["x", "pm2_5_(μg/m³)"], "pm2_5 (μg/m³)") == "pm2_5_(μg/m³)"
    with pytest.raises(ValueError):
        resolve_target(["x"], "y")


def test_parse_time_drops_unreadable(spark):
    raw = spark.createDataFrame([("2024-01-01 05:00:00", 1.0), ("soon", 2.0)], ["t", "v"])
    rows = parse_time(raw, "t").collect()
    assert [(r.ts, r.v) for r in rows] == [(hours(5), 1.0)]


def test_csv_source(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("time,pm2_5 (μg/m³),weather_code ()\n2024-01-01 00:00:00,NaN,3\nbad,1.0,2\n")
    raw = scan_readings(
        spark, str(path), schema="time string, `pm2_5 (μg/m³)` double, `weather_code ()` int"
    )
    row = as_series(raw).collect()
    assert len(row) == 1
    assert row[0].asDict() == {
        "ts": START, "pm2_5_(μg/m³)": None, "weather_code": 3, "series_id": "all",
    }


def test_regrid_keeps_grid_rows_only(spark):
    rows = [("a", hours(0), 1.0), ("a", hours(1, 30), 9.0), ("a", hours(3), 4.0)]
    df = regrid(spark.createDataFrame(rows, SCHEMA), Grid(chunk_cells=2))
    assert values_of(df) == [1.0, None, None, 4.0]


def test_regrid_spans_empty_chunks_and_old_times(spark):
    old = dt.datetime(1969, 12, 31, 22)
    rows = [("a", old, 1.0), ("a", old + dt.timedelta(hours=9), 2.0)]
    got = regrid(spark.createDataFrame(rows, SCHEMA), Grid(chunk_cells=3)).orderBy("ts").collect()
    assert [r.ts for r in got] == [old + dt.timedelta(hours=i) for i in range(10)]
    assert [r.target for r in got] == [1.0] + [None] * 8 + [2.0]


def test_duplicates_raise_or_collapse(spark):
    df = spark.createDataFrame([("a", hours(0), 1.0), ("a", hours(0), 3.0)], SCHEMA)
    with pytest.raises(Exception, match="duplicate timestamps"):
        regrid(df).collect()
    assert values_of(regrid(collapse_duplicates(df))) == [2.0]


def test_snap_moves_complete_shifted_series(spark):
    rows = [("a", hours(i, 30), float(i)) for i in range(4)]
    rows += [("b", hours(i, 30 * (i % 2)), float(i)) for i in range(4)]
    got = snap_regular_offset(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.ts for r in got if r.series_id == "a") == [hours(i) for i in range(4)]
    assert sorted(r.ts.minute for r in got if r.series_id == "b") == [0, 0, 30, 30]


@pytest.mark.parametrize("chunk", [1, 4, 100])
def test_interpolation_limit_and_ends(spark, chunk):
    """Two leading gaps stay; a long gap is cut at the limit; the end repeats."""
    given = [1.0, None, None, None, None, None, 7.0]
    df = series(spark, given).unionByName(
        spark.createDataFrame([("a", hours(-2), None), ("a", hours(10), None)], SCHEMA)
    )
    got = values_of(interpolate(df, ["target"], Grid(chunk_cells=chunk), limit=3))
    assert got == [None, None, 1.0, 2.0, 3.0, 4.0, None, None, 7.0, 7.0, 7.0, 7.0, None]


@pytest.mark.parametrize("chunk", [7, 64, 4096])
def test_interpolation_equals_pandas(spark, chunk):
    rng = random.Random(chunk)
    rows, expected = [], []
    for name in ("a", "b", "c"):
        held = [rng.random() * 100 if rng.random() < 0.15 else None for _ in range(300)]
        held[0] = 1.0
        held[-1] = 2.0
        rows += [(name, hours(i), v) for i, v in enumerate(held) if v is not None]
        expected += pd.Series(held, dtype=float).interpolate(limit=5).tolist()
    df = spark.createDataFrame(rows, SCHEMA)
    got = values_of(interpolate(df, ["target"], Grid(chunk_cells=chunk), limit=5))
    np.testing.assert_allclose(np.array(got, dtype=float), expected, rtol=1e-12)


def test_cells_are_made_after_the_sort(spark):
    """Readings are sorted and looked at by windows; the cells of holes are only spread."""
    df = series(spark, [1.0, None, 3.0])
    for got in (interpolate(df, ["target"]), regrid(df)):
        plan = got._jdf.queryExecution().executedPlan().toString().splitlines()
        spread = next(i for i, line in enumerate(plan) if "Generate explode(sequence(_first" in line)
        assert not [line for line in plan[:spread] if any(x in line for x in ("Sort", "Window", "Aggregate", "Exchange"))]
        assert sum("Window [" in line and "_first" in line for line in plan[spread:]) == 1


@pytest.mark.parametrize("chunk", [1, 2, 5, 100])
def test_interpolation_of_odd_rows(spark, chunk):
    """Null keys and times, readings off the grid at both ends, columns with other holes, text."""
    rows = [
        (None, hours(1), 9.0, 9.0, "x"),
        ("a", None, 9.0, 9.0, "x"),
        ("a", hours(0, 20), 50.0, 50.0, "off"),
        ("a", hours(2), 1.0, None, "p"),
        ("a", hours(4), None, 8.0, None),
        ("a", hours(6), 5.0, float("nan"), "q"),
        ("a", hours(9), None, None, "r"),
        ("a", hours(11, 59), 70.0, 70.0, "off"),
        ("b", hours(3), None, None, "only"),
        ("c", hours(3, 1), 1.0, 1.0, "off"),
    ]
    df = spark.createDataFrame(rows, SCHEMA + ", aux double, note string")
    got = interpolate(df, ["target", "aux"], Grid(chunk_cells=chunk), limit=3).orderBy("series_id", "ts").collect()
    assert [(r.series_id, r.ts) for r in got] == [("a", hours(i)) for i in range(12)] + [("b", hours(3)), ("c", hours(3))]
    assert [r.target for r in got] == [None, None, 1.0, 2.0, 3.0, 4.0, 5.0, 5.0, 5.0, 5.0, None, None, None, None]
    aux = [r.aux for r in got]
    assert aux[:5] == [None] * 4 + [8.0] and np.isnan(aux[5:10]).all() and aux[10:] == [None] * 4
    assert [r.note for r in got] == [None, None, "p", None, None, None, "q", None, None, "r", None, None, "only", None]


@pytest.mark.parametrize("chunk", [1, 3, 100])
def test_repeated_times_raise_if_on_the_grid(spark, chunk):
    rows = [("a", hours(0), 1.0), ("a", hours(1, 5), 2.0), ("a", hours(1, 5), 2.0), ("a", hours(4), 3.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert values_of(interpolate(df, ["target"], Grid(chunk_cells=chunk))) == [1.0, 1.5, 2.0, 2.5, 3.0]
    for repeated in (("a", hours(0), None), ("a", hours(4), 3.0)):
        with pytest.raises(Exception, match="duplicate timestamps in series a"):
            interpolate(df.unionByName(spark.createDataFrame([repeated], SCHEMA)), ["target"], Grid(chunk_cells=chunk)).collect()


@pytest.mark.parametrize("step", [30, 600, 3_600, 21_600, 86_400])
def test_cells_of_any_step(spark, step):
    epoch, rng = dt.datetime(1970, 1, 1), random.Random(step)
    times = [epoch + dt.timedelta(microseconds=rng.randrange(-(10**15), 10**15)) for _ in range(200)]
    times += [epoch + dt.timedelta(seconds=step * k + s, microseconds=u) for k in (-3, 0, 7) for s in (0, 1) for u in (0, 1)]
    grid = Grid(freq_seconds=step)
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    got = df.select("ts", grid.cell().alias("cell"), grid.floor().alias("floor"), grid.on_grid().alias("on")).collect()
    for r in got:
        cell = (r.ts - epoch) // dt.timedelta(seconds=step)
        start = epoch + dt.timedelta(seconds=step * cell)
        assert (r.cell, r.floor, r.on) == (cell, start, r.ts == start)


def test_seasonal_fill_tiers(spark):
    def at(year, month, day):
        return dt.datetime(year, month, day)

    rows = [
        ("a", at(2020, 3, 1), 10.0),
        ("a", at(2021, 3, 1), 20.0),
        ("a", at(2022, 3, 1), None),  # same day of other years: 15
        ("a", at(2022, 3, 2), None),  # same month and hour: 15
        ("a", at(2022, 7, 2), None),  # nothing to draw on
        ("b", at(2022, 3, 1), None),  # other series do not count
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    filled = {(r.series_id, r.ts): r.target for r in fill_seasonal(df, ["target"]).collect()}
    assert filled["a", at(2022, 3, 1)] == 15.0
    assert filled["a", at(2022, 3, 2)] == 15.0
    assert filled["a", at(2022, 7, 2)] is None
    assert filled["b", at(2022, 3, 1)] is None


def test_counted_medians_of_groups_cut_into_ranges(spark):
    rng = random.Random(9)
    groups = {
        "long": [rng.gauss(0, 5) for _ in range(6001)],
        "even": [rng.random() for _ in range(4000)],
        "ties": [float(rng.randrange(3)) for _ in range(2000)],
        "halves": [-1.0] * 500 + [3.0] * 500,
        "one": [4.5],
        "two": [1.0, 2.0],
    }
    rows = [(name, v) for name, values in groups.items() for v in values]
    counts = spark.createDataFrame(rows, "k string, v double").groupBy("k", "v").count()
    got = counted_medians(counts.repartition(5), ["k"], "v", "count").collect()
    assert {r.k: r["median"] for r in got} == {k: pytest.approx(np.median(v), abs=1e-12) for k, v in groups.items()}
    assert counted_medians(counts.limit(0), ["k"], "v", "count").count() == 0


@pytest.mark.parametrize("broadcast", [0, 100_000])
def test_seasonal_fill_equals_pandas(spark, monkeypatch, broadcast):
    """Two columns with different holes, ten-minute cells, three Januaries."""
    monkeypatch.setattr(gaps, "MAX_BROADCAST_SEASONS", broadcast)
    rng = random.Random(2)
    days = [dt.datetime(year, 1, 1) + dt.timedelta(minutes=10 * k) for year in (2020, 2021, 2023) for k in range(700)]
    frame = pd.DataFrame({"ts": days, "series_id": "a"})
    for c, share in (("target", 0.5), ("aux", 0.01)):
        frame[c] = [None if rng.random() < share else rng.random() for _ in days]
    frame.loc[(frame.ts.dt.hour == 7), "target"] = None
    season = [frame.ts.dt.month, frame.ts.dt.hour]
    wanted = frame.copy()
    for c in ("target", "aux"):
        fine = frame.groupby([*season, frame.ts.dt.day])[c].transform("median")
        wanted[c] = frame[c].fillna(fine).fillna(frame.groupby(season)[c].transform("median"))
    rows = [(s, t.to_pydatetime(), *(None if pd.isna(x) else x for x in v)) for t, s, *v in frame.itertuples(index=False)]
    df = spark.createDataFrame(rows, SCHEMA + ", aux double")
    filled = fill_seasonal(df, ["target", "aux"], Grid(freq_seconds=600)).orderBy("ts").toPandas()
    for c in ("target", "aux"):
        np.testing.assert_allclose(filled[c].astype(float), wanted[c].astype(float), rtol=1e-12)
    assert filled.target.isna().sum() == (wanted.ts.dt.hour == 7).sum()


@pytest.mark.parametrize("broadcast", [0, 100_000])
@pytest.mark.parametrize("gathered", [0, 60, 10_000])
def test_seasonal_fill_counts_large_seasons_only(spark, monkeypatch, broadcast, gathered):
    """Seasons of 20 to 160 values: all counted, some of them, or none."""
    rng = random.Random(5)
    cells = [(h, dt.datetime(year, 3, d, h)) for year in (2019, 2020, 2022, 2023) for d in range(1, 21) for h in range(3)]
    rows = [("a", t + dt.timedelta(minutes=m), None if rng.random() < 0.2 else rng.random()) for h, t in cells for m in range(0, 10 + 20 * h, 10)]
    df = spark.createDataFrame(rows, SCHEMA)
    ten = Grid(freq_seconds=600)
    wanted = sorted(tuple(r) for r in fill_seasonal(df, ["target"], ten).collect())
    assert all(r[2] is not None for r in wanted)
    monkeypatch.setattr(gaps, "MAX_BROADCAST_SEASONS", broadcast)
    monkeypatch.setattr(gaps, "MAX_GATHERED", gathered)
    assert sorted(tuple(r) for r in fill_seasonal(df, ["target"], ten).collect()) == wanted


def test_seasonal_fill_of_one_year_settles_no_values(spark, monkeypatch):
    """Besides the table, what is kept has at most a row per season."""
    start = dt.datetime(2024, 1, 1)
    rows = [(s, start + dt.timedelta(hours=k), None if k % 7 == 0 else float(k)) for s in "ab" for k in range(720)]
    settled, settle = [], gaps.settle
    monkeypatch.setattr(gaps, "settle", lambda df: settled.append(settle(df)) or settled[-1])
    filled = fill_seasonal(spark.createDataFrame(rows, SCHEMA), ["target"])
    assert filled.filter("target IS NULL").count() == 0
    assert [df.count() for df in settled][0] == 1440
    assert all(df.count() <= 48 for df in settled[1:])


def test_seasonal_values_are_sorted_without_a_copy_of_their_keys(spark, monkeypatch):
    """Odd values have the medians they had; the setting is put back."""
    plans, settle = [], gaps.settle
    monkeypatch.setattr(gaps, "settle", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or settle(df))
    inf, nan = float("inf"), float("nan")
    pools = {
        "even": ([4.0, 1.0, 3.0, 2.0], 2.5), "odd": ([3.0, 1.0, 1.0], 1.0), "none": ([None, None], None), "one": ([-7.5], -7.5),
        "nan": ([nan, 1.0, 2.0], 2.0), "nans": ([nan, nan, 1.0, nan], nan), "inf": ([inf, inf, 1.0], inf), "ends": ([-inf, 5.0], -inf),
    }
    rows = [(k, START + dt.timedelta(days=i), v, None) for k, (values, _) in pools.items() for i, v in enumerate([None, *values])]
    rows.append((None, START, None, 1.0))
    df = spark.createDataFrame(rows, SCHEMA + ", aux double")
    filled = {r.series_id: r for r in fill_seasonal(df, ["target", "aux"]).filter(F.col("ts") == F.lit(START)).collect()}
    for k, (_, wanted) in pools.items():
        assert filled[k].target == wanted or (wanted != wanted and filled[k].target != filled[k].target)
    assert all(r.aux is None for k, r in filled.items() if k) and filled[None].target is None
    assert any("collect_list" in plan for plan in plans)
    assert not any("ObjectHashAggregate" in plan for plan in plans)
    assert spark.conf.get("spark.sql.execution.useObjectHashAggregateExec") == "true"


def test_seasonal_fill_without_holes_is_the_table(spark):
    df = series(spark, [1.0, 2.0])
    assert values_of(fill_seasonal(df, ["target"])) == [1.0, 2.0]
    assert fill_seasonal(df.limit(0), ["target"]).count() == 0


def test_encoding_orders_strings_and_knows_missing(spark):
    df = spark.createDataFrame([("10",), ("2",), (None,), ("2",)], "code string")
    encoding = fit_encoding(df, "code")
    assert {r.label: r.code for r in encoding.collect()} == {"10": 0, "2": 1, "nan": 2}
    new = spark.createDataFrame([("2",), ("77",)], "code string")
    assert sorted(r.weather_code for r in encode(new, "code", encoding).collect()) == [-1, 1]


def test_ranks_in_ranges(spark):
    labels = [f"k{i}" for i in range(2500)]
    random.Random(1).shuffle(labels)
    df = spark.createDataFrame([(s,) for s in labels], "label string")
    got = {r.label: r.code for r in rank_in_ranges(df).collect()}
    assert got == {label: i for i, label in enumerate(sorted(labels))}


def test_clean_encodes_holes_and_leaves_no_gap(spark):
    rows = [("a", hours(i), float("nan") if i == 3 else float(i), "5") for i in (0, 1, 3, 4)]
    df = spark.createDataFrame(rows, SCHEMA + ", weather_code string")
    cleaned, encoding = clean_readings(df)
    got = cleaned.orderBy("ts").collect()
    assert [r.target for r in got] == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert [r.weather_code for r in got] == [0, 0, 1, 0, 0]
    assert {r.label: r.code for r in encoding.collect()} == {"5": 0, "nan": 1}


def counting(df, seen):
    """The frame, adding the rows that are read from it to an accumulator."""

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema)


def test_cleaning_reads_the_readings_twice(spark):
    rows = [("a", hours(i), float(i), str(i % 3)) for i in range(0, 200, 1 + 2)]
    df = spark.createDataFrame(rows, SCHEMA + ", weather_code string")
    seen = spark.sparkContext.accumulator(0)
    cleaned, _ = clean_readings(counting(df, seen), Grid(chunk_cells=16))
    assert cleaned.count() == 199
    assert seen.value == 2 * len(rows)


def test_cleaning_snaps_and_encodes_shifted_series(spark):
    """A shifted series is moved before it is laid on the grid; its labels count too."""
    rows = [("a", hours(i, 30), float(i) if i != 4 else None, "s") for i in range(9)]
    rows += [("b", hours(i), float(i), "g") for i in (0, 1, 4)]
    rows += [("b", hours(2, 17), 99.0, "off")]
    df = spark.createDataFrame(rows, SCHEMA + ", weather_code string")
    cleaned, encoding = clean_readings(df, Grid(chunk_cells=3))
    assert {r.label: r.code for r in encoding.collect()} == {"g": 0, "nan": 1, "s": 2}
    got = {(r.series_id, r.ts): (r.target, r.weather_code) for r in cleaned.collect()}
    assert {k: v for k, v in got.items() if k[0] == "a"} == {("a", hours(i)): (float(i), 2) for i in range(9)}
    assert {k: v for k, v in got.items() if k[0] == "b"} == {("b", hours(i)): (float(i), 1 if i in (2, 3) else 0) for i in range(5)}


def test_clean_raw_repairs_names_and_times(spark):
    rows = [("2024-01-01 00:00:00", 1.0, "5"), ("never", 7.0, "6"), ("2024-01-01 02:00:00", 3.0, "5")]
    raw = spark.createDataFrame(rows, "time string, `pm2_5 (μg/m³)` double, `weather_code ()` string")
    cleaned, encoding = clean_raw(raw)
    assert [tuple(r) for r in cleaned.select("series_id", "ts", "`pm2_5_(μg/m³)`", "weather_code").orderBy("ts").collect()] == [
        ("all", hours(0), 1.0, 0), ("all", hours(1), 2.0, 1), ("all", hours(2), 3.0, 0),
    ]
    assert encoding.count() == 2


def test_no_single_partition(spark, capsys):
    df = series(spark, [1.0, 2.0, 3.0])
    interpolate(df, ["target"]).explain()
    assert "SinglePartition" not in capsys.readouterr().out
    assert nan_to_null(df).columns == df.columns
