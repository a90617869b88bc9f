import datetime as dt

import pytest

from tidegrid.plans.dataset import Fitted
from tidegrid.sources.artifacts import MANIFEST, load_published, publish, verify
from tidegrid.sources.readings import scan_checked

SCHEMA = "id int, ts timestamp_ntz, `a.b` double"
NOON = dt.datetime(2024, 1, 1, 12)


def both(good, bad):
    return sorted(map(tuple, good.collect())), sorted((r.record, r.reason) for r in bad.collect())


def test_unreadable_csv_records(spark, tmp_path):
    lines = ["1,2024-01-01 12:00:00,2.5", "x,2024-01-01 12:00:00,1", "3,soon,1", "4,2024-01-01 12:00:00", "5,,", "6,2024-01-01 12:00:00,1,2", "7,2024-01-01 12:00:00,NaN"]
    path = tmp_path / "in.csv"
    path.write_text("\n".join(lines) + "\n")
    good, bad = scan_checked(spark, str(path), SCHEMA)
    rows, broken = both(good.na.fill({"id": 0}), bad)
    assert rows == sorted([(1, NOON, 2.5), (5, None, None), (7, NOON, None)])
    assert broken == sorted([
        ("x,2024-01-01 12:00:00,1", "id is no int"), ("3,soon,1", "ts is no timestamp_ntz"),
        ("4,2024-01-01 12:00:00", "unreadable record"), ("6,2024-01-01 12:00:00,1,2", "unreadable record"),
    ])
    assert bad.first().file.endswith("in.csv")
    assert good.dtypes == [("id", "int"), ("ts", "timestamp_ntz"), ("a.b", "double")]


def test_unreadable_json_records(spark, tmp_path):
    path = tmp_path / "in.json"
    path.write_text('{"id": 1, "a.b": 2}\n{"id": "one"}\n{"id": 3\n{"a.b": null, "more": 1}\n')
    rows, broken = scan_checked(spark, str(path), SCHEMA, "json")
    assert sorted((r[0] or 0, r[2]) for r in rows.collect()) == [(0, None), (1, 2.0)]
    assert sorted(r.reason for r in broken.collect()) == ["id is no int", "unreadable record"]


def test_only_complete_sets_are_read(spark, tmp_path):
    base = str(tmp_path / "sets")
    with pytest.raises(ValueError, match="no complete set"):
        load_published(spark, base)
    first, second = (Fitted("t", ["x", c], {"x": (0.0, 1.0), c: (0.0, 2.0), "t": (0.0, 1.0)}) for c in "yz")
    publish(spark, base, first, tables={"drift": spark.range(3).toDF("n")})
    assert load_published(spark, base).fitted.features == ["x", "y"]
    # a publisher that was stopped before the manifest
    later = publish(spark, base, second)
    manifest = f"{later}/{MANIFEST}"
    spark.read.text(manifest).write.text(f"{tmp_path}/kept")
    import shutil

    shutil.rmtree(manifest)
    found = load_published(spark, base)
    assert found.fitted.features == ["x", "y"] and found.model is None
    assert found.fitted.bounds == first.bounds


def test_damaged_sets_are_refused(spark, tmp_path):
    base = str(tmp_path / "sets")
    folder = publish(spark, base, tables={"drift": spark.range(3).toDF("n")})
    verify(spark, folder)
    spark.range(1).toDF("n").write.mode("append").parquet(f"{folder}/reports/drift")
    with pytest.raises(ValueError, match="not what was published"):
        load_published(spark, base)
