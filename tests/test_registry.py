import datetime as dt
import json

from pyspark.sql import functions as F

from tidegrid.functions.labels import (
    accuracy_band,
    alias_status,
    date_label,
    runtime_label,
    state_label,
    text_date_label,
)
from tidegrid.operators import experiments, registry
from tidegrid.operators.ranking import rank_groups


def labels(spark, values, type_, fn):
    df = spark.createDataFrame([(v,) for v in values], f"v {type_}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_labels(spark):
    assert labels(
        spark, [0.95, 0.9499, 0.9, 0.85, 0.8, 0.7, 0.69, None], "double", accuracy_band
    ) == ["champion", "gold", "gold", "silver", "bronze", "fair", "low", "unknown"]
    assert labels(spark, ["finished", "odd", None], "string", state_label) == [
        "finished", "unknown", "unknown",
    ]
    assert labels(spark, [59.94, 60.0, 3599.0, 7200.0, None], "double", runtime_label) == [
        "59.9s", "1.0m", "60.0m", "2.0h", "N/A",
    ]
    when = dt.datetime(2024, 5, 6, 7, 8, 9)
    assert labels(spark, [when, None], "timestamp_ntz", date_label) == [
        "2024-05-06 07:08", "Unknown",
    ]
    assert labels(spark, ["2024-05-06T07:08:09", "soon", "", None], "string", text_date_label) == [
        "2024-05-06 07:08", "soon", "Unknown", "Unknown",
    ]


def test_alias_status(spark):
    cases = [
        (["Production", "latest"], "production, latest"),
        (["staging-latest"], "staging"),
        (["my-production-latest", "STAGING"], "production, staging"),
        (["v1-note"], ""),
        ([], "v7"),
        (None, "v7"),
    ]
    df = spark.createDataFrame([(a, "v7") for a, _ in cases], "aliases array<string>, version string")
    got = [r[0] for r in df.select(alias_status(F.col("aliases"), F.col("version"))).collect()]
    assert got == [expected for _, expected in cases]


def runs(spark):
    both = {"single_step_metrics": {"accuracy": 0.9}, "multi_step_metrics": {"accuracy": 0.5}}
    half = {"single_step_metrics": {"accuracy": 0.99}}
    day = dt.datetime(2024, 1, 1)
    rows = [
        ("r1", "one", "finished", day, 1, ["a", "b"], json.dumps({**both, "_runtime": 9.5})),
        ("r2", "two", "crashed", day, 1, ["c"], json.dumps(both)),
        ("r3", "three", "finished", day, 2, [], json.dumps(half)),
        ("r4", "four", "killed", day, 2, None, None),
    ]
    schema = (
        "run_id string, name string, state string, created_at timestamp_ntz, user_id int, "
        "tags array<string>, summary_json string"
    )
    return experiments.parse_summary(spark.createDataFrame(rows, schema))


def artifacts(spark):
    rows = [("r1", "m", "v2", "model", 5), ("r1", "n", "v1", "model", 3), ("r1", "log", "v0", "run_log", 1)]
    rows += [("r2", "log", "v0", "run_log", 1)]
    return spark.createDataFrame(
        rows, "run_id string, name string, version string, type string, seq int"
    )


def test_runs(spark):
    table = runs(spark)
    metrics = experiments.run_metrics(table)
    got = {r.run_id: (r.single_step_accuracy, r.runtime) for r in metrics.collect()}
    assert got == {"r1": (0.9, 9.5), "r2": (0.9, None)}
    assert [r.run_id for r in experiments.filter_runs(table, "finished", ["b", "z"]).collect()] == ["r1"]
    counted = {r.run_id: r for r in experiments.run_artifacts(table, artifacts(spark)).collect()}
    assert (counted["r1"].artifacts_count, counted["r1"].model_artifacts) == (3, 2)
    assert counted["r1"].first_model == "n" and counted["r4"].artifacts_count == 0
    board = experiments.runs_leaderboard(metrics, artifacts(spark)).orderBy("rank").collect()
    assert [(r.rank, r.run_id, r.model_artifacts) for r in board] == [(1, "r1", 2), (2, "r2", 0)]
    top = experiments.unregistered_top_runs(metrics, artifacts(spark)).collect()
    assert [r.run_id for r in top] == ["r2"]
    problems = experiments.problem_runs(table, limit=1).collect()
    assert [(r.run_id, r.more_runs) for r in problems] == [("r2", 1)]
    status = {r.run_id: r.status for r in experiments.registrable_models(table, artifacts(spark)).collect()}
    assert status == {
        "r1": "registrable", "r2": "run not finished",
        "r3": "no model artifacts", "r4": "run not finished",
    }
    summary = experiments.runs_summary(experiments.run_artifacts(metrics, artifacts(spark))).first()
    assert (summary.finished_runs, summary.registered_pct, summary.total_models) == (1, 50.0, 2)
    paths = experiments.run_paths(spark.createDataFrame([("a/b/c",), ("d",)], ["run_id"]), "e", "p")
    assert [r.run_path for r in paths.collect()] == ["a/b/c", "e/p/d"]


def test_unregistered_top_runs_reads_the_runs_once(spark):
    """Odd rows included: null and repeated ids, missing accuracies, ties, the threshold itself."""
    accuracies = [("r3", 0.9), ("r1", 0.9), ("r2", 0.95), (None, 0.85), ("r4", 0.81), ("r4", 0.81), ("r5", 0.8)]
    accuracies += [("r6", None), ("r7", 0.99), ("r8", 0.8001), ("r0", 0.2)]
    rows = [(k, f"name {k}", a, None if k == "r1" else 0.5, None if k == "r2" else 7) for k, a in accuracies]
    df = spark.createDataFrame(rows, "run_id string, name string, single_step_accuracy double, multi_step_accuracy double, user_id int")
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    kinds = [("r7", "model"), ("r7", "model"), ("r3", "run_log"), (None, "model"), ("r2", None)]
    logged = spark.createDataFrame([(k, "m", "v", t, 1) for k, t in kinds], "run_id string, name string, version string, type string, seq int")
    got = experiments.unregistered_top_runs(df.mapInArrow(counted, df.schema), logged).collect()
    assert [tuple(r) for r in got] == [
        ("r2", "name r2", 0.95, 0.5, "Unknown", 7), ("r1", "name r1", 0.9, None, "7", 7), ("r3", "name r3", 0.9, 0.5, "7", 7),
        (None, "name None", 0.85, 0.5, "7", 7), ("r4", "name r4", 0.81, 0.5, "7", 7),
    ]
    assert seen.value == len(rows)
    assert experiments.unregistered_top_runs(df.limit(0), logged).count() == 0


def test_registry(spark):
    versions = spark.createDataFrame(
        [(1, "m", "v1", "r1", ["Production"]), (2, "m", "v2", None, []), (3, "m", "v3", "gone", ["staging"])],
        "version_id int, name string, version string, run_id string, aliases array<string>",
    )
    joined = {r.version_id: r for r in registry.registry_models(versions, runs(spark)).collect()}
    assert joined[1].run_name == "one" and joined[1].single_step_accuracy == 0.9
    assert joined[2].run_name is None and joined[3].run_name is None
    summary = registry.registry_summary(versions).first()
    assert (summary.production_models, summary.staging_models, summary.total_versions) == (1, 1, 3)
    requests = spark.createDataFrame(
        [("m", "v2", "staging"), ("m", "v2", "staging"), ("m", "v9", "staging"), ("m", "v1", None)],
        "name string, version string, target string",
    )
    after = {r.version: (r.aliases, r.promoted) for r in registry.apply_promotions(versions, requests).collect()}
    assert after == {
        "v1": (["Production"], False), "v2": (["staging"], True), "v3": (["staging"], False),
    }
    reasons = sorted((r.version, r.reason) for r in registry.rejected_promotions(versions, requests).collect())
    assert reasons == [("v1", "incomplete request"), ("v9", "unknown version")]


def test_promotions_append_only(spark):
    versions = spark.createDataFrame([("m", "v1", ["b", "a", "b"]), ("m", "v2", None), ("n", "v1", ["x"])], "name string, version string, aliases array<string>")
    asked = spark.createDataFrame([("m", "v1", "c"), ("m", "v1", "a"), ("m", "v1", "c"), ("m", "v2", "z")], "name string, version string, target string")
    got = {(r.name, r.version): (r.aliases, r.promoted) for r in registry.apply_promotions(versions, asked).collect()}
    assert got == {("m", "v1"): (["b", "a", "b", "c"], True), ("m", "v2"): (["z"], True), ("n", "v1"): (["x"], False)}


def test_ranks_of_groups_cut_into_ranges(spark):
    rows = [("big", i * 37 % 1009, i) for i in range(1009)] + [("small", 5, 1), ("small", 5, 0)]
    df = spark.createDataFrame(rows, "g string, v int, id int").repartition(7)
    order = [F.col("v").desc(), F.col("id").asc()]
    got = {(r.g, r.id): r["rank"] for r in rank_groups(df, "g", order).collect()}
    wanted = {}
    for group in ("big", "small"):
        ranked = sorted((-v, i) for g, v, i in rows if g == group)
        wanted |= {(group, i): k for k, (_, i) in enumerate(ranked, 1)}
    assert got == wanted
