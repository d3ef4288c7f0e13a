"""Volume, run history, health and gates."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from terralode.operators import monitor, quality
from terralode.sources import folders
from terralode.sources.listing import list_keys, list_models, list_objects, probe_tables, tail_lines

T0 = dt.datetime(2024, 1, 1, 9)
RUNS = "dag_id string, run_id string, state string, start_date timestamp_ntz, end_date timestamp_ntz, execution_date timestamp_ntz"


@pytest.fixture
def runs(spark):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    return spark.createDataFrame(
        [
            ("ingest", "r1", "success", at(0), at(5), at(0)),
            ("ingest", "r2", "failed", at(10), at(11), at(10)),
            ("convert", "r3", "running", at(20), None, at(20)),
            ("convert", "r4", "success", None, None, at(30)),
            ("load", "r5", "queued", None, None, at(40)),
        ],
        RUNS,
    )


def test_recent_runs(runs):
    got = [(r["run_id"], r["duration_s"]) for r in monitor.recent_runs(runs, limit=4).collect()]
    assert got == [("r3", None), ("r2", 60.0), ("r1", 300.0), ("r4", None)]
    assert [r["run_id"] for r in monitor.recent_runs(runs, dag_id="ingest").collect()] == ["r2", "r1"]
    assert [r["run_id"] for r in monitor.recent_runs(runs, limit=3, only=["ingest"]).collect()] == ["r2", "r1"]
    assert monitor.recent_runs(runs, only=[]).count() == 5


def test_run_durations(runs):
    assert [tuple(r)[0] for r in monitor.run_durations(runs, "convert").collect()] == ["r3", "r4"]


def test_states(runs, rows):
    assert rows(monitor.state_counts(runs), "success", "failed", "running") == [(2, 1, 1)]
    assert rows(monitor.state_counts(runs.limit(0)), "success", "failed", "running") == [(0, 0, 0)]
    assert rows(monitor.last_state(runs), "dag_id", "state", "run_id") == [
        ("convert", "running", "r3"),
        ("ingest", "failed", "r2"),
        ("load", "queued", "r5"),
    ]
    assert rows(monitor.last_state_of(runs, ["ingest", "never"]), "dag_id", "state", "run_id") == [
        ("ingest", "failed", "r2"),
        ("never", "—", "—"),
    ]


def test_tasks(spark, rows):
    tasks = spark.createDataFrame(
        [
            ("d", "r", "late", "success", T0 + dt.timedelta(seconds=50), T0 + dt.timedelta(seconds=80)),
            ("d", "r", "early", "success", T0, T0 + dt.timedelta(seconds=45)),
            ("d", "r", "open", "running", None, None),
            ("d", "other", "x", "success", T0, T0),
        ],
        "dag_id string, run_id string, task_id string, state string, start_date timestamp, end_date timestamp",
    )
    one = monitor.task_durations(tasks, "d", "r")
    assert [(r["task_id"], r["duration_s"]) for r in one.collect()] == [("early", 45.0), ("late", 30.0), ("open", None)]
    assert rows(monitor.total_and_slowest(one), "total_s", "slowest_s", "slowest_task") == [(75.0, 45.0, "early")]
    assert [r["task_id"] for r in monitor.slowest_first(one).collect()] == ["early", "late", "open"]


LISTING = "key string, size_bytes bigint, last_modified timestamp_ntz"


def test_volume(spark, rows):
    listing = spark.createDataFrame([("p/a/x.parquet", 1000, T0), ("p/y.PARQUET", 24, T0 + dt.timedelta(days=1)), ("z.csv", 0, T0)], LISTING)
    assert rows(monitor.volume_kpis(listing), "files", "total_bytes", "last_modified", "total_size") == [
        (3, 1024, T0 + dt.timedelta(days=1), "1.00 KB")
    ]
    assert rows(monitor.volume_kpis(listing.limit(0)), "files", "total_bytes", "last_modified") == [(0, 0, None)]
    assert [tuple(r) for r in monitor.top_folder_breakdown(listing, "p/").collect()] == [("root", 2), ("a", 1)]
    assert monitor.count_with_suffix(listing, [".parquet"]).first()["files"] == 2
    capped = monitor.capped_listing(listing, 2).collect()
    assert [(r["key"], r["size"]) for r in capped] == [("p/y.PARQUET", "24.00 B"), ("p/a/x.parquet", "1000.00 B")]


@pytest.mark.parametrize(
    "states, files, want",
    [
        ({"i": "success"}, 0, ["ingested_but_no_parquet"]),
        ({"i": "success"}, 2, ["ok"]),
        ({"c": "failed", "l": "failed", "m": "failed"}, 2, ["conversion_failed", "load_failed", "model_generation_failed"]),
        ({}, 0, ["ok"]),
    ],
)
def test_health(spark, states, files, want):
    frame = spark.createDataFrame([(d, s, "r") for d, s in states.items()], "dag_id string, state string, run_id string")
    count = spark.range(files).agg(F.count("*").alias("files"))
    roles = {"ingestion": "i", "conversion": "c", "load": "l", "models": "m"}
    assert monitor.health(frame, count, roles).first()["alerts"] == want


def test_artifacts(spark, rows):
    models = spark.createDataFrame([("bronze",), ("silver",), ("bronze",)], "layer string")
    assert rows(monitor.artifact_kpis(models, None), "has_manifest", "bronze_models", "silver_models") == [(False, 2, 1)]
    assert rows(monitor.artifact_kpis(models.limit(0), spark.range(1)), "has_manifest", "bronze_models", "silver_models") == [(True, 0, 0)]


def test_totals(spark, rows):
    selected = spark.createDataFrame([("a", 2), ("b", 3)], "slug string, resources bigint")
    assert rows(monitor.ingestion_totals(selected), "datasets", "files") == [(2, 5)]
    assert rows(monitor.ingestion_totals(selected.limit(0)), "datasets", "files") == [(0, 0)]
    assert rows(monitor.processed_totals(spark.range(2), spark.range(9)), "new_files", "all_files") == [(2, 9)]
    assert [tuple(r) for r in monitor.distinct_sorted(selected.union(selected), "slug").collect()] == [("a",), ("b",)]


def test_gates(spark):
    df = spark.createDataFrame([("a", True), (None, False)], "batch string, ok boolean")
    assert quality.require_rows(df, "none") is df
    with pytest.raises(quality.GateError, match="none"):
        quality.require_rows(df.limit(0), "none")
    with pytest.raises(quality.GateError):
        quality.require_value(df, "batch", "no id")
    quality.require_value(df.filter("batch is not null"), "batch", "no id")
    with pytest.raises(quality.GateError, match="1 failed"):
        quality.require_no_failures(df, "upload")
    with pytest.raises(quality.GateError):
        quality.require_positive(df.limit(0), F.count("*"), "empty")
    quality.require_positive(df, F.count("*"), "empty")


@pytest.mark.parametrize("outcomes, stops", [(["error", "error"], True), (["error", "ok"], False), (["skipped"], False), (["error", "skipped"], True)])
def test_all_failed(spark, outcomes, stops):
    results = spark.createDataFrame([(o,) for o in outcomes], "outcome string")
    if stops:
        with pytest.raises(quality.GateError):
            quality.require_not_all_failed(results, "nothing arrived")
    else:
        quality.require_not_all_failed(results, "nothing arrived")


def test_lazy_gate(spark):
    df = spark.range(5)
    assert quality.assert_rows(df, F.col("id") < 5, "too big").count() == 5
    with pytest.raises(Exception, match="too big"):
        quality.assert_rows(df, F.col("id") < 4, "too big").collect()


def test_listing(spark, tmp_path, rows):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.sql").write_text("select 1")
    (tmp_path / "b.csv").write_text("x")
    assert rows(list_keys(spark, str(tmp_path))) == [("b.csv",), ("d/a.sql",)]
    objects = list_objects(spark, str(tmp_path))
    assert rows(objects, "key", "size_bytes") == [("b.csv", 1), ("d/a.sql", 8)]
    assert [r["file"] for r in list_models(spark, str(tmp_path)).collect()] == ["a.sql"]
    plan = objects._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_tail(spark, tmp_path):
    path = tmp_path / "x.log"
    path.write_bytes(b"".join(b"line %d \xff\n" % i for i in range(1000)))
    got = [r["line"] for r in tail_lines(spark, str(path), 3).collect()]
    assert [g.split()[1] for g in got] == ["997", "998", "999"]
    assert tail_lines(spark, str(tmp_path / "none.log")).first()["line"].startswith("[missing]")


def test_tail_of_a_log_read_in_parallel(spark, tmp_path):
    path = tmp_path / "x.log"
    path.write_text("".join(f"{i}\n" for i in range(50_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = [int(r["line"]) for r in tail_lines(spark, str(path), 5000).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == list(range(45_000, 50_000))


def test_every_object_is_listed_by_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(folders, "TASK_FOLDERS", 2)
    names = ["a.csv", "_b.csv", ".c.csv", "d[1].csv", "e *?.csv", "é +%20.csv", "_x/f.csv", ".y/z/g.csv", "k=1/h.csv"]
    names += [f"deep/{i}/{'x/' * i}i.csv" for i in range(6)]
    for i, name in enumerate(names):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * i)
    for marker in ("_SUCCESS", ".a.csv.crc", "_temporary/0/t.csv"):
        (tmp_path / marker).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / marker).write_bytes(b"")
    (tmp_path / "empty").mkdir()
    for path in (str(tmp_path), f"file:{tmp_path}/"):
        found = folders.list_every_object(spark, path).collect()
        assert sorted((r["key"], r["size_bytes"]) for r in found) == sorted((n, i) for i, n in enumerate(names))
        assert all(r["last_modified"] is not None for r in found)
    assert folders.list_every_object(spark, str(tmp_path / "empty")).count() == 0
    with pytest.raises(Exception, match="missing"):
        folders.list_every_object(spark, str(tmp_path / "missing"))


def test_tables_are_probed_by_one_plan(spark, schema, rows, tmp_path):
    for n in range(6):
        spark.range(n).write.saveAsTable(f"`{schema}`.t{n}", format="parquet")
    spark.range(10).withColumn("p", F.col("id") % 3).write.partitionBy("p").saveAsTable(f"`{schema}`.parts", format="parquet")
    steps = lambda df: len(re.findall(r"[+:]- ", df._jdf.queryExecution().optimizedPlan().toString()))
    few = steps(probe_tables(spark, schema))
    spark.range(7).write.csv(str(tmp_path / "c"))
    spark.sql(f"CREATE TABLE `{schema}`.lines (id bigint) USING csv LOCATION 'file:{tmp_path}/c'")
    spark.sql(f"CREATE VIEW `{schema}`.seen AS SELECT * FROM `{schema}`.t4")
    probed = probe_tables(spark, schema)
    want = [(f"t{n}", n) for n in range(6)] + [("parts", 10), ("lines", 7), ("seen", 4)]
    assert rows(probed, "table_name", "row_count") == sorted(want, key=repr)
    assert {r["table_name"] for r in probed.where("bytes > 0 and created <= last_altered").collect()} >= {"t5", "parts", "lines"}
    for n in range(6, 9):
        spark.range(n).write.saveAsTable(f"`{schema}`.t{n}", format="parquet")
    spark.sql(f"DROP VIEW `{schema}`.seen")
    spark.sql(f"DROP TABLE `{schema}`.lines")
    assert steps(probe_tables(spark, schema)) == few
    assert probe_tables(spark, schema, limit=2).count() == 2
