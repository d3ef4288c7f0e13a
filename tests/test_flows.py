"""Scripts, tables, conversion, load, models and streams end to end."""

import datetime as dt
import json
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from terralode.plans.convert import convert_file, convert_new_files, convert_same_layout, read_ledger
from terralode.plans.ingest import check_fetches, check_selection, landed_datasets, newest_datasets, select_resources
from terralode.plans.load import created_tables, load_parquets, table_keys
from terralode.plans.medallion import build_models
from terralode.operators.quality import GateError
from terralode.session import shared_dir, shared_root
from terralode.sinks.parquet import append_to_ledger, write_by_category, write_table
from terralode.sinks.tables import (
    append_by_name,
    load_manifest,
    manifest,
    quoted,
    save_manifest,
    save_table,
    schema_for,
    split_to_tables,
)
from terralode.sources.listing import described_tables, probe_session, probe_tables
from terralode.sources.registry import read_tables
from terralode.sources.scripts import export_all_tables, run_sql_script, spark_statement, statements, user_tables
from terralode.streaming.incremental import incremental_ingest, on_new_files

SCRIPT = """
CREATE TABLE users (id INTEGER PRIMARY KEY, name TEXT NOT NULL, age INTEGER);
INSERT INTO users VALUES (1, 'Alice; the first', 30), (2, 'Bob -- the second', 25);
/* a table
   of products; */
CREATE TABLE products (id INTEGER, name TEXT, price REAL);
INSERT INTO products VALUES (1, 'Widget', 9.99);
"""


def test_statements():
    got = statements(SCRIPT)
    assert len(got) == 4 and got[1].endswith("'Bob -- the second', 25)")
    assert spark_statement("CREATE TABLE t (a INTEGER PRIMARY KEY, b TEXT)") == "CREATE TABLE t (a BIGINT , b STRING) USING parquet"
    assert spark_statement("INSERT INTO t VALUES ('INTEGER, TEXT)')") == "INSERT INTO t VALUES ('INTEGER, TEXT)')"


def test_script_tables(spark, schema, rows):
    assert run_sql_script(spark, SCRIPT, schema) == ["products", "users"]
    tables = export_all_tables(spark, schema)
    assert rows(tables["users"], "id", "name", "age") == [(1, "Alice; the first", 30), (2, "Bob -- the second", 25)]
    assert dict(tables["products"].dtypes) == {"id": "bigint", "name": "string", "price": "double"}


DUMP = """
PRAGMA foreign_keys=OFF;
BEGIN TRANSACTION;
CREATE TABLE IF NOT EXISTS "group" (id INTEGER PRIMARY KEY AUTOINCREMENT, "label" VARCHAR(20) UNIQUE, n INTEGER DEFAULT 0);
INSERT INTO "group" VALUES(1,'it''s one',5);
INSERT INTO "group" (id, "label") VALUES (2, 'two');
CREATE TABLE item(id INT, group_id INTEGER REFERENCES "group"(id), w REAL, PRIMARY KEY (id, group_id), FOREIGN KEY (group_id) REFERENCES "group"(id));
CREATE INDEX by_group ON item(group_id);
INSERT INTO item SELECT id * 10, id, 1.5 FROM "group";
COMMIT;
"""


def test_dump(spark, schema, rows):
    assert run_sql_script(spark, DUMP, schema) == ["group", "item"]
    tables = export_all_tables(spark, schema)
    assert rows(tables["group"], "id", "label", "n") == [(1, "it's one", 5), (2, "two", 0)]
    assert rows(tables["item"], "id", "group_id", "w") == [(10, 1, 1.5), (20, 2, 1.5)]


def test_script_file(spark, tmp_path, rows):
    (tmp_path / "dump.sql").write_text(SCRIPT + "CREATE TABLE empty_table (id INTEGER, data TEXT);")
    names = convert_file(spark, str(tmp_path / "dump.sql"), str(tmp_path / "out"))
    assert set(names) == {"dump_users", "dump_products", "dump_empty_table"}
    names = convert_file(spark, str(tmp_path / "dump.sql"), str(tmp_path / "out"), prefix_with_stem=False)
    assert set(names) == {"users", "products", "empty_table"}
    empty = spark.read.parquet(str(tmp_path / "out" / "empty_table.parquet"))
    assert empty.columns == ["id", "data"] and empty.count() == 0


def test_reserved_table_names(spark, schema):
    for name in ("sqlite_sequence", "sqlitexa", "sqlite", "plain"):
        save_table(spark.range(1), schema, name)
    assert user_tables(spark, schema) == ["plain", "sqlite"]


def test_odd_table_name_is_made_safe_and_remembered(spark, schema):
    assert save_table(spark.range(2), schema, "FE - HH-FF") == "FE___HH_FF"
    found = spark.sql(f"SHOW TBLPROPERTIES {quoted(schema, 'FE___HH_FF')}").filter("key = 'original_name'").first()
    assert found["value"] == "FE - HH-FF"


def test_replace_table(spark, schema, rows):
    save_table(spark.createDataFrame([(1, "a")], "a int, b string"), schema, "t")
    save_table(spark.createDataFrame([("x",)], "c string"), schema, "t")
    assert rows(spark.table(quoted(schema, "t"))) == [("x",)]


def test_append_by_name(spark, schema, rows):
    save_table(spark.createDataFrame([(1, "a")], "id bigint, Name string"), schema, "t")
    append_by_name(spark.createDataFrame([("b", 2, True)], "Name string, id int, extra boolean"), schema, "t")
    append_by_name(spark.createDataFrame([(3, "other case")], "id int, name string"), schema, "t")
    assert rows(spark.table(quoted(schema, "t")), "id", "Name") == [(1, "a"), (2, "b"), (3, None)]


def test_schema_routing():
    assert schema_for(None, "public") == "public"
    assert schema_for("  silver ", "public") == "silver"


def test_split_to_tables(spark, schema, rows):
    df = spark.createDataFrame([("Sheet1", 1, "a"), ("Sheet 2", 3, "c"), ("Sheet1", 2, "b"), ("007", 4, "d"), (None, 5, "e"), ("", 6, "f")], "sheet string, n int, s string")
    names = split_to_tables(df, "sheet", schema, shared_dir(spark, "split-test"), "t_")
    assert names == {"Sheet1": "t_Sheet1", "Sheet 2": "t_Sheet_2", "007": "t_007", "__null__": "t___null__", "__empty__": "t___empty__"}
    assert rows(spark.table(quoted(schema, "t_Sheet1")), "n", "s") == [(1, "a"), (2, "b")]
    assert rows(spark.table(quoted(schema, "t_Sheet_2")), "n", "s") == [(3, "c")]
    assert rows(spark.table(quoted(schema, "t_007")), "n", "s") == [(4, "d")]
    assert rows(spark.table(quoted(schema, "t___null__")), "n", "s") == [(5, "e")]


def test_split_refuses_colliding_names(spark, schema):
    df = spark.createDataFrame([("a b", 1), ("a-b", 2)], "k string, n int")
    with pytest.raises(ValueError, match="a_b"):
        split_to_tables(df, "k", schema, shared_dir(spark, "split-test"))


def test_manifest(spark, tmp_path, rows):
    save_manifest(manifest(spark, ["a", "b"], "raw").union(manifest(spark, ["c"], "other")), str(tmp_path / "m"))
    assert rows(load_manifest(spark, str(tmp_path / "m"), "raw"), "table") == [("a",), ("b",)]


def test_category_folders(spark, tmp_path, rows):
    df = spark.createDataFrame([("tabular", 1), ("others", 2), ("tabular", 3)], "category string, n int")
    write_by_category(df, str(tmp_path / "c"))
    assert sorted(p.name for p in (tmp_path / "c").iterdir() if p.is_dir()) == ["category=others", "category=tabular"]


def write_sources(folder):
    folder.mkdir(parents=True)
    (folder / "tabular").mkdir()
    (folder / "tabular" / "people.csv").write_text("id,nom\n1,Éloïse\n2,Bob\n")
    (folder / "tabular" / "UPPER.CSV").write_text("id\n1\n")
    (folder / "tabular" / "empty.tsv").write_text("a\tb\n")
    (folder / "others").mkdir()
    (folder / "others" / "r.json").write_text(json.dumps([{"id": 1, "x": {"y": 2}}]))
    (folder / "others" / "bad.dwg").write_text("no reader")
    (folder / "archives").mkdir()
    with zipfile.ZipFile(folder / "archives" / "z.zip", "w") as z:
        z.writestr("m.csv", "k,v\n1,2\n")
        z.writestr("n.dwg", "no reader")
    (folder / "archives" / "broken.zip").write_text("not a zip")


def test_convert_twice_takes_each_file_once(spark, tmp_path, rows):
    write_sources(tmp_path / "in")
    run = lambda: convert_new_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ledger"))
    first = rows(run(), "key", "table", "ok")
    assert first == sorted(
        [
            ("archives/broken.zip", None, False),
            ("archives/z.zip", None, True),
            ("archives/z.zip!m.csv", "z.zip_m", True),
            ("archives/z.zip!n.dwg", None, False),
            ("others/bad.dwg", None, False),
            ("others/r.json", "r", True),
            ("tabular/UPPER.CSV", "UPPER", True),
            ("tabular/empty.tsv", "empty", True),
            ("tabular/people.csv", "people", True),
        ],
        key=repr,
    )
    assert rows(run(), "key", "ok") == [("archives/broken.zip", False), ("others/bad.dwg", False)]
    assert rows(spark.read.parquet(str(tmp_path / "out" / "z.zip_m.parquet")), "k", "v") == [(1, 2)]
    assert read_ledger(spark, str(tmp_path / "ledger")).count() == 5
    assert rows(spark.read.parquet(str(tmp_path / "out" / "people.parquet")), "id", "nom") == [(1, "Éloïse"), (2, "Bob")]


def test_convert_in_lots(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    for i in range(5):
        (tmp_path / "in" / f"f{i}.csv").write_text(f"id\n{i}\n")
    results = convert_new_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ledger"), files_at_once=2)
    assert rows(results, "table", "ok") == [(f"f{i}", True) for i in range(5)]
    assert read_ledger(spark, str(tmp_path / "ledger")).count() == 5


def test_files_of_one_layout_are_one_job(spark, tmp_path, schema, rows):
    (tmp_path / "in").mkdir()
    for i in range(6):
        (tmp_path / "in" / f"m{i}.csv").write_text(f"id,v\r\n{i},{i}.5\n")
    (tmp_path / "in" / "other.csv").write_text("a\n1\n")
    (tmp_path / "in" / "m0.tsv").write_text("id\tv\n9\t9\n")
    results = convert_new_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ledger"))
    want = [(f"m{i}.csv", f"m{i}") for i in range(6)] + [("m0.tsv", "m0"), ("other.csv", "other")]
    assert rows(results.filter("ok"), "key", "table") == sorted(want)
    assert results.filter("not ok").count() == 0
    assert read_ledger(spark, str(tmp_path / "ledger")).count() == 8
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == [*(f"m{i}.parquet" for i in range(6)), "other.parquet"]
    load_parquets(spark, str(tmp_path / "out"), schema)
    assert rows(spark.table(quoted(schema, "M3")), "id", "v") == [(3, 3.5)]


def test_load_then_models(spark, tmp_path, schema, rows):
    files = tmp_path / "parquets_files"
    files.mkdir()
    pd.DataFrame({"id": [1, 2, 3], "nom": [" A ", "", "b"], "age": [20.0, None, 40.0]}).to_parquet(files / "file-1.parquet", index=False)
    pd.DataFrame({"x": [1]}).to_parquet(files / "file2.PARQUET", index=False)
    write_table(spark.range(5), str(files / "folder.parquet"))
    (files / "not_parquet.csv").write_text("x")
    (files / "broken.parquet").write_text("x")
    results = load_parquets(spark, str(files), schema)
    assert rows(results, "key", "table", "ok") == sorted(
        [("broken.parquet", None, False), ("file-1.parquet", "FILE_1", True), ("file2.PARQUET", "FILE2", True), ("folder.parquet", "FOLDER", True)],
        key=repr,
    )
    assert rows(created_tables(results)) == [("FILE2",), ("FILE_1",), ("FOLDER",)]
    built = build_models(spark, manifest(spark, ["file_1", "absent"]), schema, schema, schema)
    assert rows(built, "layer", "key", "ok") == [("bronze", "absent", False), ("bronze", "file_1", True), ("silver", "bronze_file_1", True)]
    assert rows(spark.table(quoted(schema, "silver_file_1")), "id", "nom", "age") == [(1.0, "a", 20.0), (2.0, None, 30.0), (3.0, "b", 40.0)]
    probed = rows(probe_tables(spark, schema), "table_name", "row_count")
    assert ("silver_file_1", 3) in probed and ("folder", 5) in probed


def test_load_refuses_names_that_fall_together(spark, tmp_path, schema, rows):
    for name in ("a b", "a-b", "c", "C"):
        write_table(spark.range(1), str(tmp_path / "in" / f"{name}.parquet"))
    results = load_parquets(spark, str(tmp_path / "in"), schema)
    assert rows(results, "key", "ok") == [("C.parquet", True), ("a b.parquet", False), ("a-b.parquet", False), ("c.parquet", True)]


def test_models_take_any_transform(spark, schema, rows):
    save_table(spark.range(3), schema, "t")
    build_models(spark, manifest(spark, ["t"]), schema, schema, schema, transform=lambda df: df.filter("id > 0"))
    assert rows(spark.table(quoted(schema, "silver_t"))) == [(1,), (2,)]


def test_table_keys(spark, rows):
    listing = spark.createDataFrame([("a.parquet/part-0.parquet",), ("a.parquet/part-1.parquet",), ("b.PARQUET",), ("c.csv",)], "key string")
    assert rows(table_keys(listing)) == [("a.parquet",), ("b.PARQUET",)]


def test_same_layout_in_one_job(spark, tmp_path, schema, rows):
    for name in ("jan 24", "feb"):
        (tmp_path / f"{name}.csv").write_text(f"id,m\n1,{name}\n2,{name}\n")
    convert_same_layout(spark, [str(tmp_path / "jan 24.csv"), str(tmp_path / "feb.csv")], str(tmp_path / "out"))
    got = rows(spark.read.parquet(str(tmp_path / "out")), "table", "id", "m")
    assert got == [("feb", 1, "feb"), ("feb", 2, "feb"), ("jan 24", 1, "jan 24"), ("jan 24", 2, "jan 24")]
    results = load_parquets(spark, str(tmp_path / "out"), schema)
    assert rows(results, "table", "ok") == [("FEB", True), ("JAN_24", True)]
    assert spark.table(quoted(schema, "FEB")).columns == ["id", "m"]


def test_ingest_selection(spark, rows):
    schema = "slug string, last_update timestamp_ntz, resources array<struct<format string, url string, title string>>"
    data = [
        ("a", dt.datetime(2024, 1, 3), [("csv", "https://x.org/a.csv", "A"), ("html", "https://x.org/", "page")]),
        ("b", dt.datetime(2024, 1, 2), [("html", "https://x.org/", "page")]),
        ("old", dt.datetime(2020, 1, 1), [("csv", "https://x.org/o.csv", "O")]),
    ]
    datasets = spark.createDataFrame(data, schema)
    newest = newest_datasets(datasets, 2)
    assert rows(newest, "slug") == [("a",), ("b",)]
    chosen = select_resources(newest)
    assert rows(chosen, "slug", "url", "path", "title") == [("a", "https://x.org/a.csv", "tabular/csv/", "A")]
    assert rows(check_selection(chosen), "datasets", "files") == [(1, 1)]
    with pytest.raises(GateError):
        select_resources(datasets.filter("slug = 'b'"))
    with pytest.raises(GateError):
        newest_datasets(datasets.limit(0))
    with pytest.raises(GateError):
        check_fetches(spark.createDataFrame([(500, None)], "status int, error string"))


def test_landed_metadata(spark, tmp_path, rows):
    meta = {"slug": "a", "title": "A", "last_update": "2024-01-03T10:00:00", "resources": [{"format": "csv", "url": "u.csv", "title": "t", "id": 9}], "more": {}}
    (tmp_path / "a.json").write_text(json.dumps(meta, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"slug": "b"}))
    assert rows(landed_datasets(spark, str(tmp_path)), "slug") == [("a",), ("b",)]
    one = landed_datasets(spark, str(tmp_path), ["a"])
    assert rows(select_resources(one), "slug", "url", "ext") == [("a", "u.csv", "csv")]


def test_session_probe(spark):
    row = probe_session(spark).first()
    assert row["status"] == "ok" and row["version"].startswith("4")


def test_stream_takes_each_file_once(spark, tmp_path, rows):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    run = lambda: incremental_ingest(spark, source, target, checkpoint, "id bigint", transform=lambda df: df.filter("id <> 2"), max_files=1)
    spark.range(3).write.parquet(source)
    run()
    assert rows(spark.read.parquet(target)) == [(0,), (1,)]
    run()
    assert spark.read.parquet(target).count() == 2
    spark.range(10, 12).write.mode("append").parquet(source)
    run()
    assert rows(spark.read.parquet(target)) == [(0,), (1,), (10,), (11,)]


def test_stream_of_csv(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,s\n1,x\n")
    out = incremental_ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), "id int, s string", "csv", header="true")
    assert rows(spark.read.parquet(out), "id", "s") == [(1, "x")]


def test_stream_of_file_names(spark, tmp_path):
    (tmp_path / "in").mkdir()
    seen = []
    handle = lambda batch: seen.extend(r["path"].rsplit("/", 1)[-1] for r in batch.collect())
    for name in ("a.csv", "b.csv"):
        (tmp_path / "in" / name).write_text("x")
        on_new_files(spark, str(tmp_path / "in"), str(tmp_path / "cp"), handle, glob="*.csv")
    assert seen == ["a.csv", "b.csv"]


def test_ledger_file(spark, tmp_path, rows):
    path = str(tmp_path / "ledger")
    assert read_ledger(spark, path).count() == 0
    append_to_ledger(spark.createDataFrame([("a",)], "key string"), path)
    append_to_ledger(spark.createDataFrame([("b",)], "key string"), path)
    assert rows(read_ledger(spark, path)) == [("a",), ("b",)]


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert not named or shared_root(spark) == named.rstrip("/")
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


def test_no_reader_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        read_tables(spark, str(tmp_path / "a.rar"))




def test_files_of_odd_names_and_empty_ones_are_not_lost(spark, tmp_path, rows):
    folder = tmp_path / "in"
    folder.mkdir()
    for name in ("a[1].csv", "b{x}.xml", "_c.csv", ".d.json", "_k=1.csv", "e*.parquet"):
        (folder / name).write_text("<r><record><id>1</id></record></r>" if name.endswith("xml") else "id\n1\n")
    (folder / "e*.parquet").unlink()
    pd.DataFrame({"id": [1]}).to_parquet(folder / "e*.parquet")
    with zipfile.ZipFile(folder / "z[2].zip", "w") as z:
        z.writestr("m.csv", "id\n1\n")
    (folder / "f.csv").write_bytes(b"")
    run = lambda: convert_new_files(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "ledger"))
    got = {r["key"]: (r["ok"], r["error"]) for r in run().collect()}
    passed_over, empty = (False, "a name Spark's readers pass over"), (False, "an empty file")
    assert got == {
        **dict.fromkeys(("a[1].csv", "b{x}.xml", "_k=1.csv", "e*.parquet", "z[2].zip", "z[2].zip!m.csv"), (True, None)),
        "_c.csv": passed_over, ".d.json": passed_over, "f.csv": empty,
    }
    assert rows(read_ledger(spark, str(tmp_path / "ledger"))) == sorted([("_k=1.csv",), ("a[1].csv",), ("b{x}.xml",), ("e*.parquet",), ("z[2].zip",)])
    assert {r["key"] for r in run().collect()} == {"_c.csv", ".d.json", "f.csv"}


def test_load_in_place_copies_nothing(spark, tmp_path, schema, rows):
    files = tmp_path / "files"
    write_table(spark.range(5).withColumn("Été x", F.lit("a")), str(files / "folder.parquet"))
    for name in ("one-file.parquet", "odd[1].parquet"):
        pd.DataFrame({"id": [1, 2], "nom": ["a", None]}).to_parquet(files / name)
    pd.DataFrame({"id": [1], "tags": [["x", "y"]]}).to_parquet(files / "nested.parquet")
    results = load_parquets(spark, str(files), schema, in_place=True)
    assert rows(results, "table", "ok") == [("FOLDER", True), ("NESTED", True), ("ODD_1_", True), ("ONE_FILE", True)]
    places = {r["table_name"]: r["place"] for r in described_tables(spark, schema).collect()}
    assert {t for t, place in places.items() if "/files/" in place} == {"folder", "one_file"}
    assert spark.table(quoted(schema, "folder")).columns == ["id", "Été x"] and spark.table(quoted(schema, "FOLDER")).count() == 5
    assert rows(spark.table(quoted(schema, "nested"))) == [(1, '["x","y"]')]
    assert all(rows(spark.table(quoted(schema, t))) == [(1, "a"), (2, None)] for t in ("one_file", "odd_1_"))
    assert rows(probe_tables(spark, schema), "table_name", "row_count") == [("folder", 5), ("nested", 1), ("odd_1_", 2), ("one_file", 2)]
    load_parquets(spark, str(files), schema, in_place=True)  # again: replaced, the files still there
    assert spark.table(quoted(schema, "folder")).count() == 5
