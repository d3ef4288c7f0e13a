"""Filing, ledger, resources and sidecars."""

from pyspark.sql import functions as F

from terralode.formats import FORMATS, formats_table
from terralode.operators import catalog


def keys(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "key string")


def test_dictionary(spark):
    assert formats_table(spark).count() == len(FORMATS) == 36
    assert catalog.supported_extensions(formats_table(spark)).count() == 36


def test_describe_known_and_unknown(spark, rows):
    got = rows(catalog.describe_files(keys(spark, "a/x.CSV", "y.abc", "noext")), "key", "extension", "category", "type")
    assert got == [
        ("a/x.CSV", "csv", "tabular", "tableau"),
        ("noext", "", "unknown", "inconnu"),
        ("y.abc", "abc", "unknown", "inconnu"),
    ]
    assert rows(catalog.describe_files(keys(spark, "y.abc"), unknown="others"), "category") == [("others",)]


def test_dictionary_is_broadcast(spark):
    plan = catalog.describe_files(keys(spark, "a.csv"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_scan_leaves_out_folders_processed_files_and_other_folders(spark, rows):
    listing = keys(spark, "raw/tabular/", "raw/tabular/a.csv", "raw/tabular/b.csv", "raw/misc/c.csv", "tabular/d.csv")
    got = catalog.scan_new_files(listing, keys(spark, "raw/tabular/a.csv"), "raw/")
    assert rows(got, "key", "extension", "source_folder") == [("raw/tabular/b.csv", "csv", "tabular")]


def test_routes(spark, rows):
    files = catalog.describe_files(keys(spark, "a.csv", "b.pdf", "c.zip", "d.weird", "e.json"))
    got = catalog.routed(files)
    assert {name: [k for (k,) in rows(df, "key")] for name, df in got.items()} == {
        "tabular": ["a.csv"],
        "geospatial_vector": [],
        "geospatial_raster": [],
        "databases": [],
        "archives": ["c.zip"],
        "documents": ["b.pdf"],
        "others": ["e.json"],
    }
    counts = catalog.route_counts(catalog.route_files(files))
    assert rows(counts, "bucket", "files") == [("archives", 1), ("documents", 1), ("others", 1), ("tabular", 1)]


def test_ledger(spark, rows):
    ledger, done = keys(spark, "a", "b"), keys(spark, "b", "c", "c")
    assert rows(catalog.ledger_update(ledger, done)) == [("a",), ("b",), ("c",)]
    assert rows(catalog.ledger_additions(ledger, done)) == [("c",)]


def test_results_are_concatenated_by_name(spark, rows):
    a = spark.createDataFrame([("x", 1)], "key string, n int")
    b = spark.createDataFrame([(2, "y")], "n int, key string")
    assert rows(catalog.concat_results([a, b, a]), "key", "n") == [("x", 1), ("x", 1), ("y", 2)]


def test_resources_match_by_format_or_suffix(spark, rows):
    resources = spark.createDataFrame(
        [
            ("CSV", "https://x.org/a.csv"),
            ("csv", "https://x.org/b.json?x=1"),
            (None, "https://x.org/c.zip"),
            ("html", "https://x.org/d"),
            ("xlsx", None),
        ],
        "format string, url string",
    )
    got = rows(catalog.match_resources(resources), "url", "ext", "path")
    assert got == sorted(
        [
            ("https://x.org/a.csv", "csv", "tabular/csv/"),
            ("https://x.org/b.json?x=1", "csv", "tabular/csv/"),
            ("https://x.org/b.json?x=1", "json", "others/json/"),
            ("https://x.org/c.zip", "zip", "archives/zip/"),
            (None, "xlsx", "tabular/xlsx/"),
        ],
        key=repr,
    )
    plan = catalog.match_resources(resources)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_datasets(spark, rows):
    schema = "slug string, last_update string, resources array<struct<format string, url string>>"
    datasets = spark.createDataFrame(
        [("a", "2024-01-03", [("csv", "u/1.csv"), ("html", "u/2")]), ("b", "2024-01-02", [("html", "u")]), (None, "2024-01-04", []), ("c", None, [("kml", "u")])],
        schema,
    )
    assert rows(catalog.select_datasets(catalog.dataset_resources(datasets)), "slug", "resources") == [("a", 1), ("c", 1)]
    assert rows(catalog.last_updated(datasets, 2), "slug") == [("a",)]
    assert rows(catalog.last_updated(datasets, 4), "slug") == [("a",), ("b",), ("c",)]


def test_sidecars(spark, rows):
    files = spark.createDataFrame(
        [("a", "shp"), ("a", "shx"), ("a", "dbf"), ("a", "prj"), ("b", "shp"), ("b", "dbf"), ("c", "txt")], "base string, ext string"
    )
    got = rows(catalog.sidecar_groups(files), "base", "complete", "has_prj", "has_cpg")
    assert got == [("a", True, True, False), ("b", False, False, False)]


def test_fetches(spark, rows):
    results = spark.createDataFrame([(200, None), (404, None), (500, None), (None, "timeout"), (200, None)], "status int, error string")
    assert rows(catalog.fetch_report(catalog.classify_fetches(results)), "outcome", "files") == [("error", 2), ("ok", 2), ("skipped", 1)]


def test_hot_base_needs_no_collected_group(spark):
    files = spark.range(100_000).select(F.lit("hot").alias("base"), F.element_at(F.array(*map(F.lit, ["shp", "shx", "dbf"])), (F.col("id") % 3 + 1).cast("int")).alias("ext"))
    out = catalog.sidecar_groups(files)
    assert out.first()["complete"]
    assert "collect" not in out._jdf.queryExecution().executedPlan().toString().lower().replace("collectlimit", "")
