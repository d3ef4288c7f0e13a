"""Names, sizes, durations, counts and nested texts."""

import datetime
import os
import re
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from terralode.functions import names
from terralode.functions.measures import (
    bytes_human,
    char_count,
    duration_seconds,
    is_blank,
    labels,
    now_text,
    pixel_centre,
    timestamp_text,
    word_count,
)
from terralode.functions.nested import coordinates, json_field, json_keys


def values(spark, inputs, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v")).alias("o")).collect()]


KEYS = ["a/b/file.CSV", "file", "dir.d/file", "a.tar.gz", ".hidden", "x/.hidden.txt", "é à.csv", "a..b", "end."]


def test_extension(spark):
    want = ["csv", "", "d/file", "gz", "hidden", "txt", "csv", "b", ""]
    assert values(spark, KEYS, names.file_extension) == want


def test_table_name_splits_like_the_path_library(spark):
    assert values(spark, KEYS, names.table_name) == [os.path.splitext(os.path.basename(k))[0] for k in KEYS]
    assert values(spark, ["a/X.CSV"], names.parquet_key) == ["parquets_files/X.parquet"]


URLS = [
    "https://x.org/d/file.CSV",
    "https://x.org/d/file.csv?v=1.2&f=a/b.zip",
    "http://x.org",
    "http://x.org/",
    "https://x.org/a/b/",
    "https://x.org/a.b/c#frag.txt",
    "https://x.org/a/b.geojson;type=a",
    "https://x.org/a file.tar.gz",
    "d/file.tsv",
    "",
]


def test_url_names(spark):
    paths = [urlparse(u).path for u in URLS]
    base = [os.path.basename(p.rstrip("/")) or "downloaded_file" for p in paths]
    assert values(spark, URLS, names.url_basename) == base
    ext = [os.path.splitext(p)[1].lower().lstrip(".") for p in paths]
    assert values(spark, URLS, names.url_extension) == ext


def test_run_ids(spark):
    ids = ["scheduled__2024-01-01T09:00:00+00:00", "é à", None, "a-b_c"]
    assert values(spark, ids, names.sanitize_run_id) == [re.sub(r"[^\w\-]", "_", s or "") for s in ids]


def test_compressed_names(spark):
    assert values(spark, ["a.csv.gz", "a.gz", "b.zip"], lambda c: names.strip_suffix(c, ".gz")) == [
        "a.csv",
        "a",
        "b.zip.decompressed",
    ]
    assert values(spark, ["a.CSV", "a"], names.inner_extension) == ["csv", "txt"]


def test_folders(spark):
    keys = ["p/tabular/a.csv", "p/a.csv", "other/a.csv", "a.csv", "p/x/y/z"]
    assert values(spark, keys, lambda c: names.top_folder(c, "p/")) == ["tabular", "root", "other", "root", "x"]
    assert values(spark, ["a/", "a"], names.is_folder_key) == [True, False]
    assert values(spark, ["a.PARQUET", "b.pq", "c.csv"], lambda c: names.has_suffix(c, [".parquet", ".pq"])) == [True, True, False]


def test_identifiers(spark):
    assert names.safe_identifier("FE - HH-FF") == "FE___HH_FF"
    assert values(spark, ["FE - HH-FF"], names.safe_identifier_column) == ["FE___HH_FF"]


def human(n):
    x = float(n)
    for unit in ["B", "KB", "MB", "GB", "TB"]:
        if x < 1024.0:
            return f"{x:.2f} {unit}"
        x /= 1024.0
    return f"{x:.2f} PB"


def test_sizes(spark):
    sizes = [0, 1, 1023, 1024, 1025, 1029, 1536, 1041, 10**6, 2**20 - 1, 2**20, 123456789, 2**40 + 2**33, 2**50, 2**60 + 12345, 2**63 - 1]
    sizes += [1024 * k + 128 for k in range(20)] + [1024**2 * k + 131072 * 3 for k in range(20)]
    assert values(spark, sizes, bytes_human, "bigint") == [human(n) for n in sizes]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_durations(spark, kind):
    t = datetime.datetime(2024, 3, 31, 1, 59, 59, 500000)
    df = spark.createDataFrame([(t, t + datetime.timedelta(days=2, microseconds=250)), (t, None), (None, t)], f"a {kind}, b {kind}")
    got = [r[0] for r in df.select(duration_seconds(F.col("a"), F.col("b"))).collect()]
    assert got == [172800.00025, None, None]


TEXTS = ["Hello  World", "", "  \t\n ", "a", " a b　c d\x1ce", "één woord 😀", "x\u2028y\x85z"]


def test_counts_match_python(spark):
    assert values(spark, TEXTS, word_count) == [len(t.split()) for t in TEXTS]
    assert values(spark, TEXTS, char_count) == [len(t) for t in TEXTS]
    assert values(spark, TEXTS, is_blank) == [not t.strip() for t in TEXTS]


def test_time_texts(spark):
    now = spark.range(1).select(now_text()).first()[0]
    assert re.fullmatch(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", now)
    got = values(spark, [datetime.datetime(2024, 1, 2, 3, 4, 5, 600)], timestamp_text, "timestamp_ntz")
    assert got == ["2024-01-02 03:04:05"]


def test_pixel_centres(spark):
    assert values(spark, [0, 4], lambda c: pixel_centre(c, 0.0, 0.2), "int") == [0.1, pytest.approx(0.9)]


def test_labels(spark):
    rule = lambda c: labels((c > 1, "big"), (c > 2, "bigger"), default="ok")
    assert values(spark, [0, 2, 3, None], rule, "int") == [["ok"], ["big"], ["big", "bigger"], ["ok"]]


def test_json_texts(spark):
    assert values(spark, ['["a","b"]', "[]", "bad", None, "{}"], json_keys) == [["a", "b"], [], [], [], []]
    assert values(spark, ['{"k": "v"}', '{"j": 1}', "bad", None], lambda c: json_field(c, "k", "?")) == ["v", "?", "?", "?"]


def test_coordinates(spark):
    assert values(spark, ["\n 1,2,3 4,5 \n", "", "x,1"], coordinates) == [[[1.0, 2.0, 3.0], [4.0, 5.0]], [], [[None, 1.0]]]
