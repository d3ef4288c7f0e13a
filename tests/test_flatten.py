"""Documents, rasters and ragged records."""

import pytest
from pyspark.sql import functions as F

from terralode.operators import flatten


def test_paragraphs_number_the_blank_ones_too(spark, rows):
    df = spark.createDataFrame([(1, "First paragraph\n\n  \nThird one here"), (2, "")], "doc int, text string")
    assert rows(flatten.paragraphs(df, keep=["doc"]), "doc", "paragraph_number", "text", "char_count", "word_count") == [
        (1, 1, "First paragraph", 15, 2),
        (1, 4, "Third one here", 14, 3),
    ]


def test_pages_keep_blank_ones(spark, rows):
    df = spark.createDataFrame([("Page 1\f\fPage 3",)], "text string")
    assert rows(flatten.pages(df), "page_number", "text", "char_count", "word_count") == [
        (1, "Page 1", 6, 2),
        (2, "", 0, 0),
        (3, "Page 3", 6, 2),
    ]


@pytest.mark.parametrize("bands", [1, 3])
def test_raster(spark, rows, bands):
    grid = [[[float(b * 100 + r * 5 + c) for c in range(5)] for r in range(5)] for b in range(bands)]
    df = spark.createDataFrame([("f", grid)], "file string, raster array<array<array<double>>>")
    # bounds 0, 0, 1, 1 over 5 x 5 pixels
    out = flatten.raster_pixels(df, keep=["file"], transform=(0.2, 0, 0, 0, -0.2, 1), meta={"count": bands})
    assert out.count() == 25 * bands
    assert out.columns == ["file", "band", "row", "col", "x", "y", "value", "meta_count"]
    first = out.filter("band = 1 and row = 0 and col = 0").first()
    assert (first["x"], first["y"], first["value"], first["meta_count"]) == (pytest.approx(0.1), pytest.approx(0.9), 0.0, str(bands))
    assert out.filter("row = 4 and col = 3 and band = 1").first()["value"] == 23.0


def test_raster_transform_may_differ_by_row(spark):
    df = spark.createDataFrame([(10.0, [[[1.0]]]), (20.0, [[[2.0]]])], "left double, raster array<array<array<double>>>")
    out = flatten.raster_pixels(df, transform=(1, 0, F.col("left"), 0, -1, 0))
    assert sorted((r["x"], r["y"], r["value"]) for r in out.collect()) == [(10.5, -0.5, 1.0), (20.5, -0.5, 2.0)]


def test_ragged_records_take_the_union_of_keys(spark, rows):
    df = spark.createDataFrame(
        [(1, {"layer": "0", "start": "(0,0)"}), (2, {"layer": "0", "radius": "2.5"}), (3, {})], "id int, attributes map<string,string>"
    )
    out = flatten.widen_attributes(df, "attributes", keep=["id"])
    assert out.columns == ["id", "layer", "radius", "start"]
    assert rows(out, *out.columns) == [(1, "0", None, "(0,0)"), (2, "0", "2.5", None), (3, None, None, None)]


def test_union_of_frames(spark, rows):
    a = spark.createDataFrame([("0", "(0,0)")], "layer string, start string")
    b = spark.createDataFrame([("1", "2.5")], "layer string, radius string")
    out = flatten.union_ragged([a, b])
    assert rows(out, "layer", "start", "radius") == [("0", "(0,0)", None), ("1", None, "2.5")]


def test_flattening_needs_no_shuffle(spark):
    df = spark.createDataFrame([("a\nb",)], "text string")
    assert "Exchange" not in flatten.paragraphs(df)._jdf.queryExecution().executedPlan().toString()
