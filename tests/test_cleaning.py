"""Cleaning of values and of whole tables, edge rows included."""

import datetime
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from terralode.functions.cleaning import (
    cast_dates,
    cast_numbers,
    clean_booleans,
    clean_strings,
    na_to_null,
    normalize_nulls,
)
from terralode.operators.clean import (
    attach_constants,
    auto_clean,
    deduplicate,
    describe_columns,
    drop_technical_columns,
    impute_numeric_mean,
    stringify_objects,
)


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("s"))).collect()]


def test_strings_are_trimmed_lowered_and_nulled(spark):
    got = values(spark, ["  AbC ", "", "   ", None, "\ta "], clean_strings)
    assert got == ["abc", None, None, None, "\ta"]


def test_safe_casts(spark):
    assert values(spark, ["12", "x", None], lambda c: cast_numbers(c, "bigint")) == [12, None, None]
    assert values(spark, ["2024-02-29", "2023-02-29", "x"], cast_dates) == [datetime.date(2024, 2, 29), None, None]
    assert values(spark, ["true", "yes", "on", "0", None], clean_booleans) == [True, True, None, False, None]


def test_null_tokens(spark):
    assert values(spark, ["null", "NULL", "x"], normalize_nulls) == [None, "NULL", "x"]
    assert values(spark, ["NA", " NA", "n/a", "", "None", "x", None], na_to_null) == [None, " NA", None, None, None, "x", None]


def test_auto_clean_by_type(spark):
    df = spark.createDataFrame(
        [
            (1, " A ", 1.0, Decimal("1.50"), datetime.date(2024, 1, 1), True, bytearray(b"x"), 7),
            (None, "", None, None, None, None, None, None),
            (3, "b", 2.0, Decimal("2.50"), None, False, None, 9),
        ],
        "i int, s string, d double, dec decimal(10,2), day date, flag boolean, bin binary, t tinyint",
    )
    out = auto_clean(df)
    kinds = dict(out.dtypes)
    assert kinds["i"] == "double" and kinds["dec"] == "decimal(10,2)" and kinds["t"] == "tinyint"
    got = out.collect()
    assert [r["i"] for r in got] == [1.0, 2.0, 3.0]
    assert [r["s"] for r in got] == ["a", None, "b"]
    assert [r["d"] for r in got] == [1.0, 1.5, 2.0]
    assert [r["dec"] for r in got] == [Decimal("1.50"), None, Decimal("2.50")]
    assert [r["t"] for r in got] == [7, None, 9]
    assert [r["flag"] for r in got] == [True, None, False]


def test_auto_clean_may_include_decimals_and_bytes(spark):
    df = spark.createDataFrame([(Decimal("1.00"), 1), (None, None), (Decimal("3.00"), 3)], "dec decimal(10,2), t tinyint")
    got = auto_clean(df, include_decimal=True).collect()
    assert float(got[1]["dec"]) == 2.0 and got[1]["t"] == 2.0


def test_all_null_column_stays_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "n double")
    assert [r["n"] for r in auto_clean(df).collect()] == [None, None]


def test_nan_is_a_value_and_makes_the_mean_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "n double")
    got = [r["n"] for r in impute_numeric_mean(df).collect()]
    assert got[0] == 1.0 and math.isnan(got[1]) and math.isnan(got[2])


def test_odd_column_names_are_kept(spark):
    df = spark.createDataFrame([(1, "A"), (None, "B")], "`a b` int, `c-d.e` string")
    out = auto_clean(df)
    assert out.columns == ["a b", "c-d.e"]
    assert [tuple(r) for r in out.collect()] == [(1.0, "a"), (1.0, "b")]


def test_empty_table_keeps_the_schema_of_a_full_one(spark):
    full = spark.createDataFrame([(1, "A")], "i int, s string")
    assert auto_clean(full.limit(0)).schema == auto_clean(full).schema
    assert auto_clean(full.limit(0)).count() == 0


def test_means_come_from_one_subquery(spark, tmp_path):
    spark.range(100).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2).alias("b")).write.parquet(str(tmp_path / "t"))
    out = auto_clean(spark.read.parquet(str(tmp_path / "t")))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("partial_avg") == 2  # one aggregate holds both means
    assert "Join" not in final and "CartesianProduct" not in final


def test_impute_leaves_other_columns_alone(spark):
    df = spark.createDataFrame([(1, " A "), (None, ""), (5, None)], "n int, s string")
    assert [tuple(r) for r in impute_numeric_mean(df).collect()] == [(1.0, " A "), (3.0, ""), (5.0, None)]


def test_technical_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "_x int, created_at_raw int, updated_at_raw int, x int")
    assert drop_technical_columns(df).columns == ["x"]


def test_describe(spark):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    assert [tuple(r) for r in describe_columns(df).collect()] == [(1, "i", "int"), (2, "s", "string")]


def test_one_row_per_key_and_one_for_null(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2), (None, 9), (None, 8)], "k string, v int")
    got = sorted((tuple(r) for r in deduplicate(df, ["k"]).collect()), key=repr)
    assert got == sorted([("a", 1, 1), ("b", 2, 1), (None, 8, 1)], key=repr)
    assert deduplicate(df, ["k"], keep_rn=False).columns == ["k", "v"]


def test_rank_filter_goes_below_the_shuffle(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1)], "k string, v int")
    plan = deduplicate(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_hot_key(spark):
    df = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    got = deduplicate(df, ["k"], [F.col("id")], keep_rn=False)
    assert got.count() == df.select("k").distinct().count()
    assert got.filter("k = 0").first()["id"] == 0


def test_stringify(spark):
    df = spark.createDataFrame([(1, ("a", 2), ["x"], None), (2, None, None, "t")], "i int, s struct<a:string,b:int>, l array<string>, t string")
    out = stringify_objects(df)
    assert dict(out.dtypes) == {"i": "int", "s": "string", "l": "string", "t": "string"}
    assert [tuple(r) for r in out.collect()] == [(1, '{"a":"a","b":2}', '["x"]', None), (2, None, None, "t")]
    legacy = stringify_objects(df, legacy_null_tokens=True).collect()
    assert legacy[0]["t"] == "None" and legacy[1]["s"] == "None"


def test_constants(spark):
    out = attach_constants(spark.range(1), {"crs": "EPSG:4326", "width": 5})
    assert tuple(out.first()) == (0, "EPSG:4326", "5")


@pytest.mark.parametrize("kind", ["smallint", "int", "bigint", "float", "double"])
def test_every_number_type_widens_to_double(spark, kind):
    df = spark.createDataFrame([(1,), (None,), (3,)], "n int").select(F.col("n").cast(kind).alias("n"))
    out = auto_clean(df)
    assert dict(out.dtypes)["n"] == "double"
    assert [r["n"] for r in out.collect()] == [1.0, 2.0, 3.0]
