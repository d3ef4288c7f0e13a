"""Delimited text against what pandas reads from the same bytes."""

import io
import math
import time

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from terralode.operators.infer import type_columns
from terralode.sources.tabular import (
    read_csv,
    read_delimited,
    read_parquet,
    read_tsv,
    read_txt,
    sniff_separator,
    unique_names,
)

PANDAS_TYPES = {"int64": "bigint", "float64": "double", "bool": "boolean", "object": "string"}

SAMPLE = [(1, "Alice", 25, "Paris"), (2, "Bob", 30, "Lyon"), (3, "Charlie", 35, "Marseille")]


def put(tmp_path, name, text, encoding="utf-8"):
    path = tmp_path / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def same_as_pandas(df, frame):
    assert df.columns == list(frame.columns)
    assert [t for _, t in df.dtypes] == [PANDAS_TYPES[str(t)] for t in frame.dtypes]
    got = [tuple(r) for r in df.collect()]
    # Object columns are written as text, so a boolean in one of them is its spelling.
    texts = [t == object for t in frame.dtypes]
    want = [
        tuple(None if isinstance(v, float) and math.isnan(v) else str(v) if text else v for v, text in zip(row, texts))
        for row in frame.itertuples(index=False)
    ]
    assert got == want


CASES = {
    "sample": "id,nom,age,ville\n1,Alice,25,Paris\n2,Bob,30,Lyon\n3,Charlie,35,Marseille\n",
    "accents": "nom,ville\nÉloïse,Paris\nFrançois,Zürich\nMüller,Montréal\n",
    "missing": "a,b,c,d\n1,,x,True\n,2.5,NA,False\n3,n/a,null,True\n",
    "booleans_with_gap": "a,b\nTrue,1\n,2\nfalse,3\n",
    "dates_stay_text": "d\n2024-01-01\n2024-02-01\n",
    "floats": "f,g,h\n1e5,.5,inf\n-2.,1,-Infinity\n+3,2,1.0\n",
    "long_digits": "n,m\n123456789012345678901234567890,9223372036854775807\n1,1\n",
    "line_breaks": 'a,b\n1,"x\ny"\n2,"say ""hi"", ok"\n',
    "all_missing": "a,b\n1,\n2,\n",
    "suffix_letters_are_text": "a\n1d\n2f\n",
    "crlf": "a,b\r\n1,x\r\n2,y\r\n",
    "blank_lines": "a,b\n1,x\n\n2,y\n",
    "padding": "a,b\n 1, x\n2 ,y \n",
    "repeated_names": "a,a,b\n1,2,3\n4,5,6\n",
    "short_rows": "a,b,c\n1,2,3\n4,5\n",
    "mixed": "a\n1\nx\n2.5\n",
    "leading_zeros": "a\n007\n010\n",
}


@pytest.mark.parametrize("name", CASES)
def test_csv_matches_pandas(spark, tmp_path, name):
    text = CASES[name]
    same_as_pandas(read_csv(spark, put(tmp_path, "data.csv", text)), pd.read_csv(io.BytesIO(text.encode())))


def test_unnamed_header(spark, tmp_path):
    text = "a,,c\n1,2,3\n"
    assert read_csv(spark, put(tmp_path, "data.csv", text)).columns == list(pd.read_csv(io.StringIO(text)).columns)


def test_header_only_gives_columns_and_no_rows(spark, tmp_path):
    df = read_csv(spark, put(tmp_path, "data.csv", "id,nom,age\n"))
    assert df.columns == ["id", "nom", "age"] and df.count() == 0
    df.write.parquet(str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).columns == ["id", "nom", "age"]


def test_tsv(spark, tmp_path):
    text = CASES["sample"].replace(",", "\t")
    same_as_pandas(read_tsv(spark, put(tmp_path, "data.tsv", text)), pd.read_csv(io.StringIO(text), sep="\t"))


@pytest.mark.parametrize("sep", [",", ";", "\t", " ", "|"])
def test_txt_finds_the_separator(spark, tmp_path, sep):
    path = put(tmp_path, "data.txt", CASES["sample"].replace(",", sep))
    assert sniff_separator(spark, path) == sep
    assert [tuple(r) for r in read_txt(spark, path).collect()] == SAMPLE


def test_quoted_separator_does_not_count(spark, tmp_path):
    assert sniff_separator(spark, put(tmp_path, "data.txt", '"a,b";c\n1;2\n')) == ";"


def test_a_plain_file_is_read_in_splits(spark, tmp_path):
    path = put(tmp_path, "plain.csv", "id,s\n" + "".join(f"{i},x{i}\n" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_csv(spark, path)
        assert df.rdd.getNumPartitions() > 5
        assert df.count() == 20_000 and df.agg({"id": "sum"}).first()[0] == sum(range(20_000))
        broken = put(tmp_path, "broken.csv", "id,s\n" + "".join(f'{i},"x\n{i}"\n' for i in range(5_000)))
        whole = read_csv(spark, broken)
        assert whole.rdd.getNumPartitions() > 3
        assert whole.count() == 5_000 and whole.filter("s like '%\n%'").count() == 5_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_header_line_further_down_is_data(spark, tmp_path):
    text = "a,b\n1,2\na,b\n3,4\n"
    same_as_pandas(read_csv(spark, put(tmp_path, "data.csv", text)), pd.read_csv(io.StringIO(text)))


def test_header_with_a_line_break(spark, tmp_path):
    text = '"a\nb",c\n1,2\n'
    same_as_pandas(read_csv(spark, put(tmp_path, "data.csv", text)), pd.read_csv(io.StringIO(text)))


def test_folder_of_parts(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for i in range(3):
        put(tmp_path / "d", f"p{i}.csv", f"id,x\n{i},{i}.5\n")
    df = read_csv(spark, str(tmp_path / "d"))
    assert sorted(tuple(r) for r in df.collect()) == [(0, 0.5), (1, 1.5), (2, 2.5)]


def test_file_without_any_line(spark, tmp_path):
    assert read_csv(spark, put(tmp_path, "data.csv", "")).columns == []


def test_schema_given(spark, tmp_path):
    path = put(tmp_path, "data.csv", CASES["missing"])
    df = read_delimited(spark, path, schema="a int, c string, d boolean")
    assert [tuple(r) for r in df.collect()] == [(1, "x", True), (None, None, False), (3, None, True)]


def test_encoding(spark, tmp_path):
    path = put(tmp_path, "data.csv", CASES["accents"], "latin-1")
    df = read_csv(spark, path, encoding="ISO-8859-1")
    assert [tuple(r) for r in df.collect()][0] == ("Éloïse", "Paris")


def test_encoded_header(spark, tmp_path):
    path = put(tmp_path, "data.csv", "prénom,é\nZoé,1\n", "latin-1")
    assert read_csv(spark, path, encoding="ISO-8859-1").columns == ["prénom", "é"]


@pytest.mark.parametrize("text", ["a,b\n1,2\n3,4,LOST\n", 'a,b\n1,"x\ny"\n3,4,LOST\n'])
def test_surplus_fields_fail(spark, tmp_path, text):
    with pytest.raises(Exception, match="more fields"):
        read_csv(spark, put(tmp_path, "data.csv", text)).collect()


def test_wrong_bytes_fail(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)utf"):
        read_csv(spark, put(tmp_path, "data.csv", "a\nMontréal\n", "latin-1")).collect()


def test_wide_file(spark, tmp_path):
    n = 1000
    text = ",".join(f"c{i}" for i in range(n)) + "\n" + ",".join(str(i) if i % 2 else f"{i}.5" for i in range(n)) + "\n"
    started = time.monotonic()
    df = read_csv(spark, put(tmp_path, "wide.csv", text))
    assert [t for _, t in df.dtypes] == ["double", "bigint"] * (n // 2)
    assert time.monotonic() - started < 30


def test_byte_order_mark(spark, tmp_path):
    assert read_csv(spark, put(tmp_path, "data.csv", "\ufeffid,x\n1,2\n")).columns == ["id", "x"]


def test_pq_alias(spark, tmp_path):
    frame = pd.DataFrame(SAMPLE, columns=["id", "nom", "age", "ville"])
    frame.to_parquet(tmp_path / "data.pq", index=False)
    frame.to_parquet(tmp_path / "other.parquet", index=False)
    assert read_parquet(spark, str(tmp_path), glob="*.pq").count() == 3
    assert [tuple(r) for r in read_parquet(spark, str(tmp_path / "data.pq")).collect()] == SAMPLE


def test_names():
    assert unique_names(["a", None, "A", "a"]) == ["a", "Unnamed: 1", "A.1", "a.2"]
    assert unique_names(["a", "A", "a"], case_sensitive=True) == ["a", "A", "a.1"]


CELLS = st.sampled_from(
    ["1", "-2", "+3", "4.5", "1e3", "", "NA", "nan", "x", "True", "false", "inf", "007", "2024-01-01", " 5", "1 2", "-", ".", "1.", "None"]
)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(CELLS, min_size=1, max_size=4))
def test_any_column_types_as_pandas(spark, cells):
    text = "i,v\n" + "".join(f"{i},{c}\n" for i, c in enumerate(cells))
    frame = pd.read_csv(io.StringIO(text))
    df = type_columns(spark.createDataFrame([(str(i), c) for i, c in enumerate(cells)], "i string, v string"))
    same_as_pandas(df, frame)
