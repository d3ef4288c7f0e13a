"""dBase files, written here byte by byte."""

import struct

import pytest

from terralode.sources import dbase
from terralode.sources.dbase import read_dbf
from terralode.sources.registry import read_tables


def dbf(fields, records, end=b""):
    size = 1 + sum(length for _, _, length, _ in fields)
    header = 32 + 32 * len(fields) + 1 + len(end)
    out = struct.pack("<BBBBIHH20x", 3, 124, 1, 1, len(records), header, size)
    for name, kind, length, decimals in fields:
        out += struct.pack("<11sc4xBB14x", name.encode(), kind.encode(), length, decimals)
    return out + b"\r" + end + b"".join(records) + b"\x1a"


FIELDS = [("id", "N", 4, 0), ("nom", "C", 10, 0), ("age", "N", 4, 0), ("price", "N", 8, 2), ("day", "D", 8, 0), ("ok", "L", 1, 0), ("code", "C", 3, 0), ("n", "I", 4, 0)]


def record(i, nom, age, price, day, ok, code, n, mark=b" "):
    text = f"{i:>4}".encode() + nom.encode().ljust(10) + f"{age:>4}".encode() + f"{price:>8}".encode()
    return mark + text + day.encode().ljust(8) + ok.encode() + code.encode().ljust(3) + struct.pack("<i", n)


def test_types_deleted_rows_and_blanks(spark, tmp_path, rows):
    records = [
        record(1, "Éloïse", 25, "9.50", "20240131", "T", "007", -5),
        record(2, "gone", 1, "1.00", "20240131", "T", "008", 0, mark=b"*"),
        record(3, "Bob", "", "****", "", "F", "", 2**31 - 1),
    ]
    (tmp_path / "people.dbf").write_bytes(dbf(FIELDS, records))
    df = read_tables(spark, str(tmp_path / "people.dbf"))["people"]
    assert dict(df.dtypes) == {
        "id": "bigint",
        "nom": "string",
        "age": "double",
        "price": "double",
        "day": "string",
        "ok": "boolean",
        "code": "string",
        "n": "bigint",
    }
    assert [tuple(r) for r in df.orderBy("id").collect()] == [
        (1, "Éloïse", 25.0, 9.5, "2024-01-31", True, "007", -5),
        (3, "Bob", None, None, None, False, "", 2**31 - 1),
    ]


def test_no_records_and_a_longer_header(spark, tmp_path):
    (tmp_path / "none.dbf").write_bytes(dbf(FIELDS[:2], [], end=b"\x00" * 263))
    df = read_tables(spark, str(tmp_path / "none.dbf"))["none"]
    assert df.columns == ["id", "nom"] and df.count() == 0


def test_many_records(spark, tmp_path):
    (tmp_path / "many.dbf").write_bytes(dbf([("id", "N", 8, 0)], [b" " + f"{i:>8}".encode() for i in range(20_000)]))
    df = read_tables(spark, str(tmp_path / "many.dbf"))["many"]
    assert df.agg({"id": "sum"}).first()[0] == sum(range(20_000))


def test_one_file_is_read_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dbase, "RANGE_BYTES", 1000)
    records = [(b"*" if i % 7 == 0 else b" ") + f"{i:>8}".encode() for i in range(5_000)]
    (tmp_path / "big.dbf").write_bytes(dbf([("id", "N", 8, 0)], records))
    (tmp_path / "small.dbf").write_bytes(dbf([("id", "N", 8, 0)], [b"   900000"]))
    cut = dbase.range_records(dbase.file_heads(spark, str(tmp_path)))
    assert cut.rdd.getNumPartitions() == 47
    df = read_dbf(spark, str(tmp_path))
    assert sorted(r["id"] for r in df.collect()) == [*(i for i in range(5_000) if i % 7), 900_000]


def test_files_of_several_layouts_are_each_read_by_their_own(spark, tmp_path):
    (tmp_path / "a.dbf").write_bytes(dbf([("id", "N", 3, 0), ("nom", "C", 5, 0), ("code", "N", 2, 0)], [b"   1ann   7", b"   2bob   8"]))
    (tmp_path / "b.dbf").write_bytes(dbf([("nom", "C", 8, 0), ("id", "N", 6, 0), ("code", "C", 3, 0)], [b" caroline     3x1 "]))
    (tmp_path / "c.dbf").write_bytes(dbf([("nom", "C", 8, 0), ("id", "N", 6, 0), ("code", "C", 3, 0)], [b" dan          4   ", b" eve          5y2 "]))
    df = read_dbf(spark, str(tmp_path))
    assert dict(df.dtypes)["id"] == "bigint" and dict(df.dtypes)["code"] == "string"
    found = [tuple(r) for r in df.select("id", "nom", "code").orderBy("id").collect()]
    assert [(i, nom, (code or "").strip()) for i, nom, code in found] == [(1, "ann", "7"), (2, "bob", "8"), (3, "caroline", "x1"), (4, "dan", ""), (5, "eve", "y2")]


def test_a_file_shorter_than_its_header_says_fails(spark, tmp_path):
    content = dbf([("id", "N", 8, 0)], [b" " + f"{i:>8}".encode() for i in range(20)])
    (tmp_path / "short.dbf").write_bytes(content[:-30])
    with pytest.raises(Exception, match="its header tells of 20 records"):
        read_dbf(spark, str(tmp_path / "short.dbf")).collect()
