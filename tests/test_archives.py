"""Archives and the tables inside them."""

import bz2
import gzip
import io
import lzma
import tarfile
import zipfile

import pandas as pd
import pyarrow as pa
import pytest

from terralode.sources import archive
from terralode.sources.archive import read_archives, save_members, unpack_files
from terralode.sources.listing import read_files
from terralode.sources.registry import NoReader, read_tables

CSV = b"id,name\n1,Alice\n2,Bob\n3,Charlie\n"
ROWS = [(1, "Alice"), (2, "Bob"), (3, "Charlie")]


def zip_bytes(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)
    return out.getvalue()


def tar_bytes(members, mode="w"):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as t:
        for name, data in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    return out.getvalue()


ONE_TABLE = {
    "data.zip": zip_bytes({"data.csv": CSV}),
    "data.tar": tar_bytes({"data.csv": CSV}),
    "data.tgz": tar_bytes({"data.csv": CSV}, "w:gz"),
    "data.csv.gz": gzip.compress(CSV),
    "data.csv.bz2": bz2.compress(CSV),
    "data.csv.xz": lzma.compress(CSV),
    "data.tar.gz": tar_bytes({"data.csv": CSV}, "w:gz"),
    "outer.zip": zip_bytes({"in/inner.zip": zip_bytes({"data.csv": CSV})}),
}


@pytest.mark.parametrize("name", ONE_TABLE)
def test_one_table(spark, tmp_path, rows, name):
    (tmp_path / name).write_bytes(ONE_TABLE[name])
    (df,) = read_tables(spark, str(tmp_path / name)).values()
    assert dict(df.dtypes) == {"id": "bigint", "name": "string"}
    assert rows(df, "id", "name") == ROWS


def test_members_of_several_kinds(spark, tmp_path, rows):
    parquet = io.BytesIO()
    pd.DataFrame(ROWS, columns=["id", "name"]).to_parquet(parquet, index=False)
    members = {
        "file1.csv": CSV,
        "dir/file2.tsv": CSV.replace(b",", b"\t"),
        "other/file1.csv": b"id,name\n9,Zoe\n",
        "x.jsonl": b'{"id": 1, "name": "Alice"}\n',
        "t.parquet": parquet.getvalue(),
        "readme.md": b"nothing to read",
    }
    (tmp_path / "many.zip").write_bytes(zip_bytes(members))
    tables = read_tables(spark, str(tmp_path / "many.zip"))
    assert set(tables) == {"many.zip_file1", "many.zip_dir_file2", "many.zip_other_file1", "many.zip_x", "many.zip_t"}
    assert rows(tables["many.zip_t"], "id", "name") == ROWS
    assert rows(tables["many.zip_dir_file2"], "id", "name") == ROWS
    assert rows(tables["many.zip_other_file1"], "id", "name") == [(9, "Zoe")]


def test_a_broken_archive_gives_an_error_row(spark, tmp_path):
    (tmp_path / "bad.zip").write_bytes(b"not a zip")
    (tmp_path / "good.zip").write_bytes(ONE_TABLE["data.zip"])
    got = {r["archive"].rsplit("/", 1)[-1]: r for r in read_archives(spark, str(tmp_path)).collect()}
    assert got["bad.zip"]["error"] and got["bad.zip"]["member"] is None
    assert got["good.zip"]["error"] is None and bytes(got["good.zip"]["content"]) == CSV


def test_quoted_line_breaks_survive(spark, tmp_path, rows):
    (tmp_path / "q.zip").write_bytes(zip_bytes({"q.csv": b'a,b\n1,"x\ny"\n2,z\n'}))
    (df,) = read_tables(spark, str(tmp_path / "q.zip")).values()
    assert rows(df, "a", "b") == [(1, "x\ny"), (2, "z")]


def test_many_members(spark, tmp_path):
    members = {f"m{i}.txt": b"x" * 10 for i in range(5000)}
    (tmp_path / "n.tar").write_bytes(tar_bytes(members))
    assert read_archives(spark, str(tmp_path)).select("member").distinct().count() == 5000


def test_a_task_holds_few_members():
    """Members go on in batches of a few MB: all of a task's workers hold them at once."""
    members = {f"{i}.txt": bytes([i]) * 1_000_000 for i in range(12)}
    content = zip_bytes(members)
    given = pa.RecordBatch.from_pydict({"path": ["a.zip", "b.zip"], "content": [content, content]})
    batches = list(archive._unpack(iter([given])))
    assert max(b.nbytes for b in batches) < 5_000_000
    found = [(r["archive"], r["member"], r["content"]) for b in batches for r in b.to_pylist()]
    assert found == [(a, name, data) for a in ("a.zip", "b.zip") for name, data in members.items()]


@pytest.mark.parametrize("name", ONE_TABLE)
def test_archives_too_large_for_a_value_are_opened_in_place(spark, tmp_path, name):
    (tmp_path / name).write_bytes(ONE_TABLE[name])
    (row,) = unpack_files(read_files(spark, str(tmp_path))).collect()
    assert row["error"] is None and bytes(row["content"]) == CSV


def test_saved_members_are_read_by_extension(spark, tmp_path):
    (tmp_path / "z.zip").write_bytes(zip_bytes({"a.csv": CSV, "b.bin": b"\x00", "c": b"x"}))
    saved = save_members(read_archives(spark, str(tmp_path / "z.zip")), str(tmp_path / "members"))
    assert sorted((r["table"], r["size"]) for r in saved.collect()) == [("z.zip_a.csv", len(CSV)), ("z.zip_b.bin", 1), ("z.zip_c", 1)]
    assert saved.filter("ext = 'csv'").count() == 1


def test_staged_bytes_are_the_members(spark, tmp_path):
    from terralode.sources.archive import stage_members

    latin = "id,nom\n1,José\n".encode("latin-1")
    (tmp_path / "l.zip").write_bytes(zip_bytes({"a.csv": latin, "b.csv": latin + "2,Noë".encode("latin-1"), "c.csv": b""}))
    saved = save_members(read_archives(spark, str(tmp_path / "l.zip")), str(tmp_path / "members"))
    staged = stage_members(saved, ["csv"])
    got = {r["table"]: bytes(r["content"]) for r in spark.read.format("binaryFile").load(staged).select("table", "content").collect()}
    assert got == {"l.zip_a.csv": latin, "l.zip_b.csv": latin + "2,Noë\n".encode("latin-1"), "l.zip_c.csv": b"\n"}


def test_long_texts_come_in_parts(spark, tmp_path, monkeypatch):
    from terralode.sources import archive

    monkeypatch.setattr(archive, "PART_BYTES", 1000)
    lines = [f'{i},"x{i}\ny"' if i % 7 == 0 else f"{i},x{i}" for i in range(3000)]
    text = ("id,s\n" + "\n".join(lines)).encode()
    one_line = b"z" * 5000
    (tmp_path / "long.zip").write_bytes(zip_bytes({"a.csv": text, "b.txt": one_line, "c.parquet": one_line}))
    (tmp_path / "long.csv.xz").write_bytes(lzma.compress(text))
    parts = read_archives(spark, str(tmp_path)).orderBy("archive", "member", "part").collect()
    whole = {}
    for row in parts:
        whole.setdefault(row["member"], []).append(bytes(row["content"]))
    assert len(whole["a.csv"]) > 20 and all(p.endswith(b"\n") for p in whole["a.csv"][:-1])
    assert b"".join(whole["a.csv"]) == text == b"".join(whole["long.csv"])
    assert whole["b.txt"] == [one_line] and whole["c.parquet"] == [one_line]
    df = read_tables(spark, str(tmp_path / "long.csv.xz"))["long.csv.xz_long"]
    got = sorted(tuple(r) for r in df.collect())
    assert got == [(i, f"x{i}\ny" if i % 7 == 0 else f"x{i}") for i in range(3000)]


def test_no_reader(spark, tmp_path):
    with pytest.raises(NoReader):
        read_tables(spark, str(tmp_path / "plan.dwg"))


def test_workbooks_and_dbase_inside_an_archive(spark, tmp_path, rows):
    from tests.test_dbase import dbf
    from tests.test_office import workbook

    sheet = '<row r="1"><c r="A1" t="str"><v>k</v></c></row><row r="2"><c r="A2"><v>5</v></c></row>'
    book = workbook(tmp_path / "b.xlsx", {"One": sheet, "Two": sheet})
    with open(book, "rb") as f:
        members = {"in/b.xlsx": f.read(), "t.dbf": dbf([("id", "N", 3, 0)], [b"   1", b"   2"])}
    (tmp_path / "in.zip").write_bytes(zip_bytes(members))
    tables = read_tables(spark, str(tmp_path / "in.zip"))
    assert set(tables) == {"in.zip_in_b_One", "in.zip_in_b_Two", "in.zip_t"}
    assert rows(tables["in.zip_in_b_Two"]) == [(5,)]
    assert rows(tables["in.zip_t"]) == [(1,), (2,)]
