"""All files of a format converted at once against each converted alone."""

import gzip
import io
import json
import zipfile

import pytest

from terralode.plans.convert import convert_file, convert_new_files, read_ledger
from terralode.plans.together import convert_together
from terralode.sources.listing import literal_path

FILES = {
    "a.csv": "id,name,flag\n1,x,True\n2,NA,False\n",
    "b.csv": "id,name,flag\n1.5,y,True\n,z,\n",
    "c.csv": 'id,text\n1,"two\nlines, ""quoted"""\n2,plain\n',
    "no rows.csv": "id,name,flag\n",
    "d[1].csv": "k\n007\n9\n",
    "dup.csv": "a,a,A\n1,2,3\n",
    "semi.csv": "id;x\n1;2\n",
    "surplus.csv": "a,b\n1,2,3\n",
    "wrong.csv": b"a,b\n\xff\xfe,1\n",
    "header break.csv": '"a\nb",c\n1,2\n',
    "s.txt": "a;b\n1;x\n",
    "p.txt": "a|b|c\n1|2|3\n",
    "e.json": json.dumps([{"id": 1, "v": {"x": [1, 2]}}, {"id": 2, "w": None}, {"id": 2.5}]),
    "f.json": json.dumps([{"id": "x", "v": {"x": [3]}}]),
    "g.json": json.dumps({"a": {"0": 1, "1": 2}, "b": {"0": "x"}}),
    "none.json": "[]",
    "cut.json": '[{"id": 1}, {"id": ',
    "bad.json": '[{"id": 1}, {"id": nope}]',
    "h.jsonl": '{"id": 1, "file": "x"}\n\n{"id": 3}\n',
    "i.jsonl": '{"id": 1, "file": 3}\n',
    "lists.jsonl": '[{"id": 1}, {"id": 2}]\n[{"id": 3}]\n',
    "j.geojson": json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"lat": "n", "n": i}, "geometry": {"type": "Point", "coordinates": [i, 2]}} for i in range(3)]}),
    "k.geojson": json.dumps({"type": "Feature", "properties": {"m": True}, "geometry": None}),
    "l.geojson": '{"type": "Topology"}',
    "m.kml": "<kml><Placemark><name>a</name><Point><coordinates>1,2</coordinates></Point></Placemark></kml>",
    "n.kml": "<kml><Placemark><name>b</name></Placemark></kml>",
    "o.kml": "<kml><Placemark><name>b</name></Placemark>",
}
# A quoted field that does not end fails the job for all, and then this file alone.
OPEN_QUOTE = 'a,b\n1,"open\n2,3\n'


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())


def table_at(spark, folder, name):
    df = spark.read.parquet(literal_path(f"{folder}/{name}.parquet"))
    return df.dtypes, sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("ext", ["csv", "txt", "json", "jsonl", "geojson", "kml"])
def test_together_equals_alone(spark, tmp_path, ext):
    mine = {n: t for n, t in FILES.items() if n.endswith(f".{ext}")}
    for name, text in mine.items():
        put(tmp_path / "in", name, text)
    got = convert_together(spark, f"{tmp_path}/in", {n: n.removesuffix(f".{ext}") for n in mine}, ext, str(tmp_path / "all"))
    left = {"header break.csv", "lists.jsonl"}
    assert mine.keys() - got.keys() == mine.keys() & left
    for n, name in enumerate(mine):
        if name in left:
            continue
        put(tmp_path / "alone", f"{n}.{ext}", mine[name])
        try:
            convert_file(spark, f"{tmp_path}/alone/{n}.{ext}", str(tmp_path / "each"))
        except Exception:
            assert got[name], name
            continue
        assert got[name] is None, (name, got[name])
        assert table_at(spark, tmp_path / "all", name.removesuffix(f".{ext}")) == table_at(spark, tmp_path / "each", n), name
    assert not [p for p in (tmp_path / "all").iterdir() if p.name.startswith("_")]


def test_a_lot_of_all_formats(spark, rows, tmp_path):
    for name, text in FILES.items():
        put(tmp_path / "in", f"d/{name}", text)
    put(tmp_path / "in", "d/odd.txt", OPEN_QUOTE)
    put(tmp_path / "in", "z.csv.gz", gzip.compress(b"q\n1\n"))
    put(tmp_path / "in", "x.xml", "<r><record><a>1</a></record></r>")
    put(tmp_path / "in", "same.csv", "a\n1\n")
    put(tmp_path / "in", "z/same.json", '[{"b": 1}]')
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name in ("a.csv", "b.csv", "c.csv", "e.json", "bad.json"):
            z.writestr(f"m/{name}", FILES[name])
    put(tmp_path / "in", "all.zip", out.getvalue())
    convert = lambda: convert_new_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ledger"))
    results = convert()
    failed = {r["key"]: r["error"] for r in results.filter("not ok").collect()}
    broken = {"surplus.csv", "wrong.csv", "odd.txt", "cut.json", "bad.json", "none.json", "l.geojson", "o.kml"}
    assert failed.keys() == {f"d/{n}" for n in broken} | {"all.zip", "all.zip!m/bad.json"}, failed
    assert all(failed.values())
    tables = {r["table"] for r in results.filter("ok and table is not null").collect()}
    assert {p.name.removesuffix(".parquet") for p in (tmp_path / "out").iterdir()} == tables
    assert {"a", "d[1]", "no rows", "z", "x", "same", "s", "all.zip_m_a", "all.zip_m_c", "all.zip_m_e", "header break"} <= tables
    assert spark.read.parquet(str(tmp_path / "out" / "same.parquet")).columns == ["b"]
    assert rows(spark.read.parquet(str(tmp_path / "out" / "all.zip_m_c.parquet")), "id", "text") == [(1, 'two\nlines, "quoted"'), (2, "plain")]
    assert read_ledger(spark, str(tmp_path / "ledger")).filter("key = 'all.zip'").count() == 0
    again = {r["key"] for r in convert().select("key").collect()}
    assert {k for k in again if "!" not in k} == failed.keys() - {"all.zip!m/bad.json"}


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    def jobs(n):
        for i in range(n):
            put(tmp_path / f"in{n}", f"f{i}.csv", f"id,v\n{i},x\n")
        spark.sparkContext.setJobGroup(f"count {n}", "")
        try:
            convert_together(spark, f"{tmp_path}/in{n}", {f"f{i}.csv": f"f{i}" for i in range(n)}, "csv", str(tmp_path / f"out{n}"))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"count {n}"))

    few, many = jobs(3), jobs(30)
    assert few == many > 0
