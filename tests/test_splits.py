"""Records cut in splits against the same files read as a whole."""

import csv
import io
import json
import random
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from terralode.sources.splits import DelimitedLines, JsonElements, XmlElements, read_records
from terralode.sources.structured import read_geojson, read_json, read_kml, read_xml
from terralode.sources.tabular import read_csv


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "301")
    yield spark
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def put(folder, name, text):
    path = folder / name
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return f"file:{path}"


def in_order(records):
    rows = records.rows.orderBy("path", "block", "nth").collect()
    return [bytes(r["record"]).decode() for r in rows]


PIECES = ["a", "é", '"', ",", "\n", "\r\n", "x" * 40, '""', " ", "{", "}", "[", "]", "\\", "</record>", "<", ">", "'", "-->", "]]>", "y" * 130]


def field(rnd):
    return "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 5)))


@pytest.mark.parametrize("seed", range(4))
def test_delimited_records(small_splits, tmp_path, seed):
    rnd = random.Random(seed)
    rows = [[field(rnd), field(rnd), 'stray " quote'] for _ in range(60)]
    out = io.StringIO()
    end = rnd.choice(["\n", "\r\n", "\r"])
    for a, b, c in rows:
        quoted = [f'"{x}"' for x in (a.replace('"', '""'), b.replace('"', '""'))]
        out.write(",".join([*quoted, c]) + end + (end if rnd.random() < 0.1 else ""))
    text = out.getvalue()
    path = put(tmp_path, "a.csv", text[: -len(end)] if seed % 2 else text)
    found = read_records(small_splits, path, DelimitedLines(","))
    assert found.broken == []
    assert len({r["block"] for r in found.rows.select("block").collect()}) > (1 if end == "\r" else 8) - 1
    assert [next(csv.reader([r], strict=True)) if "\n" not in r and "\r" not in r else next(csv.reader(io.StringIO(r, newline=""))) for r in in_order(found)] == rows


def test_a_quote_that_does_not_end_fails(small_splits, tmp_path):
    path = put(tmp_path, "a.csv", "k,v\n" + "1,x\n" * 200 + '2,"open\n' + "3,y\n" * 200)
    with pytest.raises(ValueError, match="does not end"):
        read_csv(small_splits, path)


def test_csv_with_line_breaks_has_several_tasks(small_splits, tmp_path):
    rows = [(i, f'line {i}\n"quoted", {"z" * (i % 150)}') for i in range(200)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([("id", "text"), *rows])
    df = read_csv(small_splits, put(tmp_path, "a.csv", out.getvalue()))
    assert df.rdd.getNumPartitions() > 2
    assert sorted((r["id"], r["text"]) for r in df.collect()) == rows


def value(rnd, depth=0):
    kind = rnd.randint(0, 5 if depth < 3 else 2)
    if kind == 0:
        return rnd.choice([None, True, 3, -2.5])
    if kind <= 2:
        return field(rnd)
    if kind == 3:
        return [value(rnd, depth + 1) for _ in range(rnd.randint(0, 3))]
    return {field(rnd) or "k": value(rnd, depth + 1) for _ in range(rnd.randint(0, 3))}


@pytest.mark.parametrize("seed", range(4))
def test_json_elements(small_splits, tmp_path, seed):
    rnd = random.Random(seed)
    rows = [{"id": i, **{f"v{j}": value(rnd) for j in range(rnd.randint(0, 3))}} for i in range(50)]
    text = json.dumps(rows, indent=rnd.choice([None, 2]), ensure_ascii=bool(seed % 2)) + rnd.choice(["", "\n"])
    found = read_records(small_splits, put(tmp_path, "a.json", text), JsonElements())
    assert found.broken == [] and found.single == []
    assert len({r["block"] for r in found.rows.select("block").collect()}) > 5
    assert [json.loads(r) for r in in_order(found)] == rows
    cut = read_records(small_splits, put(tmp_path, "b.json", text[: rnd.randint(1, len(text.rstrip()) - 1)]), JsonElements())
    assert len(cut.broken) == 1 and cut.rows.isEmpty()


@pytest.mark.parametrize("first", [True, False])
def test_geojson_features(small_splits, tmp_path, first):
    rnd = random.Random(3)
    features = [
        {"type": "Feature", "properties": {"id": i, "note": field(rnd)}, "geometry": {"type": "Point", "coordinates": [i, -i / 2]}}
        for i in range(40)
    ]
    members = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "x"}}, "features": features, "after": [{"type": "other"}]}
    if not first:
        members = dict(reversed(members.items()))
    path = put(tmp_path, "a.geojson", json.dumps(members))
    got = read_geojson(small_splits, path).collect()
    assert sorted((r["id"], r["note"], r["lon"], r["lat"]) for r in got) == [(f["properties"]["id"], f["properties"]["note"], *map(float, f["geometry"]["coordinates"])) for f in features]
    with pytest.raises(ValueError, match="malformed"):
        read_geojson(small_splits, put(tmp_path, "cut.geojson", json.dumps(members)[:-1]))


def test_a_file_that_is_one_feature(small_splits, tmp_path):
    line = {"type": "LineString", "coordinates": [[i, i + 0.5] for i in range(60)]}
    feature = {"properties": {"name": "b}a", "n": 1}, "type": "Feature", "geometry": line}
    (row,) = read_geojson(small_splits, put(tmp_path, "one.geojson", json.dumps(feature) + "\n")).collect()
    assert (row["name"], row["n"], row["geometry_type"], json.loads(row["geometry"])) == ("b}a", 1, "LineString", line)
    for name, text in [("none.geojson", '{"type": "Topology"}'), ("list.geojson", "[1]")]:
        with pytest.raises(ValueError, match="malformed"):
            read_geojson(small_splits, put(tmp_path, name, text))
    assert read_geojson(small_splits, put(tmp_path, "empty.geojson", '{"type": "FeatureCollection", "features": []}')).collect() == []


def test_json_by_columns(spark, rows, tmp_path):
    objects = read_json(spark, put(tmp_path, "a.json", '{"a": {"0": 1, "1": 2}, "b": {"0": "x", "2": "y"}}'))
    assert rows(objects, "a", "b") == [(1, "x"), (2, None), (None, "y")]
    arrays = read_json(spark, put(tmp_path, "b.json", '{"a": [1, 2, 3], "b": [{"c": 1}, null, []]}'))
    assert rows(arrays, "a", "b") == [(1, '{"c":1}'), (2, None), (3, "[]")]
    assert rows(read_json(spark, put(tmp_path, "c.json", '{"a": 1, "b": {"c": 2}}')), "a", "b") == [(1, '{"c":2}')]
    assert read_json(spark, put(tmp_path, "d.json", '{"a": [], "b": []}')).collect() == []


def test_json_names_that_differ_in_case(spark, rows, tmp_path):
    df = read_json(spark, put(tmp_path, "a.json", '[{"Name": 1, "name": "x"}, {"NAME": true}]'))
    assert len(df.columns) == 3 and df.count() == 2


def test_json_of_other_things_than_objects_fails(spark, tmp_path):
    for text in ("[1, 2]", '[{"a": 1}, 2]', '"x"', "nonsense"):
        with pytest.raises(Exception, match="(?i)malformed|other things"):
            read_json(spark, put(tmp_path, "a.json", text)).collect()


@pytest.mark.parametrize("seed", range(4))
def test_xml_elements(small_splits, tmp_path, seed):
    rnd = random.Random(seed)
    root = ET.Element("records")
    for i in range(50):
        record = ET.SubElement(root, "record", {"id": str(i), "note": field(rnd).replace("\r", "")})
        if rnd.random() < 0.8:
            ET.SubElement(record, "v").text = field(rnd).replace("\r", "") or None
        if rnd.random() < 0.2:
            ET.SubElement(record, "record", {"id": "inner"}).text = "x"
        if rnd.random() < 0.2:
            ET.SubElement(root, "other").text = "between"
    text = ET.tostring(root, encoding="unicode")
    text = text.replace("<other>", "<!-- <record> </record> --><other><![CDATA[</record><record>]]>").replace("</record><record ", "</record ><record ", 3)
    found = read_records(small_splits, put(tmp_path, "a.xml", '<?xml version="1.0"?>\n<!DOCTYPE records>\n' + text + rnd.choice(["", "\n"])), XmlElements("record"))
    assert found.broken == []
    assert len({r["block"] for r in found.rows.select("block").collect()}) > 5
    canonical = lambda e: ET.canonicalize(e, strip_text=False)
    want = [canonical(ET.tostring(e, encoding="unicode").strip()) for e in ET.fromstring(text).findall("record")]
    want = [w[: w.rindex(">") + 1] for w in want]
    assert [canonical(r) for r in in_order(found)] == want
    for cut in ("</records>", "</record></records>"):
        broken = read_records(small_splits, put(tmp_path, "b.xml", text.removesuffix("</records>") + cut.removesuffix("</records>")), XmlElements("record"))
        assert len(broken.broken) == 1


def test_xml_and_kml_tables_have_several_tasks(small_splits, tmp_path):
    text = "<records>" + "".join(f'<record id="{i}"><name>n{i}</name></record>' for i in range(100)) + "</records>"
    df = read_xml(small_splits, put(tmp_path, "a.xml", text))
    assert df.rdd.getNumPartitions() > 2
    assert sorted(map(tuple, df.select("id", "name").collect())) == [(i, f"n{i}") for i in range(100)]
    marks = "".join(f"<Placemark><name>p{i}</name><Point><coordinates>{i},2</coordinates></Point></Placemark>" for i in range(50))
    kml = read_kml(small_splits, put(tmp_path, "a.kml", f'<kml xmlns="http://www.opengis.net/kml/2.2"><Document>{marks}</Document></kml>'))
    assert kml.rdd.getNumPartitions() > 2
    assert sorted((r["name"], r["lon"], r["lat"]) for r in kml.collect()) == sorted((f"p{i}", float(i), 2.0) for i in range(50))
    with pytest.raises(ValueError, match="malformed"):
        read_xml(small_splits, put(tmp_path, "b.xml", text.removesuffix("</records>")))
