"""JSON, XML, GeoJSON and KML files."""

import json
import zipfile

import pytest

from terralode.operators.flatten import json_objects_to_columns, variant_ddl
from terralode.sources.registry import read_tables
from terralode.sources.structured import (
    read_geojson,
    read_geojson_lines,
    read_json,
    read_kml,
    read_xml,
    row_tag,
)


def put(tmp_path, name, text):
    (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path / name)


def test_json_array(spark, tmp_path, rows):
    gauges = [{"gauge": f"Doubs {n}", "level_cm": 40 * n, "wet": n % 2 == 0} for n in range(5)]
    gauges.append({"gauge": "Ée", "level_cm": None})
    df = read_json(spark, put(tmp_path, "gauges.json", json.dumps(gauges, indent=1, ensure_ascii=False)))
    assert dict(df.dtypes) == {"gauge": "string", "level_cm": "bigint", "wet": "boolean"}
    assert rows(df, "gauge", "level_cm", "wet") == sorted(((g["gauge"], g["level_cm"], g.get("wet")) for g in gauges), key=repr)


def test_json_lines(spark, tmp_path, rows):
    readings = [{"at": f"2021-03-0{d}", "mm": d / 4} for d in range(1, 8)]
    path = put(tmp_path, "rain.jsonl", "".join(json.dumps(r) + "\n" for r in readings))
    assert rows(read_json(spark, path, lines=True), "at", "mm") == [(r["at"], r["mm"]) for r in readings]


def test_nested_json_becomes_json_text(spark, tmp_path):
    trips = [{"trip": 7, "legs": [{"km": 1.5, "via": ["Dole", "Dijon"]}, {"km": 3.0, "via": []}]}, {"trip": 8, "legs": []}]
    df = read_json(spark, put(tmp_path, "trips.json", json.dumps(trips)))
    assert dict(df.dtypes) == {"legs": "string", "trip": "bigint"}
    assert {r["trip"]: json.loads(r["legs"]) for r in df.collect()} == {t["trip"]: t["legs"] for t in trips}


def test_xml_elements(spark, tmp_path, rows):
    body = "".join(f"<record><depth>{d / 2}</depth><rock>{r}</rock></record>\n" for d, r in enumerate(["clay &amp; loam", "grès", "chalk", ""]))
    df = read_xml(spark, put(tmp_path, "core.xml", f"<core site='B12'>\n{body}</core>\n"))
    assert dict(df.dtypes) == {"depth": "double", "rock": "string"}
    assert rows(df, "depth") == [(0.0,), (0.5,), (1.0,), (1.5,)]
    assert {r["rock"] for r in df.collect()} >= {"clay & loam", "grès", "chalk"}


def test_xml_attributes(spark, tmp_path, rows):
    path = put(tmp_path, "d.xml", '<data><item id="1" name="A"/><item id="2" name="B"/></data>')
    assert rows(read_xml(spark, path, ".//item"), "id", "name") == [(1, "A"), (2, "B")]


def test_xml_mixed(spark, tmp_path, rows):
    beds = "".join(f'<record ward="W{n}" beds="{n * 10}"><open>{"true" if n > 1 else "false"}</open></record>' for n in (1, 2, 3))
    df = read_xml(spark, put(tmp_path, "wards.xml", f"<hospital><name>Nord</name>{beds}</hospital>"))
    assert rows(df, "ward", "beds", "open") == [("W1", 10, False), ("W2", 20, True), ("W3", 30, True)]


def test_xml_dates_stay_text(spark, tmp_path):
    path = put(tmp_path, "d.xml", "<data><record><d>2024-01-01</d></record><record><d>2024-01-02</d></record></data>")
    assert dict(read_xml(spark, path).dtypes) == {"d": "string"}


@pytest.mark.parametrize("xpath", [".//a/b", "//a[1]", ""])
def test_other_paths_are_refused(xpath):
    with pytest.raises(ValueError):
        row_tag(xpath)


def features(*items):
    return json.dumps(
        {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": p, "geometry": g} for p, g in items]},
        ensure_ascii=False,
    )


def test_geojson_points(spark, tmp_path, rows):
    points = [(2.3522, 48.8566), (4.8357, 45.7640), (-0.5792, 44.8378)]
    path = put(
        tmp_path,
        "d.geojson",
        features(*[({"id": i, "name": f"p{i}", "value": i * 10}, {"type": "Point", "coordinates": list(p)}) for i, p in enumerate(points)]),
    )
    df = read_geojson(spark, path)
    assert rows(df, "id", "name", "value", "geometry_type", "lon", "lat") == [
        (i, f"p{i}", i * 10, "Point", *p) for i, p in enumerate(points)
    ]
    assert json.loads(df.orderBy("id").first()["geometry"]) == {"type": "Point", "coordinates": [2.3522, 48.8566]}


def test_geojson_mixed_geometries_and_ragged_properties(spark, tmp_path, rows):
    ring = [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]
    path = put(
        tmp_path,
        "d.geojson",
        features(
            ({"id": 1, "name": "Zone A"}, {"type": "Polygon", "coordinates": [ring]}),
            ({"id": 2, "size": 1.5}, {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}),
            ({"id": 3}, None),
        ),
    )
    df = read_geojson(spark, path)
    assert rows(df, "id", "name", "size", "geometry_type", "lon") == [
        (1, "Zone A", None, "Polygon", None),
        (2, None, 1.5, "LineString", None),
        (3, None, None, None, None),
    ]


def test_geojson_lines(spark, tmp_path, rows):
    line = '{"type":"Feature","properties":{"id":%d},"geometry":{"type":"Point","coordinates":[%d,2]}}\n'
    path = put(tmp_path, "d.geojsonl", line % (1, 5) + line % (2, 6))
    assert rows(read_geojson_lines(spark, path), "id", "lon", "lat") == [(1, 5.0, 2.0), (2, 6.0, 2.0)]


KML = """<?xml version="1.0" encoding="UTF-8"?>
<kml xmlns="http://www.opengis.net/kml/2.2"><Document><Folder>
<Placemark><name>Point A</name><Point><coordinates>2.3522,48.8566,0</coordinates></Point></Placemark>
<Placemark><name>Route</name><LineString><coordinates>0,0,0 1,1,0
  2,2,0</coordinates></LineString></Placemark>
</Folder><Placemark><name>Zone</name><description>square</description><Polygon><outerBoundaryIs><LinearRing>
<coordinates>0,0 1,0 1,1 0,0</coordinates></LinearRing></outerBoundaryIs>
<innerBoundaryIs><LinearRing><coordinates>0.1,0.1 0.2,0.1 0.2,0.2 0.1,0.1</coordinates></LinearRing></innerBoundaryIs>
</Polygon></Placemark></Document></kml>"""


def check_kml(df):
    got = {r["name"]: r for r in df.collect()}
    assert set(got) == {"Point A", "Route", "Zone"}
    assert (got["Point A"]["lon"], got["Point A"]["lat"]) == (2.3522, 48.8566)
    assert json.loads(got["Route"]["geometry"]) == {"type": "LineString", "coordinates": [[0, 0, 0], [1, 1, 0], [2, 2, 0]]}
    zone = json.loads(got["Zone"]["geometry"])
    assert zone["type"] == "Polygon" and [len(r) for r in zone["coordinates"]] == [4, 4]
    assert got["Zone"]["description"] == "square"


def test_kml(spark, tmp_path):
    check_kml(read_kml(spark, put(tmp_path, "d.kml", KML)))


def test_kmz(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "place.kmz", "w") as z:
        z.writestr("doc.kml", KML)
    (df,) = read_tables(spark, str(tmp_path / "place.kmz")).values()
    check_kml(df)


def test_objects_to_columns(spark, rows):
    df = spark.createDataFrame([('{"a": 1, "b": {"c": [1.5]}}',), ('{"a": 2, "é x": "t"}',), (None,), ("{bad",)], "t string")
    out = json_objects_to_columns(df, "t")
    assert dict(out.dtypes) == {"a": "bigint", "b": "struct<c:array<double>>", "é x": "string"}
    assert out.count() == 4


def test_variant_ddl():
    assert variant_ddl("OBJECT<a: DECIMAL(3,1), b: ARRAY<OBJECT<c: DECIMAL(18,0), d: VOID>>, `é VOID`: DECIMAL(20,0)>") == (
        "STRUCT<`a`: DOUBLE, `b`: ARRAY<STRUCT<`c`: BIGINT, `d`: STRING>>, `é VOID`: DECIMAL(20,0)>"
    )


def test_geojson_names_like_types_and_kept_columns(spark, tmp_path, rows):
    properties = {"VARIANTE": "x", "VOID_ID": 7, "big": 12345678901234567890, "lat": 3, "ID": 1, "id": 2}
    path = put(tmp_path, "d.geojson", features((properties, {"type": "Point", "coordinates": [5, 6]})))
    df = read_geojson(spark, path)
    df.write.parquet(str(tmp_path / "out"))
    (row,) = spark.read.parquet(str(tmp_path / "out")).collect()
    found = row.asDict()
    assert (found["VARIANTE"], found["VOID_ID"], int(found["big"])) == ("x", 7, 12345678901234567890)
    assert (found["lat"], found["lat.1"], found["ID"], found["id.1"]) == (6.0, 3, 1, 2)


@pytest.mark.parametrize(
    ("name", "text"),
    [("a.json", '[{"a": 1}, {"a": '), ("a.jsonl", '{"a": 1}\n{"a": '), ("a.xml", "<d><record><a>1</a></record><record><a>2</b></record></d>")],
)
def test_broken_files_fail(spark, tmp_path, name, text):
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        (df,) = read_tables(spark, put(tmp_path, name, text)).values()
        df.collect()


def kml_file(tmp_path, name, marks):
    return put(tmp_path, name, f'<kml xmlns="http://www.opengis.net/kml/2.2"><Document>{marks}</Document></kml>')


def test_kml_collections_keep_nesting_and_order(spark, tmp_path):
    at = lambda *p: f"<coordinates>{' '.join(p)}</coordinates>"
    point, line = f"<Point>{at('1,2')}</Point>", f"<LineString><tessellate>1</tessellate>{at('0,0', '1,x')}</LineString>"
    area = f"<Polygon><outerBoundaryIs><LinearRing>{at('0,0', '1,0', '1,1', '0,0')}</LinearRing></outerBoundaryIs></Polygon>"
    many = lambda *g: f"<MultiGeometry>{''.join(g)}</MultiGeometry>"
    deep = point
    for _ in range(40):
        deep = many(deep, line)
    shapes = {
        "points": many(point, point), "lines": many(line), "areas": many(area, area), "mixed": many(line, many(point, area), point),
        "empty": many(), "ring": f"<LinearRing>{at('0,0', '1,1')}</LinearRing>", "bare": f"<Point>{at()}</Point>", "none": "", "deep": deep,
    }
    marks = "".join(f"<Placemark><name>{name}</name><!-- <Point> -->{shape}</Placemark>" for name, shape in shapes.items())
    found = read_kml(spark, kml_file(tmp_path, "m.kml", marks)).collect()
    got = {r["name"]: r["geometry"] and json.loads(r["geometry"]) for r in found}
    assert got["points"] == {"type": "MultiPoint", "coordinates": [[1, 2], [1, 2]]}
    assert got["lines"] == {"type": "MultiLineString", "coordinates": [[[0, 0], [1, None]]]}
    assert got["areas"]["type"] == "MultiPolygon" and got["areas"]["coordinates"] == [[[[0, 0], [1, 0], [1, 1], [0, 0]]]] * 2
    assert [g["type"] for g in got["mixed"]["geometries"]] == ["LineString", "GeometryCollection", "Point"]
    assert [g["type"] for g in got["mixed"]["geometries"][1]["geometries"]] == ["Point", "Polygon"]
    assert got["empty"] == {"type": "GeometryCollection", "geometries": []}
    assert got["ring"] == {"type": "LineString", "coordinates": [[0, 0], [1, 1]]} and got["none"] is None
    inner, depth = got["deep"], 1
    while inner["geometries"][0]["type"] == "GeometryCollection":
        inner, depth = inner["geometries"][0], depth + 1
    assert depth == 40 and [r["geometry_type"] for r in found if r["name"] == "points"] == ["MultiPoint"]


@pytest.mark.parametrize("shape", ["<Model><Location/></Model>", "<MultiGeometry><Model/></MultiGeometry>"])
def test_kml_geometry_without_geojson_form_fails(spark, tmp_path, shape):
    path = kml_file(tmp_path, "t.kml", f"<Placemark><name>a</name>{shape}</Placemark>")
    with pytest.raises(Exception, match="no GeoJSON form"):
        read_kml(spark, path).collect()
