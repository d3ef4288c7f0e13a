"""Scans and sinks: tables written out in a format and read back from the shared folder."""

from __future__ import annotations

import io
import lzma
import struct
import sys
import tarfile
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from terralode.operators.flatten import styled_paragraphs, text_paragraphs
from terralode.operators.infer import type_columns
from terralode.queries.flattening import PARAGRAPHS_SQL, STYLED_SQL
from terralode.queries.registry import query, table
from terralode.session import shared_dir
from terralode.sinks.parquet import append_to_ledger, move_folder, write_by_category, write_table
from terralode.sources.archive import save_members, stage_members, unpack
from terralode.sources.dbase import read_dbf
from terralode.sources.folders import list_every_object
from terralode.sources.listing import list_keys, list_objects, tail_lines
from terralode.sources.office import docx_paragraphs, ods_sheets, odt_paragraphs, save_rows, xlsx_sheets, xml_parts
from terralode.sources.registry import TABLE_READERS, TEXT_EXTENSIONS
from terralode.sources.structured import read_geojson, read_geojson_lines, read_json, read_kml, read_xml
from terralode.sources.tabular import read_csv, read_delimited, read_parquet, read_tsv, read_txt
from terralode.streaming.incremental import incremental_ingest, on_new_files

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDERS_SQL = """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') as o_orderdate, o_orderpriority
from orders
"""


def orders_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


def write_delimited(df: DataFrame, path: str, sep: str = ",", **options) -> str:
    whole = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"', **options}
    df.write.options(header=True, sep=sep, **whole).csv(path)
    return path


def write_files(values: DataFrame, folder: str, ext: str, end: str) -> None:
    """Each text of a column as a file of its own, its last characters given apart as the text sink's line end."""
    spark = values.sparkSession
    staged = shared_dir(spark, "files")
    values.write.options(maxRecordsPerFile=1, lineSep=end).text(staged)
    for row in list_keys(spark, staged, "*.txt").collect():
        move_folder(spark, f"{staged}/{row['key']}", f"{folder}/{row['key'].removesuffix('.txt')}.{ext}")


@query("csv_scan", ORDERS_SQL)
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv(spark, write_delimited(orders_as_text(spark, sf_dir), shared_dir(spark, "csv")))


@query(
    "csv_scan_missing",
    """
select o_orderkey, cast(case when o_orderstatus <> 'P' then o_custkey end as double) as o_custkey,
       case when o_orderpriority <> '5-LOW' then o_orderpriority end as o_orderpriority,
       case when o_orderstatus <> 'F' then o_totalprice end as o_totalprice,
       o_orderstatus = 'O' as is_open
from orders
""",
)
def csv_scan_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "NA").otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(F.col("o_orderstatus") == "O", "True").otherwise("False").alias("is_open"),
    )
    return read_csv(spark, write_delimited(texts, shared_dir(spark, "csv")))


@query("csv_scan_line_breaks", "select doc_id, text, lang, source, n_chars from documents")
def csv_scan_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv(spark, write_delimited(table(spark, sf_dir, "documents"), shared_dir(spark, "csv")))


@query("tsv_scan", "select p_partkey, p_name, p_brand, p_type, cast(p_size as bigint) as p_size, p_retailprice from part")
def tsv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_tsv(spark, write_delimited(table(spark, sf_dir, "part"), shared_dir(spark, "tsv"), sep="\t"))


@query("txt_scan", "select c_custkey, c_name, cast(c_nationkey as bigint) as c_nationkey, c_acctbal, c_mktsegment from customer")
def txt_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_txt(spark, write_delimited(table(spark, sf_dir, "customer"), shared_dir(spark, "txt"), sep=";"))


@query("csv_scan_with_schema", "select o_orderkey, try_cast(o_orderpriority as bigint) as o_orderpriority, o_totalprice from orders")
def csv_scan_with_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_delimited(orders_as_text(spark, sf_dir), shared_dir(spark, "csv"))
    return read_delimited(spark, path, schema="o_orderkey bigint, o_orderpriority bigint, o_totalprice double")


@query("csv_gz_scan", ORDERS_SQL)
def csv_gz_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv(spark, write_delimited(orders_as_text(spark, sf_dir), shared_dir(spark, "csv"), compression="gzip"))


@query("csv_bz2_scan", ORDERS_SQL)
def csv_bz2_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv(spark, write_delimited(orders_as_text(spark, sf_dir), shared_dir(spark, "csv"), compression="bzip2"))


@query(
    "jsonl_scan",
    """
select c_custkey, c_name, cast(to_json({'nation': c_nationkey, 'balance': c_acctbal}) as varchar) as place, c_mktsegment
from customer
""",
)
def jsonl_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "jsonl")
    place = F.struct(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    schema = "c_custkey bigint, c_name string, place struct<nation int, balance double>, c_mktsegment string"
    table(spark, sf_dir, "customer").select("c_custkey", "c_name", place.alias("place"), "c_mktsegment").write.json(path)
    return read_json(spark, path, lines=True, schema=schema)


@query("json_array_scan", "select doc_id, cast(quality as bigint) as quality, cast(toxic as bigint) as toxic from labels")
def json_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "json")
    record = F.to_json(F.array(F.struct("doc_id", "quality", "toxic")))
    table(spark, sf_dir, "labels").select(record.alias("value")).write.text(path)
    return read_json(spark, path, lines=True)


@query("xml_scan", "select s_suppkey, s_name, cast(s_nationkey as bigint) as s_nationkey, s_acctbal from supplier")
def xml_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "xml")
    # A leading underscore marks an attribute for the writer.
    records = table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "_s_suppkey")
    records.write.format("xml").options(rowTag="record", rootTag="records").save(path)
    return read_xml(spark, path)


@query("xml_scan_xpath", "select s_suppkey, s_name, s_acctbal from supplier")
def xml_scan_xpath(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records named by another path, the rest of each element beside them."""
    path = shared_dir(spark, "xml")
    rows = table(spark, sf_dir, "supplier").select(F.struct("s_suppkey", "s_name", "s_acctbal").alias("party"), F.col("s_nationkey").alias("note"))
    rows.write.format("xml").options(rowTag="record", rootTag="records").save(path)
    return read_xml(spark, path, ".//party")


POINTS_SQL = """
select c_custkey as id, c_name as name, 'Point' as geometry_type, c_nationkey * 0.5::double as lon, c_nationkey - 12.25::double as lat,
       '{"type":"Point","coordinates":[' || c_nationkey * 0.5::double || ',' || c_nationkey - 12.25::double || ']}' as geometry
from customer
"""


def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).alias("properties"),
        F.struct(
            F.lit("Point").alias("type"),
            F.array(F.col("c_nationkey") * F.lit(0.5), F.col("c_nationkey") - F.lit(12.25)).alias("coordinates"),
        ).alias("geometry"),
    )
    return table(spark, sf_dir, "customer").select("c_custkey", F.to_json(feature).alias("value"))


@query("geojson_scan", POINTS_SQL)
def geojson_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collections of up to 1,000 features, with members before and after them."""
    path = shared_dir(spark, "geojson")
    features = customer_features(spark, sf_dir).groupBy(F.floor(F.col("c_custkey") / 1000)).agg(F.concat_ws(",", F.collect_list("value")).alias("all"))
    head, tail = '{"type":"FeatureCollection","crs":{"type":"name","properties":{"name":"x}"}},"features":[', '],"after":[{"type":"none"}]}'
    features.select(F.concat(F.lit(head), "all", F.lit(tail)).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return read_geojson(spark, path)


@query("geojson_lines_scan", POINTS_SQL)
def geojson_lines_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "geojson")
    customer_features(spark, sf_dir).select("value").write.text(path)
    return read_geojson_lines(spark, path)


MARKS_SQL = "select c_name as name, c_mktsegment as description, 'Point' as geometry_type, c_nationkey * 0.5::double as lon, c_nationkey - 12.25::double as lat from customer"


@query("kml_scan", MARKS_SQL)
def kml_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "kml")
    place = F.concat_ws(",", F.col("c_nationkey") * F.lit(0.5), F.col("c_nationkey") - F.lit(12.25), F.lit(0))
    marks = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("description"), F.struct(place.alias("coordinates")).alias("Point")
    )
    marks.write.format("xml").options(rowTag="Placemark", rootTag="Document").save(path)
    return read_kml(spark, path).drop("geometry")


SHAPES_SQL = """
with c as (select c_custkey, c_name, c_nationkey * 0.5::double as x, c_nationkey - 12.25::double as y from customer),
s as (select *, '[' || x || ',' || y || ',0.0]' as a, '[' || (x + 1) || ',' || y || ']' as b, '[' || (x + 1) || ',' || (y + 1) || ']' as d from c),
r as (select *, '[[' || a || ',' || b || ',' || d || ',' || a || '],[' || b || ',' || d || ',' || b || ']]' as rings from s),
g as (select c_name, '{"type":"Point","coordinates":' || a || '}' as point, '{"type":"LineString","coordinates":[' || a || ',' || b || ']}' as line,
             '{"type":"Polygon","coordinates":' || rings || '}' as area, rings, a, b, c_custkey % 7 as kind, x, y from r)
select c_name as name, case when kind < 6 then geometry end as geometry,
       case kind when 0 then 'Point' when 1 then 'LineString' when 2 then 'Polygon' when 3 then 'MultiPoint' when 4 then 'MultiPolygon' when 5 then 'GeometryCollection' end as geometry_type,
       case when kind = 0 then x end as lon, case when kind = 0 then y end as lat
from (select *, case kind when 0 then point when 1 then line when 2 then area
                          when 3 then '{"type":"MultiPoint","coordinates":[' || a || ',' || b || ']}'
                          when 4 then '{"type":"MultiPolygon","coordinates":[' || rings || ',' || rings || ']}'
                          else '{"type":"GeometryCollection","geometries":[' || line || ',{"type":"GeometryCollection","geometries":[' || point || ',' || area || ']},' || point || ']}' end as geometry from g)
"""


def shape_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A placemark per customer: a point, a line, an area, collections of them, nested ones, or nothing."""
    tag = lambda name, *inner: F.concat(F.lit(f"<{name}>"), *inner, F.lit(f"</{name}>"))
    x, y = F.col("c_nationkey") * F.lit(0.5), F.col("c_nationkey") - F.lit(12.25)
    a, b, d = F.concat_ws(",", x, y, F.lit(0)), F.concat_ws(",", x + 1, y), F.concat_ws(",", x + 1, y + 1)
    places = lambda *p: tag("coordinates", F.concat_ws("\n ", *p))
    point, line = tag("Point", places(a)), tag("LineString", places(a, b))
    ring, hole = tag("LinearRing", places(a, b, d, a)), tag("LinearRing", places(b, d, b))
    area = tag("Polygon", tag("outerBoundaryIs", ring), tag("innerBoundaryIs", hole))
    many = lambda *g: tag("MultiGeometry", *g)
    shapes = [point, line, area, many(point, tag("Point", places(b))), many(area, area), many(line, many(point, area), point), F.lit("")]
    shape = F.element_at(F.array(*shapes), (F.col("c_custkey") % 7 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", tag("Placemark", tag("name", F.col("c_name")), shape).alias("value"))


@query("kml_shapes_scan", SHAPES_SQL)
def kml_shapes_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of up to 1,000 placemarks of every kind of geometry, their GeoJSON text compared."""
    path = shared_dir(spark, "kml")
    files = shape_marks(spark, sf_dir).groupBy(F.floor(F.col("c_custkey") / 1000)).agg(F.concat_ws("", F.collect_list("value")).alias("all"))
    files.select(F.concat(F.lit("<kml><Document>"), "all", F.lit("</Document></kml>")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return read_kml(spark, path).drop("description")


def pack_marks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One KMZ per batch of customers: a zip of one KML file."""
    for batch in batches:
        marks = "".join(
            f"<Placemark><name>{escape(r.c_name)}</name><description>{escape(r.c_mktsegment)}</description>"
            f"<Point><coordinates>{r.c_nationkey * 0.5},{r.c_nationkey - 12.25},0</coordinates></Point></Placemark>"
            for r in batch.itertuples(index=False)
        )
        content = zip_of({"doc.kml": f"<kml><Document>{marks}</Document></kml>"})
        yield pd.DataFrame({"path": [f"in/marks_{batch['c_custkey'].iloc[0]}.kmz"], "content": [content]})


@query("kmz_scan", MARKS_SQL)
def kmz_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "customer").mapInPandas(pack_marks, "path string, content binary")
    staged = stage_members(save_members(unpack(files), shared_dir(spark, "members")), TEXT_EXTENSIONS)
    return read_kml(spark, f"{staged}/ext=kml/*").drop("geometry")


@query("parquet_copy", "select * from events")
def parquet_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, write_table(table(spark, sf_dir, "events"), shared_dir(spark, "parquet")))


@query("category_folders", "select event_type as category, count(*) as files from events group by 1")
def category_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_by_category(table(spark, sf_dir, "events").withColumnRenamed("event_type", "category"), shared_dir(spark, "folders"))
    return spark.read.parquet(path).groupBy("category").agg(F.count(F.lit(1)).alias("files"))


ARCHIVE_KINDS = {"en": "zip", "fr": "tar", "de": "tgz", "es": "xz"}


def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One archive per document, its kind by language, to have something to unpack."""
    for batch in batches:
        packed = []
        for doc_id, lang, text in zip(batch["doc_id"], batch["lang"], batch["text"]):
            kind, data, out = ARCHIVE_KINDS.get(lang, "zip"), text.encode(), io.BytesIO()
            name = f"docs/{doc_id}.txt"
            if kind == "zip":
                with zipfile.ZipFile(out, "w") as z:
                    z.writestr(name, data)
            elif kind == "xz":
                out.write(lzma.compress(data, preset=0))
            else:
                with tarfile.open(fileobj=out, mode="w:gz" if kind == "tgz" else "w") as t:
                    info = tarfile.TarInfo(name)
                    info.size = len(data)
                    t.addfile(info, io.BytesIO(data))
            packed.append((f"in/{doc_id}.txt.xz" if kind == "xz" else f"in/{doc_id}.{kind}", out.getvalue()))
        yield pd.DataFrame(packed, columns=["path", "content"])


def packed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "text").mapInPandas(pack, "path string, content binary")


@query(
    "archive_members",
    """
select case lang when 'fr' then 'in/' || doc_id || '.tar' when 'de' then 'in/' || doc_id || '.tgz'
                 when 'es' then 'in/' || doc_id || '.txt.xz' else 'in/' || doc_id || '.zip' end as archive,
       case when lang = 'es' then doc_id || '.txt' else 'docs/' || doc_id || '.txt' end as member,
       'txt' as ext, cast(strlen(text) as bigint) as size, text
from documents
""",
)
def archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = unpack(packed_documents(spark, sf_dir))
    return members.select("archive", "member", "ext", "size", F.col("content").cast("string").alias("text"))


def pack_orders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One zip per batch of orders, holding a CSV and a Parquet member."""
    for batch in batches:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("a/orders.csv", batch.to_csv(index=False))
            z.writestr("b/orders.parquet", batch.to_parquet(index=False))
        yield pd.DataFrame({"path": [f"in/orders_{batch['o_orderkey'].iloc[0]}.zip"], "content": [out.getvalue()]})


@query("archive_tables", f"select *, 2 as copies from ({ORDERS_SQL})")
def archive_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    zips = orders_as_text(spark, sf_dir).mapInPandas(pack_orders, "path string, content binary")
    staged = stage_members(save_members(unpack(zips), shared_dir(spark, "members")), TEXT_EXTENSIONS, ["parquet"])
    kept = "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    from_csv = TABLE_READERS["csv"](spark, f"{staged}/ext=csv/*").select(*kept)
    from_parquet = TABLE_READERS["parquet"](spark, f"{staged}/ext=parquet").select(*kept)
    both = from_csv.unionByName(from_parquet)
    return both.groupBy(*kept).agg(F.count(F.lit(1)).cast("int").alias("copies"))


def pack_workbooks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One workbook per batch of customers: numbers as numbers, names inline, segments shared."""
    for batch in batches:
        segments = sorted(set(batch["c_mktsegment"]))
        body = ['<row r="1"><c r="A1" t="str"><v>key</v></c><c r="B1" t="str"><v>name</v></c><c r="D1" t="str"><v>balance</v></c><c r="E1" t="str"><v>segment</v></c></row>']
        for n, row in enumerate(batch.itertuples(index=False), 2):
            body.append(
                f'<row r="{n}"><c r="A{n}"><v>{row.c_custkey}</v></c><c r="B{n}" t="inlineStr"><is><t>{row.c_name}</t></is></c>'
                f'<c r="D{n}"><v>{row.c_acctbal!r}</v></c><c r="E{n}" t="s"><v>{segments.index(row.c_mktsegment)}</v></c></row>'
            )
        parts = {
            "xl/workbook.xml": '<workbook xmlns:r="r"><sheets><sheet name="customers" r:id="a"/></sheets></workbook>',
            "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="a" Target="worksheets/sheet1.xml"/></Relationships>',
            "xl/sharedStrings.xml": "<sst>" + "".join(f"<si><t>{s}</t></si>" for s in segments) + "</sst>",
            "xl/worksheets/sheet1.xml": "<worksheet><sheetData>" + "".join(body) + "</sheetData></worksheet>",
        }
        yield pd.DataFrame({"path": [f"in/customers_{batch['c_custkey'].iloc[0]}.xlsx"], "content": [zip_of(parts)]})


def zip_of(parts: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


@query("workbook_scan", "select c_custkey as key, c_name as name, c_acctbal as balance, c_mktsegment as segment from customer")
def workbook_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    books = table(spark, sf_dir, "customer").mapInPandas(pack_workbooks, "path string, content binary")
    rows = save_rows(xlsx_sheets(xml_parts(unpack(books)))).filter(F.col("n") > 1)
    places = {"key": 1, "name": 2, "balance": 4, "segment": 5}
    return type_columns(rows.select([F.try_element_at("cells", F.lit(i)).alias(name) for name, i in places.items()]))


def pack_documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One word-processor file per document, a paragraph per line, the first one a heading."""
    styles = (
        '<w:styles xmlns:w="w"><w:style w:type="paragraph" w:default="1" w:styleId="N"><w:name w:val="Normal"/></w:style>'
        '<w:style w:type="paragraph" w:styleId="T"><w:name w:val="Title"/></w:style></w:styles>'
    )
    for batch in batches:
        packed = []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            body = []
            for n, line in enumerate(text.split("\n")):
                mark = '<w:pPr><w:pStyle w:val="T"/></w:pPr>' if n == 0 else ""
                body.append(f'<w:p>{mark}<w:r><w:t xml:space="preserve">{escape(line)}</w:t></w:r></w:p>')
            document = f'<w:document xmlns:w="w"><w:body>{"".join(body)}</w:body></w:document>'
            packed.append((f"in/{doc_id}.docx", zip_of({"word/document.xml": document, "word/styles.xml": styles})))
        yield pd.DataFrame(packed, columns=["path", "content"])


@query("word_document_scan", STYLED_SQL)
def word_document_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").select("doc_id", "text").mapInPandas(pack_documents, "path string, content binary")
    found = styled_paragraphs(docx_paragraphs(xml_parts(unpack(files))), keep=["archive"])
    doc_id = F.regexp_extract("archive", "in/([0-9]+)", 1).cast("bigint").alias("doc_id")
    return found.select(doc_id, "paragraph_number", "text", "style", "char_count", "word_count")


def pack_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One open-document text per document: a paragraph per line, nested in sections and lists, parts of it in spans."""
    names = "".join(f' xmlns:{n}="urn:oasis:names:tc:opendocument:xmlns:{n}:1.0"' for n in ("office", "text"))
    for batch in batches:
        packed = []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            body = []
            for n, line in enumerate(text.split("\n")):
                half = len(line) // 2
                marked = f"{escape(line[:half])}<text:span><text:a>{escape(line[half:])}</text:a></text:span>"
                paragraph = f"<text:p>{marked.replace('  ', '<text:s text:c="2"/>')}</text:p>"
                body.append(f"<text:list><text:list-item>{paragraph}</text:list-item></text:list>" if n % 3 else f"<text:section>{paragraph}</text:section>")
            content = f"<office:document-content{names}><office:body><office:text><text:h>none</text:h>{''.join(body)}</office:text></office:body></office:document-content>"
            packed.append((f"in/{doc_id}.odt", zip_of({"content.xml": content})))
        yield pd.DataFrame(packed, columns=["path", "content"])


@query("odt_scan", PARAGRAPHS_SQL)
def odt_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").select("doc_id", "text").mapInPandas(pack_texts, "path string, content binary")
    found = text_paragraphs(odt_paragraphs(xml_parts(unpack(files))), keep=["archive"])
    doc_id = F.regexp_extract("archive", "in/([0-9]+)", 1).cast("bigint").alias("doc_id")
    return found.select(doc_id, "paragraph_number", "text", "char_count", "word_count")


def pack_sheets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One open-document workbook per batch of customers, a column left blank."""
    names = "".join(f' xmlns:{n}="urn:{n}"' for n in ("office", "table", "text"))
    said = lambda text: f'<table:table-cell office:value-type="string"><text:p>{escape(text)}</text:p></table:table-cell>'
    counted = lambda value: f'<table:table-cell office:value-type="float" office:value="{value!r}"/>'
    blank = '<table:table-cell table:number-columns-repeated="2"/>'
    for batch in batches:
        rows = [said("key") + said("name") + blank + said("balance") + said("segment")]
        for r in batch.itertuples(index=False):
            rows.append(counted(r.c_custkey) + said(r.c_name) + blank + counted(r.c_acctbal) + said(r.c_mktsegment))
        body = "".join(f"<table:table-row>{row}</table:table-row>" for row in rows)
        content = f'<office:document-content{names}><office:body><office:spreadsheet><table:table table:name="customers">{body}</table:table></office:spreadsheet></office:body></office:document-content>'
        yield pd.DataFrame({"path": [f"in/customers_{batch['c_custkey'].iloc[0]}.ods"], "content": [zip_of({"content.xml": content})]})


@query("ods_scan", "select c_custkey as key, c_name as name, c_acctbal as balance, c_mktsegment as segment from customer")
def ods_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    books = table(spark, sf_dir, "customer").mapInPandas(pack_sheets, "path string, content binary")
    rows = save_rows(ods_sheets(xml_parts(unpack(books)))).filter(F.col("n") > 1)
    places = {"key": 1, "name": 2, "balance": 5, "segment": 6}
    return type_columns(rows.select([F.try_element_at("cells", F.lit(i)).alias(name) for name, i in places.items()]))


def pack_dbase(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One dBase file per batch of parts."""
    fields = [("KEY", "N", 12), ("NAME", "C", 60), ("SIZE", "N", 6), ("PRICE", "N", 20)]
    width = 1 + sum(length for _, _, length in fields)
    described = b"".join(struct.pack("<11sc4xBB14x", n.encode(), k.encode(), length, 0) for n, k, length in fields)
    for batch in batches:
        records = b"".join(
            f" {r.p_partkey:>12}{r.p_name:<60}{r.p_size:>6}{r.p_retailprice!r:>20}".encode() for r in batch.itertuples(index=False)
        )
        header = struct.pack("<BBBBIHH20x", 3, 124, 1, 1, len(batch), 33 + len(described), width)
        content = header + described + b"\r" + records + b"\x1a"
        yield pd.DataFrame({"path": [f"in/parts_{batch['p_partkey'].iloc[0]}.dbf"], "content": [content]})


@query("dbase_scan", 'select p_partkey as "KEY", p_name as "NAME", cast(p_size as bigint) as "SIZE", p_retailprice as "PRICE" from part')
def dbase_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "dbase")
    files = table(spark, sf_dir, "part").mapInPandas(pack_dbase, "path string, content binary")
    # A file ends with the sign for its end.
    write_files(files.select(F.expr("cast(substring(content, 1, length(content) - 1) as string)").alias("value")), path, "dbf", "\x1a")
    return read_dbf(spark, path)


@query("incremental_ingest", "select event_id, ts, user_id, event_type, value from events")
def incremental_ingest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "stream")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    run = lambda: incremental_ingest(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", events.schema)
    events.filter(F.col("event_type") != "view").write.parquet(f"{root}/in")
    run()
    events.filter(F.col("event_type") == "view").write.mode("append").parquet(f"{root}/in")
    run()
    run()  # nothing new: nothing must be taken in twice
    return spark.read.parquet(f"{root}/out")


@query("incremental_files", "select event_type || '/' as folder, 1 as seen from (select distinct event_type from events)")
def incremental_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "discover")
    events = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("category"))
    write_by_category(events, f"{root}/in")
    found = f"{root}/found"
    record = lambda batch: append_to_ledger(batch.select("path"), found)
    for _ in range(2):
        on_new_files(spark, f"{root}/in", f"{root}/checkpoint", record, glob="*.parquet")
    files = spark.read.parquet(found).select(F.regexp_extract("path", "category=([^/]*)/", 1).alias("category"), "path")
    per_file = files.groupBy("category", "path").agg(F.count(F.lit(1)).cast("int").alias("seen"))
    return per_file.groupBy(F.concat("category", F.lit("/")).alias("folder")).agg(F.max("seen").alias("seen"))


@query("list_objects", "select event_type as category, true as has_files from events group by 1")
def list_objects_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_by_category(
        table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("category")), shared_dir(spark, "list")
    )
    listing = list_objects(spark, path, "*.parquet")
    folder = F.regexp_extract("key", "^category=([^/]*)/", 1)
    return listing.groupBy(folder.alias("category")).agg((F.sum("size_bytes") > 0).alias("has_files"))


@query(
    "list_every_object",
    """
select case c_nationkey % 4 when 0 then 'd/_' || c_nationkey || '.txt' when 1 then 'd/.h/.' || c_nationkey || '.txt'
                            when 2 then 'd/a[' || c_nationkey || '].txt' else 'd/_h/é *' || c_nationkey || '.txt' end as key,
       cast(sum(strlen(c_name) + 1) as bigint) as size_bytes
from customer group by c_nationkey
""",
)
def list_every_object_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per nation, of hidden names, in hidden folders, and with signs of a pattern."""
    root, staged = shared_dir(spark, "names"), shared_dir(spark, "files")
    table(spark, sf_dir, "customer").select("c_nationkey", "c_name").repartition("c_nationkey").write.partitionBy("c_nationkey").text(staged)
    for row in list_keys(spark, staged, "*.txt").collect():
        n = int(row["key"].split("/")[0].removeprefix("c_nationkey="))
        name = [f"_{n}.txt", f".h/.{n}.txt", f"a[{n}].txt", f"_h/é *{n}.txt"][n % 4]
        move_folder(spark, f"{staged}/{row['key']}", f"{root}/d/{name}")
    return list_every_object(spark, root).select("key", "size_bytes")


@query("log_tail", "select line from (select event_id || ' ' || event_type as line, event_id from events order by event_id desc limit 200)")
def log_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "log")
    lines = table(spark, sf_dir, "events").select(F.concat_ws(" ", "event_id", "event_type").alias("value"), "event_id")
    # A rolled log: each part goes on where the one before it ends.
    lines.orderBy("event_id").select("value").write.text(path)
    return tail_lines(spark, path, 200).select("line")
