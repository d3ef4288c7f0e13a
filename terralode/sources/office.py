"""Workbooks and word-processor files: zipped XML, read with the XML functions of Spark.

A file is opened like any other archive; from there on rows and paragraphs are
column expressions. Sheets become tables as delimited text does: the first row
names the columns and the values settle the types.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from terralode.functions.cleaning import NA_TOKENS, na_to_null, named
from terralode.functions.markup import paragraph_texts
from terralode.operators.flatten import styled_paragraphs, text_paragraphs
from terralode.operators.infer import type_columns
from terralode.session import shared_dir
from terralode.sources.archive import read_archives, save_members
from terralode.sources.tabular import unique_names

# A part that does not parse fails the file rather than reading as empty.
XML = {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false", "mode": "FAILFAST"}

# Built-in number formats that show a date or a time.
DATE_FORMATS = [*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)]
# Custom formats: what is quoted, bracketed or escaped says nothing; these letters then mean a date.
FORMAT_NOISE = r'"[^"]*"|\[[^\]]*\]|\\.|_.|\*.'
DATE_LETTERS = r"(?i)[dmyhs]"

# Style names a word processor shows differently from how it stores them.
SHOWN_STYLES = {
    "caption": "Caption",
    "footer": "Footer",
    "header": "Header",
    **{f"heading {n}": f"Heading {n}" for n in range(1, 10)},
}

# Marks the text of a date cell until its column's type is settled.
DATE_MARK = "\ue000"


def xml_parts(members: DataFrame) -> DataFrame:
    """XML parts of opened files as ``(archive, member, xml)``, kept as a table so that each is opened once."""
    saved = save_members(members, shared_dir(members.sparkSession, "parts"))
    broken = saved.filter(F.col("error").isNotNull()).select("archive", "error").first()
    if broken:
        raise ValueError(f"{broken['archive']}: {broken['error']}")
    xml = saved.filter(F.col("ext").isin("xml", "rels"))
    return xml.select("archive", "member", F.col("content").cast("string").alias("xml"))


def open_parts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return xml_parts(read_archives(spark, path))


def document_tables(parts: DataFrame, ext: str) -> dict[tuple[str, str], DataFrame]:
    """Tables of opened files of one kind by file and table name; a text document is one unnamed table."""
    if ext == "xlsx":
        return sheet_tables(xlsx_sheets(parts))
    if ext == "ods":
        return sheet_tables(ods_sheets(parts))
    if ext == "odt":
        documents, to_rows = odt_paragraphs(parts), text_paragraphs
    else:
        documents, to_rows = docx_paragraphs(parts), styled_paragraphs
    names = [row["archive"] for row in documents.select("archive").collect()]
    return {(name, ""): to_rows(documents.filter(F.col("archive") == name)) for name in names}


def dealt(parts: DataFrame) -> DataFrame:
    """Parts over all tasks of a shuffle: XML is small on disk for the time it takes to parse."""
    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return parts.repartition(n, "archive", "member")


def part(parts: DataFrame, member: str, schema: str, *columns: Column) -> DataFrame:
    """One part of each file, parsed."""
    parsed = parts.filter(F.col("member") == member).withColumn("x", F.from_xml("xml", schema, XML))
    return parsed.select("archive", *columns)


# --- worksheets -----------------------------------------------------------------------------

RICH_TEXT = "t string, r array<struct<t string>>"
SHEET_SCHEMA = (
    "sheetData struct<row array<struct<_r int, c array<struct<"
    f"_r string, _s int, _t string, v string, is struct<{RICH_TEXT}>>>>>>"
)


def rich_text(item: Column) -> Column:
    """Text of a string item, its formatted runs joined."""
    runs = F.transform(item.getField("r"), lambda r: F.coalesce(r.getField("t"), F.lit("")))
    return F.coalesce(item.getField("t"), F.array_join(runs, ""))


def column_number(reference: Column) -> Column:
    """Number of the column a cell reference such as ``AB12`` names; three letters at most."""
    at = lambda i: F.ascii(F.substring(reference, i, 1)) - 64
    one, two, three = at(1), at(2), at(3)
    return F.when(two < 1, one).when(three < 1, one * 26 + two).otherwise((one * 26 + two) * 26 + three)


def whole_number_text(text: Column) -> Column:
    """Number text as a delimited file would spell it: no fraction where there is none."""
    number = text.try_cast("double")
    whole = (number == F.floor(number)) & (F.abs(number) < 2.0**53)
    plain = text.rlike("^-?[0-9]{1,15}$")
    return F.when(plain, text).when(whole, number.cast("bigint").cast("string")).otherwise(text)


def date_text(serial: Column, date1904: Column) -> Column:
    """Marked timestamp text of a day number."""
    epoch = F.when(date1904, F.lit("1904-01-01").cast("timestamp_ntz")).otherwise(F.lit("1899-12-30").cast("timestamp_ntz"))
    seconds = F.round(serial.try_cast("double") * 86400, 6).cast("decimal(18,6)")
    moment = epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return F.concat(F.lit(DATE_MARK), F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def cell_value(cell: Column, strings: Column, date_styles: Column, date1904: Column) -> Column:
    kind, v = cell.getField("_t"), cell.getField("v")
    style = F.coalesce(cell.getField("_s"), F.lit(0))
    is_date = F.coalesce(F.get(date_styles, style), F.lit(False))
    return (
        F.when(kind == "s", F.get(strings, v.cast("int")))
        .when(kind == "inlineStr", rich_text(cell.getField("is")))
        .when(kind == "b", F.when(v == "1", "True").otherwise("False"))
        .when(kind == "e", F.lit(None).cast("string"))
        .when(kind == "str", v)
        .when(is_date, date_text(v, date1904))
        .otherwise(whole_number_text(v))
    )


def xlsx_sheets(parts: DataFrame) -> DataFrame:
    """One row per sheet: ``(archive, sheet, rows)``, a row being ``(n, cells by column number)``."""
    book = part(
        parts,
        "xl/workbook.xml",
        "workbookPr struct<_date1904 string>, sheets struct<sheet array<struct<_name string, _id string>>>",
        F.coalesce(F.col("x.workbookPr._date1904").isin("1", "true"), F.lit(False)).alias("date1904"),
        F.posexplode("x.sheets.sheet").alias("position", "s"),
    ).select("archive", "date1904", "position", F.col("s._name").alias("sheet"), F.col("s._id").alias("id"))
    targets = part(
        parts,
        "xl/_rels/workbook.xml.rels",
        "Relationship array<struct<_Id string, _Target string>>",
        F.explode("x.Relationship").alias("r"),
    )
    target = F.regexp_replace(F.col("r._Target"), "^/?(xl/)?", "xl/")
    targets = targets.select("archive", F.col("r._Id").alias("id"), target.alias("member"))
    strings = part(
        parts,
        "xl/sharedStrings.xml",
        f"si array<struct<{RICH_TEXT}>>",
        F.transform("x.si", rich_text).alias("strings"),
    )
    custom = F.transform(
        F.filter("x.numFmts.numFmt", lambda f: F.regexp_replace(f.getField("_formatCode"), FORMAT_NOISE, "").rlike(DATE_LETTERS)),
        lambda f: f.getField("_numFmtId"),
    )
    dates = F.concat(F.array(*[F.lit(n) for n in DATE_FORMATS]), F.coalesce(custom, F.array().cast("array<int>")))
    styles = part(
        parts,
        "xl/styles.xml",
        "numFmts struct<numFmt array<struct<_numFmtId int, _formatCode string>>>, cellXfs struct<xf array<struct<_numFmtId int>>>",
        dates.alias("dates"),
        F.col("x.cellXfs.xf").alias("xf"),
    ).select("archive", F.transform("xf", lambda f: F.array_contains(F.col("dates"), f.getField("_numFmtId"))).alias("date_styles"))
    sheets = book.join(targets, ["archive", "id"]).join(strings, "archive", "left").join(styles, "archive", "left")
    bodies = dealt(parts.filter(F.col("member").startswith("xl/worksheets/"))).select(
        "archive", "member", F.from_xml("xml", SHEET_SCHEMA, XML)["sheetData"]["row"].alias("raw")
    )
    cells = lambda row: F.map_from_entries(
        F.filter(
            F.transform(
                row.getField("c"),
                lambda c, i: F.struct(
                    F.when(c.getField("_r").isNull(), i + 1).otherwise(column_number(c.getField("_r"))).alias("k"),
                    cell_value(c, F.col("strings"), F.col("date_styles"), F.col("date1904")).alias("v"),
                ),
            ),
            lambda e: e.getField("v").isNotNull(),
        )
    )
    rows = F.transform(
        "raw", lambda row, i: F.struct(F.coalesce(row.getField("_r"), i + 1).alias("n"), F.coalesce(cells(row), empty_cells()).alias("cells"))
    )
    return sheets.join(bodies, ["archive", "member"]).select("archive", "position", "sheet", rows.alias("rows"))


def empty_cells() -> Column:
    return F.expr("cast(map() as map<int, string>)")


# --- open document sheets -------------------------------------------------------------------

ODS_CELL = (
    "`_value-type` string, _value string, `_date-value` string, `_boolean-value` string, "
    "`_number-columns-repeated` int, p array<string>"
)
ODS_SCHEMA = (
    "body struct<spreadsheet struct<table array<struct<_name string, "
    f"`table-row` array<struct<`_number-rows-repeated` int, `table-cell` array<struct<{ODS_CELL}>>>>>>>>"
)
# Cells hidden by a merged one, groupings of rows, and inline marks of a text.
ODS_REWRITES = [
    (r"(</?)table:covered-table-cell", "$1table:table-cell"),
    (r"</?table:table-(header-rows|rows|row-group)(\s[^>]*)?>", ""),
    (r"<text:s(\s[^>]*)?/>", " "),
    (r"<text:tab(\s[^>]*)?/>", "\t"),
    (r"<text:line-break(\s[^>]*)?/>", "\n"),
    (r"</?text:(span|a)(\s[^>]*)?>", ""),
]


def rewritten(xml: Column, rewrites: list[tuple[str, str]]) -> Column:
    for pattern, replacement in rewrites:
        xml = F.regexp_replace(xml, pattern, replacement)
    return xml


def without_tail(items: Column, is_filled) -> Column:
    """An array up to its last filled item."""
    last = F.array_max(F.transform(items, lambda x, i: F.when(is_filled(x), i + 1).otherwise(0)))
    return F.slice(items, 1, F.coalesce(last, F.lit(0)))


def repeated(items: Column, times: str, value) -> Column:
    """Each item's value as often as the item says."""
    return F.flatten(
        F.transform(items, lambda x: F.array_repeat(value(x), F.coalesce(x.getField(times), F.lit(1))))
    )


def ods_value(cell: Column) -> Column:
    kind = cell.getField("_value-type")
    date = F.regexp_replace(cell.getField("_date-value"), "T", " ").try_cast("timestamp_ntz")
    return (
        F.when(kind.isin("float", "percentage", "currency"), whole_number_text(cell.getField("_value")))
        .when(kind == "date", F.concat(F.lit(DATE_MARK), F.date_format(date, "yyyy-MM-dd HH:mm:ss.SSSSSS")))
        .when(kind == "boolean", F.initcap(cell.getField("_boolean-value")))
        .when(kind.isNotNull(), F.array_join(cell.getField("p"), "\n"))
    )


def ods_sheets(parts: DataFrame) -> DataFrame:
    """One row per sheet, as for a workbook. Repeated blanks at the end of a row or sheet are not spelt out."""
    xml = rewritten(F.col("xml"), ODS_REWRITES)
    content = dealt(parts.filter(F.col("member") == "content.xml")).withColumn("x", F.from_xml(xml, ODS_SCHEMA, XML))
    tables = content.select("archive", F.posexplode("x.body.spreadsheet.table").alias("position", "t"))
    cells = lambda row: F.transform(
        row.getField("table-cell"),
        lambda c: F.struct(ods_value(c).alias("v"), c.getField("_number-columns-repeated").alias("times")),
    )
    values = lambda row: repeated(
        without_tail(row.getField("cells"), lambda c: c.getField("v").isNotNull()), "times", lambda c: c.getField("v")
    )
    read = F.transform(
        F.col("t.table-row"), lambda r: F.struct(cells(r).alias("cells"), r.getField("_number-rows-repeated").alias("times"))
    )
    rows = F.transform(
        "read", lambda r: F.struct(F.coalesce(values(r), F.array().cast("array<string>")).alias("v"), r.getField("times").alias("times"))
    )
    filled = without_tail(F.col("rows"), lambda r: F.size(r.getField("v")) > 0)
    numbered = F.transform(
        repeated(F.col("filled"), "times", lambda r: r.getField("v")),
        lambda v, i: F.struct((i + 1).alias("n"), F.map_from_arrays(F.transform(v, lambda _, j: j + 1), v).alias("cells")),
    )
    # A column each: an expression that is used twice is worked out twice.
    steps = tables.select("archive", "position", F.col("t._name").alias("sheet"), read.alias("read")).withColumn("rows", rows)
    return steps.withColumn("filled", filled).select("archive", "position", "sheet", numbered.alias("rows"))


# --- sheets to tables -----------------------------------------------------------------------


def sheet_rows(sheets: DataFrame) -> DataFrame:
    """Rows of many sheets in one frame: file, sheet, row number, and cells by column number."""
    return sheets.select("archive", "position", "sheet", F.explode("rows").alias("r")).select(
        "archive", "position", "sheet", "r.n", "r.cells"
    )


def save_rows(sheets: DataFrame, *by: str) -> DataFrame:
    """Rows of many sheets kept as a table, so that each sheet is parsed once however often they are read."""
    path = shared_dir(sheets.sparkSession, "rows")
    parsed = sheet_rows(sheets)
    parsed.write.partitionBy(*by).parquet(path)
    return sheets.sparkSession.read.schema(parsed.schema).parquet(path)


def sheet_shapes(rows: DataFrame) -> DataFrame:
    """Header, width, last filled row and number of rows up to it, per sheet."""
    filled = F.size("cells") > 0
    by_sheet = rows.groupBy("archive", "position", "sheet").agg(
        F.max(F.when(filled, F.array_max(F.map_keys("cells")))).alias("width"),
        F.max(F.when(filled, F.col("n"))).alias("last"),
    )
    headers = rows.filter("n = 1").select("archive", "position", F.col("cells").alias("header"))
    return by_sheet.join(headers, ["archive", "position"], "left")


def sheet_tables(sheets: DataFrame, na_tokens: list[str] = NA_TOKENS) -> dict[tuple[str, str], DataFrame]:
    """A table per file and sheet. The sheets are parsed once; only the headers reach the driver."""
    rows = save_rows(sheets, "archive", "position")
    shapes = {(r["archive"], r["position"]): r for r in sheet_shapes(rows).collect()}
    tables = {}
    for sheet in sheets.select("archive", "position", "sheet").orderBy("archive", "position").collect():
        # A sheet without any row has no shape.
        shape = shapes.get((sheet["archive"], sheet["position"]))
        head = (shape and shape["header"]) or {}
        width, last = (shape["width"] or 0, shape["last"] or 0) if shape else (0, 0)
        labels = [(head.get(i) or "").removeprefix(DATE_MARK) for i in range(1, width + 1)]
        own = rows.filter((F.col("archive") == sheet["archive"]) & (F.col("position") == sheet["position"]))
        tables[sheet["archive"], sheet["sheet"]] = sheet_table(own, unique_names(labels), last, na_tokens)
    return tables


def sheet_table(rows: DataFrame, names: list[str], last: int, na_tokens: list[str]) -> DataFrame:
    """The rows below the header, those left out of the file counting as blank."""
    body = rows.filter((F.col("n") > 1) & (F.col("n") <= last))
    texts = body.select([F.try_element_at("cells", F.lit(i + 1)).alias(n) for i, n in enumerate(names)])
    blank = max(last - 1, 0) - body.count()
    if blank > 0:
        nulls = [F.lit(None).cast("string").alias(n) for n in names]
        texts = texts.unionByName(rows.sparkSession.range(blank).select(nulls))
    return type_columns(settle_dates(texts, na_tokens), na_tokens)


def settle_dates(texts: DataFrame, na_tokens: list[str]) -> DataFrame:
    """Columns that hold dates alone become timestamps; elsewhere a date is its text."""
    if not texts.columns:
        return texts
    value = {n: na_to_null(named(n), na_tokens) for n in texts.columns}
    counts = texts.agg(
        F.array(
            *[F.struct(F.count(v).alias("n"), F.count_if(v.startswith(DATE_MARK)).alias("dates")) for v in value.values()]
        ).alias("c")
    ).first()["c"]
    settled = []
    for (name, v), count in zip(value.items(), counts):
        bare = F.regexp_replace(v, "^" + DATE_MARK, "")
        all_dates = count["n"] > 0 and count["n"] == count["dates"]
        settled.append((bare.try_cast("timestamp_ntz") if all_dates else bare).alias(name))
    return texts.select(settled)


def read_xlsx(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The sheets of a workbook by name."""
    return {sheet: df for (_, sheet), df in document_tables(open_parts(spark, path), "xlsx").items()}


def read_ods(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The sheets of an open-document workbook by name."""
    return {sheet: df for (_, sheet), df in document_tables(open_parts(spark, path), "ods").items()}


# --- word-processor documents ---------------------------------------------------------------

DOCX_SCHEMA = "body struct<p array<struct<pPr struct<pStyle struct<_val string>>, r array<struct<t array<string>>>>>>"
# Tabs and breaks become texts and links give up their runs, so that the pieces of a paragraph keep their order.
DOCX_REWRITES = [
    (r"<w:tab\s*/>", "<w:t>\t</w:t>"),
    (r"<w:(br|cr)(\s[^>]*)?/>", "<w:t>\n</w:t>"),
    (r"<w:noBreakHyphen\s*/>", "<w:t>-</w:t>"),
    (r"</?w:hyperlink(\s[^>]*)?>", ""),
]


def docx_paragraphs(parts: DataFrame) -> DataFrame:
    """Documents as arrays of ``(text, style)``, the paragraphs of the body in order."""
    xml = rewritten(F.col("xml"), DOCX_REWRITES)
    bodies = parts.filter(F.col("member") == "word/document.xml").select(
        "archive", F.from_xml(xml, DOCX_SCHEMA, XML)["body"]["p"].alias("p")
    )
    styles = part(
        parts,
        "word/styles.xml",
        "style array<struct<_styleId string, _type string, _default string, name struct<_val string>>>",
        F.col("x.style").alias("styles"),
    )
    shown = F.create_map(*[F.lit(x) for pair in SHOWN_STYLES.items() for x in pair])
    name = lambda s: F.coalesce(F.try_element_at(shown, s.getField("name").getField("_val")), s.getField("name").getField("_val"))
    is_default = lambda s: (s.getField("_type") == "paragraph") & s.getField("_default").isin("1", "true")
    by_id = F.map_from_entries(F.transform("styles", lambda s: F.struct(s.getField("_styleId"), name(s))))
    default = F.transform(F.filter("styles", is_default), name)
    styles = styles.select("archive", by_id.alias("by_id"), F.get(default, F.lit(0)).alias("default_style"))
    text = lambda p: F.array_join(
        F.flatten(F.filter(F.transform(p.getField("r"), lambda r: r.getField("t")), lambda t: t.isNotNull())), ""
    )
    style = lambda p: F.coalesce(
        F.try_element_at("by_id", p.getField("pPr").getField("pStyle").getField("_val")), F.col("default_style")
    )
    items = F.transform("p", lambda p: F.struct(F.coalesce(text(p), F.lit("")).alias("text"), style(p).alias("style")))
    return bodies.join(styles, "archive", "left").select("archive", items.alias("paragraphs"))


def read_docx(spark: SparkSession, path: str) -> DataFrame:
    """One row per paragraph that is not blank, with its style."""
    return styled_paragraphs(docx_paragraphs(open_parts(spark, path)))


def odt_paragraphs(parts: DataFrame, own_text_only: bool = False) -> DataFrame:
    """Open-document texts as arrays of paragraphs, whatever sections, lists, tables or notes hold them.

    Headings are no paragraphs. ``own_text_only`` leaves out what stands in spans and links.
    """
    content = parts.filter(F.col("member") == "content.xml")
    return content.select("archive", paragraph_texts(F.col("xml"), own_text_only).alias("paragraphs"))


def read_odt(spark: SparkSession, path: str, own_text_only: bool = False) -> DataFrame:
    """One row per paragraph that is not blank; the number counts the blank ones too."""
    return text_paragraphs(odt_paragraphs(open_parts(spark, path), own_text_only))
