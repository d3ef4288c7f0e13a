"""Workbooks and word-processor files, written here part by part."""

import datetime as dt
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from terralode.sources.office import ods_sheets, read_docx, read_ods, read_odt, read_xlsx, save_rows
from terralode.sources.registry import read_tables

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'


def zipped(path, parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, HEAD + text)
    path.write_bytes(out.getvalue())
    return str(path)


def workbook(path, sheets, strings="", styles="", date1904=""):
    names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
    rels = "".join(f'<Relationship Id="rId{i}" Type="t" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
    parts = {
        "[Content_Types].xml": "<Types/>",
        "xl/workbook.xml": f"<workbook {MAIN} {REL}>{date1904}<sheets>{names}</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>',
    }
    if strings:
        parts["xl/sharedStrings.xml"] = f"<sst {MAIN}>{strings}</sst>"
    if styles:
        parts["xl/styles.xml"] = f"<styleSheet {MAIN}>{styles}</styleSheet>"
    for i, rows in enumerate(sheets.values(), 1):
        parts[f"xl/worksheets/sheet{i}.xml"] = f"<worksheet {MAIN}><sheetData>{rows}</sheetData></worksheet>"
    return zipped(path, parts)


def test_two_sheets(spark, tmp_path, rows):
    shared = '<si><t>col1</t></si><si><t>col2</t></si><si><t>a</t></si><si><r><t>b</t></r><r><t xml:space="preserve"> c</t></r></si>'
    first = (
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row>'
        '<row r="2"><c r="A2"><v>1</v></c><c r="B2" t="s"><v>2</v></c></row>'
        '<row r="3"><c r="A3"><v>2</v></c><c r="B3" t="s"><v>3</v></c></row>'
    )
    second = (
        '<row r="1"><c r="A1" t="inlineStr"><is><t>col3</t></is></c><c r="B1" t="inlineStr"><is><t>col4</t></is></c></row>'
        '<row r="2"><c r="A2"><v>3.5</v></c><c r="B2" t="str"><v>c</v></c></row>'
        '<row r="3"><c r="A3"><v>4</v></c><c r="B3" t="str"><v>d</v></c></row>'
    )
    tables = read_xlsx(spark, workbook(tmp_path / "w.xlsx", {"Sheet1": first, "Feuille é": second}, shared))
    assert list(tables) == ["Sheet1", "Feuille é"]
    assert dict(tables["Sheet1"].dtypes) == {"col1": "bigint", "col2": "string"}
    assert rows(tables["Sheet1"], "col1", "col2") == [(1, "a"), (2, "b c")]
    assert rows(tables["Feuille é"], "col3", "col4") == [(3.5, "c"), (4.0, "d")]


def test_gaps_types_and_blank_rows(spark, tmp_path):
    body = (
        '<row r="1"><c r="A1" t="str"><v>n</v></c><c r="C1" t="str"><v>flag</v></c><c r="AB1" t="str"><v>far</v></c></row>'
        '<row r="2"><c r="A2"><v>1</v></c><c r="C2" t="b"><v>1</v></c><c r="AB2"><v>1E3</v></c></row>'
        '<row r="4"><c r="A4"><v>2</v></c><c r="C4" t="e"><v>#N/A</v></c></row>'
        '<row r="9"><c r="A9" s="0"/></row>'
    )
    (df,) = read_xlsx(spark, workbook(tmp_path / "w.xlsx", {"S": body})).values()
    assert df.columns[:4] == ["n", "Unnamed: 1", "flag", "Unnamed: 3"] and df.columns[-1] == "far" and len(df.columns) == 28
    assert dict(df.dtypes)["n"] == "double" and dict(df.dtypes)["flag"] == "string"
    got = sorted(((r["n"], r["flag"], r["far"]) for r in df.collect()), key=repr)
    assert got == [(1.0, "True", 1000.0), (2.0, None, None), (None, None, None)]


@pytest.mark.parametrize("date1904, day", [("", dt.datetime(2024, 1, 1)), ('<workbookPr date1904="1"/>', dt.datetime(2028, 1, 2))])
def test_dates(spark, tmp_path, date1904, day):
    styles = (
        '<numFmts count="2"><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/><numFmt numFmtId="165" formatCode="0.00&quot;days&quot;"/></numFmts>'
        '<cellXfs count="4"><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs>'
    )
    body = (
        '<row r="1"><c r="A1" t="str"><v>d</v></c><c r="B1" t="str"><v>e</v></c><c r="C1" t="str"><v>f</v></c><c r="D1" t="str"><v>mixed</v></c></row>'
        '<row r="2"><c r="A2" s="1"><v>45292</v></c><c r="B2" s="2"><v>45292.75</v></c><c r="C2" s="3"><v>45292</v></c><c r="D2" s="1"><v>45292</v></c></row>'
        '<row r="3"><c r="D3" t="str"><v>x</v></c></row>'
    )
    (df,) = read_xlsx(spark, workbook(tmp_path / "w.xlsx", {"S": body}, styles=styles, date1904=date1904)).values()
    assert dict(df.dtypes) == {"d": "timestamp_ntz", "e": "timestamp_ntz", "f": "double", "mixed": "string"}
    row = df.filter("d is not null").first()
    assert (row["d"], row["e"], row["f"]) == (day, day + dt.timedelta(hours=18), 45292.0)
    assert row["mixed"].startswith(f"{day:%Y-%m-%d}")


def test_cell_references(spark):
    from pyspark.sql import functions as F

    from terralode.sources.office import column_number

    refs = ["A1", "Z9", "AA10", "AZ3", "ZZ1", "AAA1", "XFD1048576"]
    df = spark.createDataFrame([(r,) for r in refs], "r string")
    assert [r[0] for r in df.select(column_number(F.col("r"))).collect()] == [1, 26, 27, 52, 702, 703, 16384]


def test_spellings_of_a_workbook(spark, tmp_path, rows):
    shared = '<si><t xml:space="preserve"> a b </t></si><si><t/></si><si><t>x &amp; &lt;y&gt;</t></si>'
    body = (
        '<row r="1" spans="1:3" ht="15"><c r="A1" t="s"><v>0</v></c><c r="B1" t="str"><f>CONCAT("h")</f><v>h2</v></c></row>'
        '<row r="2"><c r="A2" t="s"><v>2</v></c><c r="B2"><f>1+1</f><v>2</v></c><c r="C2" t="s"><v>1</v></c></row>'
    )
    (df,) = read_xlsx(spark, workbook(tmp_path / "a.xlsx", {"S": body}, shared)).values()
    assert [tuple(r)[:2] for r in df.collect()] == [("x & <y>", 2)] and df.columns[0] == " a b "
    prefixed = {
        "xl/workbook.xml": f'<x:workbook xmlns:x="m" {REL}><x:sheets><x:sheet name="P" sheetId="1" r:id="rId1"/></x:sheets></x:workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="p"><Relationship Id="rId1" Target="/xl/worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": '<x:worksheet xmlns:x="m"><x:sheetData><x:row r="1"><x:c r="A1" t="str"><x:v>k</x:v></x:c></x:row>'
        '<x:row r="2"><x:c r="A2"><x:v>5</x:v></x:c></x:row></x:sheetData></x:worksheet>',
    }
    (df,) = read_xlsx(spark, zipped(tmp_path / "p.xlsx", prefixed)).values()
    assert rows(df, "k") == [(5,)]


def test_empty_sheet_and_header_only(spark, tmp_path):
    header = '<row r="1"><c r="A1" t="str"><v>a</v></c><c r="B1" t="str"><v>b</v></c></row>'
    tables = read_xlsx(spark, workbook(tmp_path / "w.xlsx", {"Empty": "", "Head": header}))
    assert tables["Empty"].columns == []
    assert tables["Head"].columns == ["a", "b"] and tables["Head"].count() == 0


ODS_SPACES = (
    'xmlns:office="urn:o" xmlns:table="urn:t" xmlns:text="urn:x"'
)


def test_ods(spark, tmp_path, rows):
    cell = lambda t: f'<table:table-cell office:value-type="string"><text:p>{t}</text:p></table:table-cell>'
    number = lambda v, more="": f'<table:table-cell office:value-type="float" office:value="{v}"{more}><text:p>{v}</text:p></table:table-cell>'
    tail = '<table:table-cell table:number-columns-repeated="16380"/>'
    sheet = (
        f"<table:table-header-rows><table:table-row>{cell('id')}{cell('name')}{cell('x')}{cell('y')}{cell('day')}{tail}</table:table-row></table:table-header-rows>"
        f"<table:table-row>{number(1)}{cell('Al<text:span>ice</text:span><text:s/>B')}{number(7, ' table:number-columns-repeated=&quot;2&quot;'.replace('&quot;', chr(34)))}"
        f'<table:table-cell office:value-type="date" office:date-value="2024-01-31"/>{tail}</table:table-row>'
        f'<table:table-row table:number-rows-repeated="2">{number(2)}<table:covered-table-cell/>{number("8.5")}{tail}</table:table-row>'
        f'<table:table-row table:number-rows-repeated="1048570">{tail}</table:table-row>'
    )
    content = f'<office:document-content {ODS_SPACES}><office:body><office:spreadsheet><table:table table:name="Data">{sheet}</table:table></office:spreadsheet></office:body></office:document-content>'
    tables = read_ods(spark, zipped(tmp_path / "w.ods", {"content.xml": content, "meta.xml": "<m/>"}))
    df = tables["Data"]
    assert dict(df.dtypes) == {"id": "bigint", "name": "string", "x": "double", "y": "double", "day": "timestamp_ntz"}
    assert rows(df, "id", "name", "x", "y", "day") == [
        (1, "Alice B", 7.0, 7.0, dt.datetime(2024, 1, 31)),
        (2, None, 8.5, None, None),
        (2, None, 8.5, None, None),
    ]


W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="urn:r"'


def test_sheets_are_parsed_by_many_tasks_and_once(spark):
    """Workbooks that lie in one file are dealt over the tasks of a shuffle; their rows are kept."""
    row = lambda i: f'<table:table-row><table:table-cell office:value-type="float" office:value="{i}"/></table:table-row>'
    xml = lambda i: f'<d xmlns:office="o" xmlns:table="t"><office:body><office:spreadsheet><table:table table:name="s">{row(i)}</table:table></office:spreadsheet></office:body></d>'
    parts = spark.createDataFrame([(f"{i}.ods", "content.xml", xml(i)) for i in range(40)], "archive string, member string, xml string").coalesce(1)
    sheets = ods_sheets(parts)
    assert sheets.select(F.spark_partition_id()).distinct().count() > 1
    kept = save_rows(sheets)
    assert "from_xml" not in kept._jdf.queryExecution().toString()
    assert sorted((r.archive, r.position, r.sheet, r.n, r.cells) for r in kept.collect()) == sorted((f"{i}.ods", 0, "s", 1, {1: str(i)}) for i in range(40))


def test_docx(spark, tmp_path, rows):
    body = (
        '<w:p><w:pPr><w:pStyle w:val="Titre1"/></w:pPr><w:r><w:t>Title</w:t></w:r></w:p>'
        "<w:p/>"
        '<w:p><w:r><w:t xml:space="preserve">First </w:t></w:r><w:hyperlink r:id="x"><w:r><w:t>linked</w:t></w:r></w:hyperlink>'
        '<w:r><w:tab/><w:t xml:space="preserve"> par</w:t><w:br/><w:t>agraph</w:t></w:r></w:p>'
        "<w:tbl><w:tr><w:tc><w:p><w:r><w:t>in a table</w:t></w:r></w:p></w:tc></w:tr></w:tbl>"
        '<w:p><w:r><w:t xml:space="preserve">   </w:t></w:r></w:p>'
        "<w:p><w:r><w:t>Éloïse</w:t></w:r></w:p>"
    )
    styles = (
        '<w:style w:type="paragraph" w:default="1" w:styleId="Normal"><w:name w:val="Normal"/></w:style>'
        '<w:style w:type="paragraph" w:styleId="Titre1"><w:name w:val="heading 1"/></w:style>'
    )
    path = zipped(
        tmp_path / "d.docx",
        {"word/document.xml": f"<w:document {W}><w:body>{body}</w:body></w:document>", "word/styles.xml": f"<w:styles {W}>{styles}</w:styles>"},
    )
    assert rows(read_docx(spark, path), "paragraph_number", "text", "style", "char_count", "word_count") == [
        (1, "Title", "Heading 1", 5, 1),
        (3, "First linked\t par\nagraph", "Normal", 24, 4),
        (5, "Éloïse", "Normal", 6, 1),
    ]


ODF = "".join(f' xmlns:{n}="urn:oasis:names:tc:opendocument:xmlns:{u}:1.0"' for n, u in (("o", "office"), ("t", "text"), ("d", "drawing"), ("tab", "table")))


def odt(path, body):
    return zipped(path, {"content.xml": f"<o:document-content{ODF}><o:body><o:text>{body}</o:text></o:body></o:document-content>"})


ODT_BODY = (
    "<t:h>Heading</t:h><t:p>first</t:p><t:p/><t:section><t:section><t:p>a<t:span>b<t:s t:c='2'/></t:span><t:a>c</t:a><t:tab/>d<t:line-break/>e</t:p></t:section></t:section>"
    "<t:list><t:list-item><t:p>one &amp; two</t:p><t:list><t:list-item><t:p>deep</t:p></t:list-item></t:list></t:list-item></t:list>"
    "<tab:table><tab:table-row><tab:table-cell><t:p>cell</t:p></tab:table-cell></tab:table-row></tab:table>"
    "<t:p>before<t:note><t:note-citation>1</t:note-citation><t:note-body><t:p>a note</t:p></t:note-body></t:note> after</t:p>"
    "<t:p>x<d:frame><d:text-box><t:p>boxed</t:p></d:text-box>drawn</d:frame>y</t:p>"
)


def test_odt_paragraphs_in_the_order_they_begin(spark, tmp_path, rows):
    got = rows(read_odt(spark, odt(tmp_path / "d.odt", ODT_BODY)), "paragraph_number", "text", "char_count", "word_count")
    texts = ["first", "", "ab  c\td\ne", "one & two", "deep", "cell", "before after", "a note", "xy", "boxed"]
    assert sorted(got) == [(n, t, len(t), len(t.split())) for n, t in enumerate(texts, 1) if t]


def test_odt_own_text_only_and_empty(spark, tmp_path):
    own = read_odt(spark, odt(tmp_path / "d.odt", ODT_BODY), own_text_only=True).orderBy("paragraph_number").collect()
    assert [r["text"] for r in own][:3] == ["first", "ade", "one & two"]
    assert read_odt(spark, odt(tmp_path / "e.odt", "")).count() == 0


def test_odt_is_converted(spark, tmp_path):
    (name, df), = read_tables(spark, odt(tmp_path / "d.odt", ODT_BODY)).items()
    assert name == "d" and df.columns == ["paragraph_number", "text", "char_count", "word_count"] and df.count() == 9
