"""First worksheet of .xlsx workbooks."""

import io

import pytest

from conftest import zip_bytes
from releasemill.plans import ingest
from releasemill.sources import sheet
from releasemill.sources.archives import scan_archives
from releasemill.sources.sheetwriter import PARTS, write_workbook

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"


def workbook(rows, strings=None, styles=None, book=None):
    parts = dict(PARTS)
    if book:
        parts["xl/workbook.xml"] = book
    parts["xl/worksheets/sheet1.xml"] = (
        f'<worksheet xmlns="{MAIN}"><sheetData>{rows}</sheetData></worksheet>'
    )
    if strings:
        items = "".join(strings)
        parts["xl/sharedStrings.xml"] = f'<sst xmlns="{MAIN}">{items}</sst>'
    if styles:
        parts["xl/styles.xml"] = f'<styleSheet xmlns="{MAIN}">{styles}</styleSheet>'
    return zip_bytes(parts.items())


def test_written_workbook_reads_back():
    buffer = io.BytesIO()
    rows = [["1", " <&> ", None], ["2", "器械\nx", "z"]]
    write_workbook(buffer, ["a", "b", "c"], rows)
    assert list(sheet.records(buffer.getvalue())) == [
        {"a": "1", "b": " <&> "}, {"a": "2", "b": "器械\nx", "c": "z"},
    ]


def test_cell_kinds():
    data = workbook(
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="inlineStr"><is><t>n</t></is></c>'
        '<c r="C1" t="str"><v>d</v></c><c r="D1" t="str"><v>e</v></c><c r="E1" t="str"><v>f</v></c></row>'
        '<row r="2"><c r="A2" t="s"><v>1</v></c><c r="B2"><v>5</v></c><c r="C2" s="1"><v>45000</v></c>'
        '<c r="D2" t="b"><v>1</v></c><c r="E2" t="e"><v>#N/A</v></c></row>'
        '<row r="3"><c r="B3"><v>1.5</v></c><c r="C3" s="2"><v>45000.25</v></c><c r="D3" s="3"><v>7.0</v></c></row>',
        strings=["<si><t>s</t></si>", "<si><r><t>ri</t></r><r><t>ch</t></r><rPh><t>no</t></rPh></si>"],
        styles='<numFmts><numFmt numFmtId="200" formatCode="yyyy\\-mm"/>'
        '<numFmt numFmtId="201" formatCode="0.0&quot;dm&quot;"/></numFmts>'
        '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="200"/><xf numFmtId="201"/></cellXfs>',
    )
    assert list(sheet.records(data)) == [
        {"s": "rich", "n": "5", "d": "2023-03-15 00:00:00", "e": "True"},
        {"n": "1.5", "d": "2023-03-15 06:00:00", "e": "7"},
    ]


def test_blank_rows_headers_and_null_texts():
    def cell(ref, text):
        return f'<c r="{ref}" t="inlineStr"><is><t>{text}</t></is></c>'

    data = workbook(
        f'<row r="1">{cell("A1", "a")}{cell("C1", "a")}{cell("D1", "a")}</row>'
        f'<row r="2">{cell("A2", "NA")}{cell("B2", "x")}</row>'
        f'<row r="4">{cell("C4", "y")}{cell("E4", "out")}</row>'
        '<row r="6"><c r="A6"/></row>'
    )
    assert list(sheet.records(data)) == [
        {"Unnamed: 1": "x"}, {}, {"a.1": "y", "Unnamed: 4": "out"},
    ]


def test_first_sheet_in_workbook_order_and_1904_dates():
    book = (
        f'<workbook xmlns="{MAIN}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/'
        'relationships"><workbookPr date1904="1"/><sheets><sheet name="x" sheetId="9" r:id="rId1"/>'
        "</sheets></workbook>"
    )
    data = workbook(
        '<row><c t="str"><v>d</v></c></row><row><c s="0"><v>1</v></c></row>',
        styles='<cellXfs><xf numFmtId="14"/></cellXfs>', book=book,
    )
    assert list(sheet.records(data)) == [{"d": "1904-01-02 00:00:00"}]


@pytest.mark.parametrize("data", [b"not a workbook", zip_bytes([("x", "y")])])
def test_unreadable_workbook_raises(data):
    with pytest.raises(Exception):
        list(sheet.records(data))


def test_blank_first_row_gives_positional_names():
    data = workbook('<row r="3"><c r="A3"><v>1</v></c><c r="C3"><v>2</v></c></row><row r="4"><c r="B4"><v>3</v></c></row>')
    assert list(sheet.records(data)) == [
        {}, {"Unnamed: 0": "1", "Unnamed: 2": "2"}, {"Unnamed: 1": "3"},
    ]


@pytest.mark.parametrize("rows", [5, 5_000, 20_000])
def test_a_broken_workbook_gives_no_record_whatever_its_size(spark, landing, rows):
    body = "".join(f'<row r="{n}"><c r="A{n}"><v>{n}</v></c></row>' for n in range(1, rows + 1))
    broken = workbook(body + f'<row r="{rows + 1}"><c r="A{rows + 1}" t="s"><v>99</v></c></row>')
    whole = workbook(body)
    landing("a.zip", [("broken.xlsx", broken), ("whole.xlsx", whole), ("named.xls", whole),
                      ("legacy.xls", b"\xd0\xcf\x11\xe0" + b"x" * 600)])
    bronze = ingest.read_bronze(scan_archives(spark, landing.folder))
    counts = {r["entry"]: r["count"] for r in bronze.records.groupBy("entry").count().collect()}
    assert counts == {"whole.xlsx": rows - 1, "named.xls": rows - 1}
    failures = {r["entry"]: r["fatal"] for r in bronze.dead_letter.collect()}
    assert failures == {"broken.xlsx": False, "legacy.xls": False}
    order = bronze.records.filter("entry = 'whole.xlsx'").orderBy("ord").select("ord").collect()
    assert [r["ord"] for r in order] == list(range(rows - 1))


USUAL = (
    '<row r="2" spans="1:3"><c r="A2" t="inlineStr"><is><t>&lt;a&#x80;&#13;b&amp;lt;\r\nc</t></is></c>'
    '<c r="C2" s="1"><v>45000</v></c><c r="A2" t="str"><v>NA</v></c></row><row r="4"/>\n<row/><row> <c><v>1</v></c><c t="b"><v>0</v></c>'
    '<c t="inlineStr"><is><t xml:space="preserve"></t></is></c><c t="s"><v>0</v></c><c t="e"><v>#N/A</v></c><c t="b"><v></v></c></row>'
)
ODD = (
    "<row><c><v>1</v><!-- <c><v>2</v></c> --></c></row>",
    "<!-- <row><c><v>9</v></c></row> --><row><c><v>1</v></c></row>",
    "<row><c t='str'><v><![CDATA[<c/>]]></v></c></row>",
    '<row><c><f>1+1</f><v>2</v></c><c t="inlineStr"><is><r><t>a</t></r><r><t>b</t></r></is></c></row>',
    '<x:row xmlns:x="y"><x:c><x:v>3</x:v></x:c></x:row>',
    '<row><c t="b"><is><t></t></is></c></row>',
)


def rows_both_ways(sheet_rows):
    data = workbook(
        f'<row><c t="str" r="A1"><v>a</v></c></row>{sheet_rows}'.replace("<row", '<row xmlns:x="x"', 1),
        strings=["<si><t>s</t></si>"], styles='<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs>',
    )
    return list(sheet.Workbook(data).rows()), list(sheet.Workbook(data)._tree_rows())


@pytest.mark.parametrize("odd", ODD)
def test_rows_of_any_form_are_those_of_the_tree(odd):
    read, tree = rows_both_ways(USUAL + odd + USUAL)
    assert read == tree and len(read) > 9


def test_usual_sheets_are_read_without_a_tree(monkeypatch):
    read, tree = rows_both_ways(USUAL * 3)
    assert read == tree
    buffer = io.BytesIO()
    write_workbook(buffer, ["a", "b"], ([str(n), None] for n in range(30_000)), copies=2)
    monkeypatch.setattr(sheet.Workbook, "_tree_rows", lambda self: pytest.fail("read as a tree"))
    found = [r["a"] for r in sheet.records(buffer.getvalue())]
    assert found == [str(n // 2) for n in range(60_000)]


@pytest.mark.parametrize("broken", ["<row><c><v>1</v></row>", "<row><c><v>&no;</v></c></row>", "<row><x:c/></row>", '<row r="x"><c/></row>'])
def test_broken_sheets_fail_as_the_tree_does(broken):
    data = workbook('<row><c t="str"><v>a</v></c></row>' + broken)
    told = []
    for rows in (sheet.Workbook(data).rows(), sheet.Workbook(data)._tree_rows()):
        with pytest.raises(sheet.SheetError) as error:
            list(rows)
        told.append(str(error.value))
    assert told[0] == told[1]


LONG = (
    '<row r="{0}" spans="1:9"><c r="A{0}" t="inlineStr"><is><t xml:space="preserve"> {0} &amp;lt;&lt;器&quot;</t></is></c>'
    '<c r="B{0}" t="s"><v>1</v></c><c r="C{0}" s="1"><v>45000</v></c><c r="D{0}" t="str"><v>NA</v></c>'
    '<c r="F{0}"/><c r="G{0}"><v>{0}</v></c><c r="I{0}"><v>7.50</v></c></row>',
    '<row><c/><c t="str"><v></v></c><c t="e"><v>#N/A</v></c><c t="b"><v>1</v></c><c t="inlineStr"><is><t>x\r\ny</t></is></c></row>',
    '<row r="{0}"/><row><c s="2"><v>1e3</v></c></row><row><c t="s"><v>0</v></c><c/></row><row ht="1"><c/></row>',
)


def long_sheet(shapes, head="", tail="", count=300):
    rows, number = [head], 1
    for place in range(count):
        number += 9
        rows.append(shapes[place % len(shapes)].format(number))
    return workbook(
        "".join(rows) + tail, strings=["<si><t>s</t></si>", "<si><t>一 &amp;</t></si>"],
        styles='<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="2"/></cellXfs>',
    )


@pytest.mark.parametrize("head", ["", '<row r="1"><c t="str"><v>prdName</v></c><c/><c t="str"><v>b</v></c></row>',
                                  '<row><c t="str"><v>b</v></c><c t="str"><v>b</v></c><c t="str"><v>b.1</v></c></row>'])
@pytest.mark.parametrize("shapes", [LONG, LONG[:1], LONG[1:2], LONG[2:]])
def test_blocks_of_rows_are_those_read_one_by_one(monkeypatch, head, shapes):
    data = long_sheet(shapes, head)
    found = {}
    for size in (1, 5_000, 1 << 60):
        monkeypatch.setattr(sheet, "BLOCK_BYTES", size)
        found[size] = list(sheet.Workbook(data).rows()), list(sheet.records(data))
    assert found[1] == found[5_000] == found[1 << 60]
    assert found[1][0] == list(sheet.Workbook(data)._tree_rows())


def test_a_long_usual_sheet_is_read_in_blocks(monkeypatch):
    data = long_sheet(LONG, count=9_000)
    read = sheet.Workbook._usual_cells
    one_by_one = []
    monkeypatch.setattr(
        sheet.Workbook, "_usual_cells", lambda self, text, number: one_by_one.append(number) or read(self, text, number)
    )
    assert len(list(sheet.Workbook(data).rows())) == 3_000 * 6
    # The row of headers, and no more.
    assert len(one_by_one) == 1


@pytest.mark.parametrize("odd", [
    "<row><c t='str'><v>1</v></c></row>", '<row><c t="str"><v>a>b</v></c></row>', '<row><c t="str"><v>&#65;</v></c></row>',
    '<row> <c t="str"><v>1</v></c></row>', '<row><c r="B9" t="str"><v>1</v></c><c r="A9" t="str"><v>2</v></c></row>',
    '<row><c t="str"><v>1</v></c><c r="A9"/></row>', '<row x="1"><c t="str"><v>￮</v></c></row>',
    '<row><c t="s"><v>00</v></c><c t="s"><v> 1</v></c></row>',
])
def test_an_odd_row_among_many_is_read_as_the_tree_does(monkeypatch, odd):
    monkeypatch.setattr(sheet, "BLOCK_BYTES", 1)
    data = long_sheet(LONG, tail=odd + LONG[1] * 9)
    rows = list(sheet.Workbook(data).rows())
    assert rows == list(sheet.Workbook(data)._tree_rows()) and len(rows) == 100 * 6 + 10


@pytest.mark.parametrize("broken", [
    '<row><c t="s"><v>2</v></c></row>', "<row><c><v>q</v></c></row>", '<row a="1" a="2"><c t="str"><v>1</v></c></row>',
    '<row x:a="1"><c t="str"><v>1</v></c></row>', '<row><c t="str"><v>&no;</v></c></row>', '<row><c t="str"><v>\x01</v></c></row>',
    '<row><c t="str"><v>￿</v></c></row>', '<row><c t="str"><v>1</t></is></c></row>', '<row><c s="1"><v>1e300</v></c></row>',
    '<row><c t="str"><v>]]></v></c></row>',
])
def test_a_broken_row_among_many_fails_as_the_tree_does(monkeypatch, broken):
    monkeypatch.setattr(sheet, "BLOCK_BYTES", 1)
    data = long_sheet(LONG, tail=broken + LONG[1] * 9)
    told = []
    for rows in (sheet.Workbook(data).rows(), sheet.Workbook(data)._tree_rows()):
        with pytest.raises(sheet.SheetError) as error:
            list(rows)
        told.append(str(error.value))
    assert told[0] == told[1]


def test_rows_of_blocks_reach_the_bronze_table_as_all_others(spark, landing, monkeypatch):
    head = "".join(f'<c t="str"><v>{name}</v></c>' for name in ("prdName", "own", "unit"))
    data = long_sheet(LONG, f"<row>{head}</row>", count=30_000)
    landing("a.zip", [("long.xlsx", data)])
    found = ingest.read_bronze(scan_archives(spark, landing.folder)).records.orderBy("ord").drop("archive")
    expected = list(sheet.records(data))
    rows = found.collect()
    assert [r["ord"] for r in rows] == list(range(len(expected)))
    known = {"prdName", "unit"}
    for row, fields in zip(rows, expected):
        assert {n: row[n] for n in known if row[n] is not None} == {n: v for n, v in fields.items() if n in known}
        assert row["fields"] == {n: v for n, v in fields.items() if n not in known}
        assert row["layout"] == "\x1f".join(fields)
        assert (row["entry"], row["parent"], row["entry_ord"], row["release_ord"]) == ("long.xlsx", None, 0, 0)
