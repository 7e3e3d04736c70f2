import json
import os
import zipfile

import pytest

from tabsmith.sources import SourceSpec, load_sources, read_csv, read_jdbc, read_json, read_xlsx, sheet_rows, write_jdbc
from tabsmith.sources.jdbc import quote_name

_CT = (
    '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
    '<Default Extension="xml" ContentType="application/xml"/></Types>'
)
_WB = (
    '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
    'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
    '<sheets><sheet name="Sales" sheetId="1" r:id="rId1"/><sheet name="Other" sheetId="2" r:id="rId2"/></sheets></workbook>'
)
_RELS = (
    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    '<Relationship Id="rId1" Type="worksheet" Target="worksheets/sheet1.xml"/>'
    '<Relationship Id="rId2" Type="worksheet" Target="worksheets/sheet2.xml"/></Relationships>'
)


def _cell(ref, value):
    if value is None:
        return ""
    if isinstance(value, str):
        return f'<c r="{ref}" t="inlineStr"><is><t>{value}</t></is></c>'
    return f'<c r="{ref}"><v>{value}</v></c>'


def write_workbook(path, rows, shared_header=True):
    """A minimal xlsx: header via shared strings, body via inline strings/numbers."""
    letters = "ABCDEFGH"
    header = rows[0]
    shared = "".join(f"<si><t>{h}</t></si>" for h in header)
    xml_rows = ['<row r="1">' + "".join(f'<c r="{letters[i]}1" t="s"><v>{i}</v></c>' for i in range(len(header))) + "</row>"]
    for n, row in enumerate(rows[1:], start=2):
        xml_rows.append(f'<row r="{n}">' + "".join(_cell(f"{letters[i]}{n}", v) for i, v in enumerate(row)) + "</row>")
    sheet = (
        '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
        + "".join(xml_rows)
        + "</sheetData></worksheet>"
    )
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("[Content_Types].xml", _CT)
        z.writestr("xl/workbook.xml", _WB)
        z.writestr("xl/_rels/workbook.xml.rels", _RELS)
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">{shared}</sst>')
        z.writestr("xl/worksheets/sheet1.xml", sheet)
        z.writestr("xl/worksheets/sheet2.xml", sheet.replace("Shoes", "IGNORED"))


def test_sheet_rows_parses_first_sheet(tmp_dir):
    path = os.path.join(tmp_dir, "a.xlsx")
    write_workbook(path, [["SaleId", "Category", "Qty"], ["H1", "Shoes", 2], ["H2", "Jeans", None]])
    with open(path, "rb") as f:
        rows = sheet_rows(f.read())
    assert rows == [["SaleId", "Category", "Qty"], ["H1", "Shoes", "2"], ["H2", "Jeans"]]


def test_read_xlsx_many_workbooks(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "books")
    os.makedirs(folder)
    write_workbook(os.path.join(folder, "a.xlsx"), [["SaleId", "Category", "Qty", "Sale"], ["H1", "Shoes", 2, 10.5], ["H2", "Jeans", None, 3]])
    write_workbook(os.path.join(folder, "b.xlsx"), [["SaleId", "Category", "Sale"], ["H3", "Perfumes", 7.25]])
    df = read_xlsx(spark, folder)
    assert df.columns == ["SaleId", "Category", "Sale", "Qty"] or set(df.columns) == {"SaleId", "Category", "Qty", "Sale"}
    rows = {r.SaleId: r for r in df.collect()}
    assert set(rows) == {"H1", "H2", "H3"}
    assert rows["H1"].Qty == "2" and rows["H2"].Qty is None and rows["H3"].Qty is None
    assert rows["H3"].Category == "Perfumes"
    typed = read_xlsx(spark, folder, schema=spark.createDataFrame([], "SaleId string, Qty double, Sale double").schema)
    assert {r.SaleId: r.Sale for r in typed.collect()} == {"H1": 10.5, "H2": 3.0, "H3": 7.25}


def test_xlsx_source_in_registry(spark, tmp_dir):
    path = os.path.join(tmp_dir, "hongkong_feed.xlsx")
    write_workbook(path, [["SaleId", "Category", "Product", "Qty", "Sale"], ["K1", "Shoes", "x", 1, 2]])
    df = load_sources(spark, [SourceSpec("xlsx", path, "HongKong")])
    assert [(r.SaleId, r.Country) for r in df.collect()] == [("K1", "HongKong")]


def test_json_array_needs_multiline(spark, tmp_dir):
    path = os.path.join(tmp_dir, "s.json")
    with open(path, "w") as f:
        json.dump([{"SaleId": "S1", "Qty": 4, "Sale": 2.5}, {"SaleId": "S2", "Qty": None, "Sale": 1.0}], f, indent=2)
    df = read_json(spark, path)
    assert dict(df.dtypes) == {"SaleId": "string", "Qty": "bigint", "Sale": "double"}
    assert df.count() == 2
    with pytest.raises(ValueError, match="no JSON records"):
        read_json(spark, path, multi_line=False)


def test_csv_schema_keeps_leading_zeros(spark, tmp_dir):
    path = os.path.join(tmp_dir, "b.csv")
    with open(path, "w") as f:
        f.write("Branch_Code,Amount\n007,1.5\n")
    inferred = read_csv(spark, path, infer_schema=True).first()
    typed = read_csv(spark, path, schema="Branch_Code string, Amount double").first()
    assert inferred.Branch_Code == 7 and typed.Branch_Code == "007"


def test_jdbc_round_trip_and_partitioned_read(spark):
    # In-process Derby (its jar ships with Spark). An in-memory database is only
    # visible inside this JVM, so this is a local test, not a cluster job.
    url = "jdbc:derby:memory:tabsmith_test;create=true"
    rows = [(i, f"S{i}", float(i) * 1.5) for i in range(1, 31)]
    df = spark.createDataFrame(rows, "ID int, SALEID string, SALE double")
    write_jdbc(df, url, "SALES", mode="overwrite", kind="derby")
    back = read_jdbc(spark, url, "SALES", kind="derby")
    assert back.count() == 30
    parted = read_jdbc(spark, url, "SALES", kind="derby", partition_column="ID", lower_bound=1, upper_bound=31, num_partitions=3)
    assert parted.rdd.getNumPartitions() == 3
    assert sorted(r.ID for r in parted.collect()) == list(range(1, 31))
    pushed = back.filter("SALE > 30").select("SALEID")
    assert "PushedFilters" in pushed._jdf.queryExecution().executedPlan().toString()
    assert pushed.count() == 10
    via_registry = load_sources(spark, [SourceSpec("derby", url, "Norway", table="SALES")])
    assert via_registry.filter("Country = 'Norway'").count() == 30


def test_quote_name():
    assert quote_name("postgres", "Region_Sales") == '"Region_Sales"'
    assert quote_name("postgres", "sales") == "sales"
    assert quote_name("mysql", "Region_Sales") == "Region_Sales"
