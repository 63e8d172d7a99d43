import pytest
import datetime as dt
import io
import zipfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import files
from tidemark.sources.storage import Storage


def test_tickers_with_quoted_commas(spark, path):
    text = (
        '"_id",ticker,currency,security,mic,asset_type,cik,composite_figi,share_figi,lei\n'
        'x1,TSLA,USD,"Tesla, Inc.",XNGS,COMMON_STOCK,1318605,B1,S1,L1\n'
    )
    Storage(spark, path).write_text(f"{path}/tickers.csv", text)
    row = files.read_tickers(spark, f"{path}/tickers.csv").first()
    assert (row["_id"], row["ticker"], row["security"], row["lei"]) == ("x1", "TSLA", "Tesla, Inc.", "L1")


def test_exported_files_have_header_and_six_decimals(spark, path):
    bars = spark.createDataFrame(
        [("A/B", dt.datetime(2024, 1, 2, 3, 4, 5), 1.5, 2.0, 1.0, 1 / 3, 7)],
        "ticker string, timestamp timestamp, open double, high double, low double, close double, volume bigint",
    )
    files.write_bar_csvs(bars, path)
    lines = [r["value"] for r in spark.read.option("recursiveFileLookup", "true").text(path).collect()]
    assert lines == [
        "ticker,timestamp,open,high,low,close,volume",
        "A/B,2024-01-02 03:04:05,1.500000,2.000000,1.000000,0.333333,7",
    ]
    assert files.read_bar_csvs(spark, path).first()["close"] == 0.333333


def _workbook(rows, shared=True, more=()):
    texts = []

    def cell(ref, value):
        if value is None:
            return ""
        if isinstance(value, str) and shared:
            texts.append(value)
            return f'<c r="{ref}" t="s"><v>{len(texts) - 1}</v></c>'
        if isinstance(value, str):
            return f'<c r="{ref}" t="inlineStr"><is><t>{value}</t></is></c>'
        return f'<c r="{ref}"><v>{value}</v></c>'

    body = "".join(
        f'<row r="{i + 1}">' + "".join(cell(f"{chr(65 + j)}{i + 1}", v) for j, v in enumerate(row)) + "</row>"
        for i, row in enumerate(rows)
    )
    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        book.writestr("xl/worksheets/sheet1.xml", f"<worksheet {space}><sheetData>{body}</sheetData></worksheet>")
        office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        names = ["Lines", *more]
        entries = "".join(f'<sheet name="{n}" sheetId="{k}" r:id="r{k}"/>' for k, n in enumerate(names, 1))
        book.writestr("xl/workbook.xml", f'<workbook {space} xmlns:r="{office}"><sheets>{entries}</sheets></workbook>')
        targets = "".join(f'<Relationship Id="r{k}" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(names) + 1))
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{targets}</Relationships>")
        if shared:
            items = "".join(f"<si><t>{t}</t></si>" for t in texts)
            book.writestr("xl/sharedStrings.xml", f"<sst {space}>{items}</sst>")
    return out.getvalue()


def test_workbooks(spark, path):
    import os

    os.makedirs(path)
    header = ["InvoiceNo", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]
    for name, shared, rows in (
        ("a.xlsx", True, [[536365, 6, 40513.3513888889, 2.55, 17850, "France"], ["C536379", -1, 40513.5, 27.5, None, "France"]]),
        ("b.xlsx", False, [["536370", 3, "2010-12-01 08:45:00", 1, 12583, "Norway"]]),
    ):
        with open(f"{path}/{name}", "wb") as file:
            file.write(_workbook([header, *rows], shared))
    schema = (
        T.StructType()
        .add("InvoiceNo", T.StringType())
        .add("Quantity", T.LongType())
        .add("InvoiceDate", T.TimestampType())
        .add("UnitPrice", T.DoubleType())
        .add("CustomerID", T.LongType())
        .add("Country", T.StringType())
    )
    got = files.read_workbooks(spark, path, schema).withColumn("InvoiceDate", F.col("InvoiceDate").cast("string"))
    assert sorted(map(tuple, got.collect())) == [
        ("536365", 6, "2010-12-01 08:26:00", 2.55, 17850, "France"),
        ("536370", 3, "2010-12-01 08:45:00", 1.0, 12583, "Norway"),
        ("C536379", -1, "2010-12-01 12:00:00", 27.5, None, "France"),
    ]


def test_a_sheet_of_several_is_chosen_by_name(spark, path):
    import os

    os.makedirs(path)
    with open(f"{path}/a.xlsx", "wb") as file:
        file.write(_workbook([["k"], ["1"]], more=["Other"]))
    schema = spark.createDataFrame([], "k int").schema
    assert [r["k"] for r in files.read_workbooks(spark, path, schema, "Lines").collect()] == [1]
    for name in (None, "Missing"):
        with pytest.raises(Exception, match="name one of the sheets|no sheet"):
            files.read_workbooks(spark, path, schema, name).collect()
