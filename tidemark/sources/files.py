"""CSV files and workbooks."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns and formats of the files.
BAR_CSV = (
    "ticker string, timestamp timestamp, open double, high double, low double, close double, volume bigint"
)
BAR_CSV_COLUMNS = ["ticker", "timestamp", "open", "high", "low", "close", "volume"]
CSV_STAMP = "yyyy-MM-dd HH:mm:ss"
TICKER_CSV = (
    "_id string, ticker string, currency string, security string, mic string, asset_type string, "
    "cik string, composite_figi string, share_figi string, lei string"
)


def file_stem() -> Column:
    """The file's name up to its first dot, which names the topic of its rows."""
    return F.split_part(F.col("_metadata.file_name"), F.lit("."), F.lit(1))


def _bar_csvs(reader, path: str) -> DataFrame:
    return (
        reader.schema(BAR_CSV)
        .option("header", "true")
        .option("timestampFormat", CSV_STAMP)
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", "true")
        .csv(path)
        .select("*", file_stem().alias("topic"))
    )


def read_bar_csvs(spark: SparkSession, path: str) -> DataFrame:
    """Every ``.csv`` below ``path`` as typed bars, with the file stem as ``topic``."""
    return _bar_csvs(spark.read, path)


def stream_bar_csvs(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """S6 as a stream of files; bars in files carry no description."""
    reader = spark.readStream.option("maxFilesPerTrigger", str(files_per_batch))
    return _bar_csvs(reader, path).withColumn("description", F.lit(None).cast("string"))


def read_tickers(spark: SparkSession, path: str) -> DataFrame:
    """The ticker list; quoted commas stay inside their field."""
    return spark.read.schema(TICKER_CSV).csv(path, header=True, quote='"', escape='"')


def write_tickers(tickers: DataFrame, path: str) -> None:
    """The ticker list as CSV; fields with commas or quotes are quoted."""
    names = [field.split(" ")[0] for field in TICKER_CSV.split(", ")]
    tickers.select(*names).write.csv(path, header=True, quote='"', escape='"')


def bar_text(bars: DataFrame) -> DataFrame:
    """The bar columns as they are spelled in a file: six decimals, seconds."""
    price = lambda c: F.format_string("%f", F.col(c)).alias(c)
    return bars.select(
        "ticker",
        F.date_format("timestamp", CSV_STAMP).alias("timestamp"),
        *[price(c) for c in ("open", "high", "low", "close")],
        F.col("volume").cast("string").alias("volume"),
    )


def write_bar_csvs(bars: DataFrame, path: str) -> None:
    """CSV with header, one folder per ticker, long tickers split over several files."""
    text = bar_text(bars).withColumn("_folder", F.col("ticker"))
    (
        text.hint("rebalance", "_folder")
        .sortWithinPartitions("_folder", "timestamp")
        .write.partitionBy("_folder")
        .csv(path, header=True)
    )


# ---- S8: workbooks ------------------------------------------------------------------------------

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _sheet_file(book: zipfile.ZipFile, sheet: str | None) -> str:
    """Where a workbook keeps the sheet of a name, or its first one."""
    sheets = list(ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"))
    found = [s for s in sheets if sheet is None or s.get("name") == sheet]
    if not found:
        raise ValueError(f"no sheet {sheet!r} among {[s.get('name') for s in sheets]}")
    if sheet is None and len(sheets) > 1:
        raise ValueError(f"name one of the sheets {[s.get('name') for s in sheets]}")
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(link.get("Target") for link in links if link.get("Id") == found[0].get(_LINK))
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _sheet_cells(content: bytes, name: str | None) -> list[dict[int, str]]:
    """Cell texts of one sheet of a workbook, per row, by 0-based column."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")):
                shared.append("".join(t.text or "" for t in item.iter(f"{_MAIN}t")))
        sheet = ElementTree.fromstring(book.read(_sheet_file(book, name)))
    rows = []
    for row in sheet.iter(f"{_MAIN}row"):
        cells = {}
        for at, cell in enumerate(row.iter(f"{_MAIN}c")):
            letters = re.match("[A-Z]*", cell.get("r", "")).group()
            column = 0
            for letter in letters:
                column = column * 26 + ord(letter) - ord("A") + 1
            text = cell.find(f"{_MAIN}v")
            value = text.text if text is not None else None
            if cell.get("t") == "s" and value is not None:
                value = shared[int(value)]
            elif cell.get("t") == "inlineStr":
                value = "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
            if value is not None:
                cells[column - 1 if letters else at] = value
        rows.append(cells)
    return rows


def read_workbooks(spark: SparkSession, path: str, schema: T.StructType, sheet: str | None = None) -> DataFrame:
    """A sheet of every ``.xlsx`` below ``path``, columns matched by header name.

    A workbook of several sheets needs the name of one; none is left out unsaid.

    One task opens one workbook, whose size the file format bounds. Every cell arrives as text and
    the schema decides its type, so a column of codes such as an invoice number stays text.
    """
    names = schema.names
    as_text = T.StructType([T.StructField(n, T.StringType()) for n in names])

    def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                header, *body = _sheet_cells(content, sheet)
                place = {title: column for column, title in header.items()}
                yield pd.DataFrame(
                    {n: [row.get(place.get(n)) for row in body] for n in names}, dtype=object
                )

    text = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.xlsx")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("content")
        .mapInPandas(rows_of, as_text)
    )
    return text.select(*[_typed(field) for field in schema])


def _typed(field: T.StructField) -> Column:
    text = F.col(field.name)
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        # A sheet keeps a moment as days since 1899-12-30.
        days = text.try_cast("double")
        serial = F.timestamp_seconds(F.round((days - F.lit(25569.0)) * F.lit(86400.0)))
        return F.coalesce(serial, text.try_cast("timestamp")).cast(field.dataType).alias(field.name)
    if isinstance(field.dataType, T.IntegralType):
        return text.try_cast("double").try_cast(field.dataType).alias(field.name)
    return text.try_cast(field.dataType).alias(field.name)
