"""Retail invoices: silver lines, derived lists, sale and cancellation figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import invoice_number, invoice_type, is_cancelled, rejected

# Tags of the sale and the cancellation row.
SALES, CANCELLATIONS = "Vendas", "Cancelamento"


def silver(bronze: DataFrame) -> DataFrame:
    """Numeric invoice number and a type column; bad numbers become NULL."""
    return bronze.select(
        invoice_number().alias("InvoiceNo"),
        invoice_type().alias("Type"),
        "StockCode",
        "Description",
        "Quantity",
        "InvoiceDate",
        "UnitPrice",
        "CustomerID",
        "Country",
    )


def rejects(bronze: DataFrame) -> DataFrame:
    """how many invoice numbers did not parse."""
    return bronze.agg(F.count_if(rejected(invoice_number(), "InvoiceNo")).alias("rejected"))


def split(bronze: DataFrame) -> DataFrame:
    """A1, V5: lines of sales and of cancellations, from one scan."""
    counts = bronze.agg(
        F.count_if(~is_cancelled()).alias("sales"), F.count_if(is_cancelled()).alias("cancelled")
    )
    return counts.select(
        F.stack(F.lit(2), F.lit(SALES), "sales", F.lit(CANCELLATIONS), "cancelled").alias("tipo", "Qtd")
    )


def split_union(bronze: DataFrame) -> DataFrame:
    """The same two rows as a distinct union of two aggregates."""
    tagged = lambda tag, test: bronze.agg(F.count_if(test).alias("Qtd")).select(
        F.lit(tag).alias("tipo"), "Qtd"
    )
    return (
        tagged(SALES, ~is_cancelled())
        .union(tagged(CANCELLATIONS, is_cancelled()))
        .distinct()
    )


def split_share(bronze: DataFrame) -> DataFrame:
    """Each row's share of the total; both come from the one row of counts."""
    counts = bronze.agg(
        F.count_if(~is_cancelled()).alias("sales"), F.count_if(is_cancelled()).alias("cancelled")
    ).withColumn("total", F.col("sales") + F.col("cancelled"))
    return counts.select(
        "total",
        F.stack(F.lit(2), F.lit(SALES), "sales", F.lit(CANCELLATIONS), "cancelled").alias("tipo", "Qtd"),
    ).select("tipo", "Qtd", F.try_divide(F.col("Qtd"), F.col("total")).alias("share"))


def stock_list(bronze: DataFrame) -> DataFrame:
    """Distinct code and description pairs; a code may keep several descriptions."""
    return bronze.select("StockCode", "Description").distinct()


def country_list(bronze: DataFrame) -> DataFrame:
    """The countries."""
    return bronze.select(F.col("Country").alias("country")).distinct()


def by_country(silver_lines: DataFrame) -> DataFrame:
    """A2: quantity per country, day and type. Grouped by date, spelled as text per group."""
    return (
        silver_lines.groupBy("Country", F.to_date("InvoiceDate").alias("day"), "Type")
        .agg(F.sum("Quantity").alias("qty"))
        .select(
            F.col("Country").alias("country"),
            F.date_format("day", "yyyy-MM-dd").alias("InvoiceDate"),
            F.col("Type").alias("type"),
            "qty",
        )
    )


def country_series(gold: DataFrame, country: str) -> DataFrame:
    """One country's quantities by day and type."""
    return gold.where(F.col("country") == country)


def country_years(gold: DataFrame, country: str) -> DataFrame:
    """V4: one country's quantity per year, in order."""
    year = F.substring("InvoiceDate", 1, 4).cast("int")
    return (
        country_series(gold, country)
        .groupBy(year.alias("year"))
        .agg(F.sum("qty").alias("qty"))
        .orderBy("year")
    )


def earliest(bronze: DataFrame, n: int = 10) -> DataFrame:
    """O3: the ``n`` earliest lines; every column breaks ties, so the choice repeats."""
    rest = [c for c in bronze.columns if c != "InvoiceDate"]
    return bronze.orderBy("InvoiceDate", *rest).limit(n)
