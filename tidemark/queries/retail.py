"""Queries over retail invoices."""

from __future__ import annotations

from tidemark import adapters
from tidemark.plans import retail
from tidemark.queries.registry import RETAIL, query

# Fixed value: the country of the one-country queries.
COUNTRY = "NATION_7"

SILVER = f"""with {RETAIL}, silver as (
  select try_cast(case when left(InvoiceNo, 1) = 'C' then substring(InvoiceNo, 2) else InvoiceNo end as bigint)
           as InvoiceNo,
         case when left(InvoiceNo, 1) = 'C' then 'C' else 'I' end as Type,
         StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country
  from retail)"""

GOLD = f"""{SILVER}, gold as (
  select Country as country, strftime(InvoiceDate, '%Y-%m-%d') as InvoiceDate, Type as type,
         cast(sum(Quantity) as bigint) as qty
  from silver group by 1, 2, 3)"""

SPLIT = f"""with {RETAIL}, split as (
  select 'Vendas' as tipo, count(*) filter (left(InvoiceNo, 1) <> 'C') as Qtd from retail
  union
  select 'Cancelamento' as tipo, count(*) filter (left(InvoiceNo, 1) = 'C') as Qtd from retail)"""


@query("silver_vendas", f"{SILVER} select * from silver")
def silver_vendas(spark, sf_dir):
    return retail.silver(adapters.retail(spark, sf_dir))


@query("invoice_rejects", f"{SILVER} select count(*) filter (InvoiceNo is null) as rejected from silver")
def invoice_rejects(spark, sf_dir):
    return retail.rejects(adapters.retail(spark, sf_dir))


@query("invoice_split", f"{SPLIT} select * from split")
def invoice_split(spark, sf_dir):
    return retail.split(adapters.retail(spark, sf_dir))


@query("invoice_split_union", f"{SPLIT} select * from split")
def invoice_split_union(spark, sf_dir):
    return retail.split_union(adapters.retail(spark, sf_dir))


@query(
    "invoice_split_share",
    f"{SPLIT} select tipo, Qtd, cast(Qtd as double) / sum(Qtd) over () as share from split",
)
def invoice_split_share(spark, sf_dir):
    return retail.split_share(adapters.retail(spark, sf_dir))


@query("stock_list", f"with {RETAIL} select distinct StockCode, Description from retail")
def stock_list(spark, sf_dir):
    return retail.stock_list(adapters.retail(spark, sf_dir))


@query("country_list", f"with {RETAIL} select distinct Country as country from retail")
def country_list(spark, sf_dir):
    return retail.country_list(adapters.retail(spark, sf_dir))


@query("invoices_by_country", f"{GOLD} select * from gold")
def invoices_by_country(spark, sf_dir):
    return retail.by_country(retail.silver(adapters.retail(spark, sf_dir)))


@query("country_series", f"{GOLD} select * from gold where country = '{COUNTRY}'")
def country_series(spark, sf_dir):
    return retail.country_series(invoices_by_country(spark, sf_dir), COUNTRY)


@query(
    "country_years",
    f"""{GOLD} select cast(left(InvoiceDate, 4) as int) as year, cast(sum(qty) as bigint) as qty from gold
    where country = '{COUNTRY}' group by 1 order by 1""",
)
def country_years(spark, sf_dir):
    return retail.country_years(invoices_by_country(spark, sf_dir), COUNTRY)


@query(
    "earliest_lines",
    f"""with {RETAIL} select * from retail
    order by InvoiceDate, InvoiceNo, StockCode, Description, Quantity, UnitPrice, CustomerID, Country limit 10""",
)
def earliest_lines(spark, sf_dir):
    return retail.earliest(adapters.retail(spark, sf_dir))
