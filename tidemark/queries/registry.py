"""Named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.adapters import ENTRIES

Run = Callable[[SparkSession, str], DataFrame]

RUNS: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Run], Run]:
    """Register a function of (spark, sf_dir) under ``name``; ``oracle`` is DuckDB SQL."""

    def register(run: Run) -> Run:
        RUNS[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


# The adapter views, as SQL.
BARS = """bars as (
  select cast(event_id as varchar) as _id, event_type as ticker, event_type as description,
         ts as "timestamp", value as open,
         value + cast(regexp_extract(props, '([0-9]+)', 1) as double) / cast(100 as double) as high,
         value - cast(regexp_extract(props, '([0-9]+)', 1) as double) / cast(1000 as double) as low,
         value as close, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as volume
  from events)"""

CAPTURED = f"""{BARS}, stamped as (
  select *, "timestamp" as k,
         "timestamp" + to_seconds(cast(_id as bigint) % 7) as b from bars), stamped2 as (
  select *, b + to_seconds(cast(_id as bigint) % 11) as s from stamped), stamped3 as (
  select *, s + to_seconds(cast(_id as bigint) % 13) as g from stamped2), captured as (
  select *, cast(epoch_us(b) // 1000000 - epoch_us(k) // 1000000 as integer) as _delta_kafka_bronze,
         cast(epoch_us(s) // 1000000 - epoch_us(b) // 1000000 as integer) as _delta_bronze_silver,
         cast(epoch_us(g) // 1000000 - epoch_us(s) // 1000000 as integer) as _delta_silver_gold
  from stamped3)"""

RETAIL = """retail as (
  select concat(case when o_orderstatus = 'F' then 'C' else '' end, cast(o_orderkey as varchar)) as InvoiceNo,
         cast(l_partkey as varchar) as StockCode, p_name as Description,
         cast(l_quantity as bigint) as Quantity, o_orderdate as InvoiceDate,
         l_extendedprice / l_quantity as UnitPrice, o_custkey as CustomerID, n_name as Country
  from lineitem
  join orders on l_orderkey = o_orderkey
  join part on l_partkey = p_partkey
  join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey)"""

EVENTO = """evento as (
  select cast(event_id as varchar) as _id,
         cast(year(ts) as int) as ano, cast(month(ts) as int) as mes, cast(day(ts) as int) as dia,
         cast(hour(ts) as int) as hora, cast(minute(ts) as int) as minuto, ts as data_criacao,
         cast(user_id % 3 as varchar) as idplataforma, concat('plataforma ', cast(user_id % 3 as varchar)) as plataforma,
         cast(user_id % 7 as varchar) as idcliente, concat('cliente ', cast(user_id % 7 as varchar)) as cliente,
         cast(event_id % 5 as varchar) as idservico, concat('servico ', cast(event_id % 5 as varchar)) as servico,
         cast(event_id % 4 as varchar) as idproduto, concat('produto ', cast(event_id % 4 as varchar)) as produto,
         cast(event_id % 6 as varchar) as idatividade, concat('atividade ', cast(event_id % 6 as varchar)) as atividade,
         event_type as idacao, concat('acao ', event_type) as acao,
         cast(user_id as varchar) as idusuario,
         concat('usuario ', cast(user_id as varchar), case when event_id % 97 = 0 then ' b' else '' end) as nomeusuario
  from events)"""

FEATURES = f"""features as (
  select vec_id as id, label,
         {', '.join(f'cast(embedding[{i}] as double) as f{i}' for i in range(1, ENTRIES + 1))}
  from embeddings)"""
