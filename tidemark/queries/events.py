"""Queries over audit events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark import adapters
from tidemark.operators.star import dimension_pairs
from tidemark.plans import events
from tidemark.queries.registry import EVENTO, query
from tidemark.shared import scratch_path
from tidemark.sources import tables

KEYS = ", ".join([*events.MINUTE, *events.IDS])
STATS = f"with {EVENTO}, stats as (select {KEYS}, count(*) as quantidade from evento group by all)"


def _source_name(name):
    return "nomeusuario" if name == "usuario" else name


def _mart(dedupe: bool) -> str:
    dims = []
    for id_col, name in events.IDS.items():
        source = _source_name(name)
        dims.append(
            f"d_{name} as (select {id_col}, min({source}) as {name} from evento group by 1)"
            if dedupe
            else f"d_{name} as (select distinct {id_col}, {source} as {name} from evento)"
        )
    joins = " ".join(f"join d_{name} using ({id_col})" for id_col, name in events.IDS.items())
    return f"{STATS}, {', '.join(dims)}, mart as (select {', '.join(events.MART)} from stats {joins})"


@query("event_stats", f"{STATS} select * from stats")
def event_stats(spark, sf_dir):
    return events.statistics(adapters.evento(spark, sf_dir))


@query(
    "dimension_pairs",
    f"with {EVENTO} "
    + " union all ".join(
        f"select distinct '{i}' as dim, {i} as id, {_source_name(n)} as name from evento"
        for i, n in events.IDS.items()
    ),
)
def all_dimension_pairs(spark, sf_dir):
    names = {i: _source_name(n) for i, n in events.IDS.items()}
    return dimension_pairs(adapters.evento(spark, sf_dir), names)


@query(
    "dim_usuario_one_per_key",
    f"with {EVENTO} select idusuario, min(nomeusuario) as usuario from evento group by 1",
)
def dim_usuario_one_per_key(spark, sf_dir):
    pairs = adapters.evento(spark, sf_dir).select("idusuario", "nomeusuario").distinct()
    return pairs.groupBy("idusuario").agg(F.min("nomeusuario").alias("usuario"))


@query("event_mart", f"{_mart(True)} select * from mart")
def event_mart(spark, sf_dir):
    return events.mart(adapters.evento(spark, sf_dir))


@query("event_mart_fanout", f"{_mart(False)} select * from mart")
def event_mart_fanout(spark, sf_dir):
    return events.mart(adapters.evento(spark, sf_dir), dedupe=False)


def _published_mart(spark, sf_dir):
    path = scratch_path(spark, "event-mart")
    tables.publish(event_mart(spark, sf_dir), path, events.DAY)
    return path


@query(
    "event_mart_horario",
    f"""{_mart(True)} select *, make_timestamp(ano, mes, dia, hora, minuto, 0) as horario from mart
    where ano between 2020 and 2024""",
)
def event_mart_horario(spark, sf_dir):
    gold = tables.read_table(spark, _published_mart(spark, sf_dir))
    return events.export_rows(gold, dt.date(2020, 1, 1), dt.date(2024, 12, 31))


@query("replace_partitions", f"{STATS} select * from stats")
def replace_partitions(spark, sf_dir):
    """The later days are published twice; the table holds them once."""
    path = scratch_path(spark, "event-stats")
    stats = event_stats(spark, sf_dir)
    tables.publish(stats, path, events.DAY, replace="partitions")
    tables.publish(stats.where("dia > 20"), path, events.DAY, replace="partitions")
    return tables.read_table(spark, path)
