"""Audit events: minute statistics, dimensions, the event mart and its export rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalar import minute_stamp
from tidemark.operators.star import count_by, dimension_rows, star_join

# Columns of the event tables.
DAY = ["ano", "mes", "dia"]
MINUTE = [*DAY, "hora", "minuto"]
IDS = {
    "idplataforma": "plataforma",
    "idcliente": "cliente",
    "idservico": "servico",
    "idproduto": "produto",
    "idatividade": "atividade",
    "idacao": "acao",
    "idusuario": "usuario",
}
MART = [*MINUTE, *[c for pair in IDS.items() for c in pair], "quantidade"]
AUDIT_TEXT = (
    "idacao idproduto idservico idatividade payload porta idusuario nomeusuario localizador_tipo "
    "localizador ip data_fim data_inicio idcliente cliente idplataforma plataforma data horario "
    "data_criacao duracao produto atividade acao servico"
).split()
AUDIT = T.StructType(
    [T.StructField("_id", T.StringType())]
    + [T.StructField(c, T.IntegerType()) for c in MINUTE]
    + [T.StructField(c, T.StringType()) for c in AUDIT_TEXT]
)
NAMED = T.StructType([T.StructField("_id", T.StringType()), T.StructField("nome", T.StringType())])
GOLD = T.StructType(
    [T.StructField(c, T.IntegerType()) for c in MINUTE]
    + [T.StructField(c, T.StringType()) for pair in IDS.items() for c in pair]
    + [T.StructField("quantidade", T.LongType())]
)


def statistics(events: DataFrame) -> DataFrame:
    """Events per minute and combination of the seven ids."""
    return count_by(events, [*MINUTE, *IDS])


def mart(events: DataFrame, dedupe: bool = True) -> DataFrame:
    """The statistics with every id's name beside it."""
    names = {id_col: "nomeusuario" if name == "usuario" else name for id_col, name in IDS.items()}
    return star_join(statistics(events), dimension_rows(events, names), IDS, dedupe).select(*MART)


def export_rows(gold: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """The mart between two dates, with the minute as a timestamp.

    The range is a filter over the partition columns, so that one job reads just those days.
    """
    day = F.make_date("ano", "mes", "dia")
    rows = gold
    if start:
        rows = rows.where((day >= F.lit(start)) & (F.col("ano") >= start.year))
    if end:
        rows = rows.where((day <= F.lit(end)) & (F.col("ano") <= end.year))
    return rows.withColumn("horario", minute_stamp())
