"""Mart options. No database is started here, so nothing is written."""

from tidemark.sources.jdbc import jdbc_writer, write_options

CONNECTION = {"url": "jdbc:postgresql://host/db", "user": "u", "password": "p"}


def test_overwrite_keeps_the_table():
    options = write_options("stocks_daily", CONNECTION, "overwrite", 4, 500)
    assert options == {
        **CONNECTION, "dbtable": "stocks_daily", "numPartitions": "4", "batchsize": "500", "truncate": "true",
    }
    assert "truncate" not in write_options("eventos", CONNECTION, "append", 4, 500)


def test_writer_is_built_without_connecting(spark):
    assert jdbc_writer(spark.range(1), "t", CONNECTION, partitions=4) is not None
