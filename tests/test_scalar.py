import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import scalar
from tidemark.plans import classify, retail


def test_invoice_marks(spark):
    rows = spark.createDataFrame(
        [("C536379",), ("536365",), ("c536379",), ("A563185",), ("",), (None,)], "InvoiceNo string"
    )
    got = rows.select(scalar.invoice_number().alias("n"), scalar.invoice_type().alias("t")).collect()
    assert [tuple(r) for r in got] == [
        (536379, "C"), (536365, "I"), (None, "I"), (None, "I"), (None, "I"), (None, "I"),
    ]
    assert retail.rejects(rows).first()["rejected"] == 3
    assert {r["tipo"]: r["Qtd"] for r in retail.split(rows).collect()} == {
        "Vendas": 5, "Cancelamento": 1,
    }


def test_timestamps(spark):
    texts = ["2024-12-31T23:00:00-03:00", "2020-1-5 3:7", "xx", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    parsed = scalar.parse_timestamp("t")
    got = rows.select(F.year(parsed).alias("y"), scalar.rejected(parsed, "t").alias("bad")).collect()
    assert [tuple(r) for r in got] == [(2025, False), (2020, False), (None, True), (None, False)]
    assert rows.select(scalar.parse_date("t").alias("d")).collect()[1]["d"] == dt.date(2020, 1, 5)


def test_epoch_shift_and_zone(spark):
    row = spark.createDataFrame([(1707780186183,)], "ms bigint").select(
        scalar.from_epoch_millis("ms").alias("t")
    )
    got = row.select(
        F.col("t").cast("string").alias("t"),
        scalar.shift_hours(F.col("t"), -5).cast("string").alias("shifted"),
        scalar.to_zone("t", "America/Sao_Paulo").cast("string").alias("local"),
    ).first()
    assert got["t"] == "2024-02-12 23:23:06.183"
    assert got["shifted"] == "2024-02-12 18:23:06.183"
    assert got["local"] == "2024-02-12 20:23:06.183"


def test_seconds_are_floored_before_the_difference(spark):
    rows = spark.sql("select timestamp'2024-01-01 00:00:00.900' as a, timestamp'2024-01-01 00:00:01.100' as b")
    assert rows.select(scalar.seconds_between("a", "b").alias("s")).first()["s"] == 1


def test_minute_stamp(spark):
    rows = spark.createDataFrame([(2020, 1, 5, 3, 7)], "ano int, mes int, dia int, hora int, minuto int")
    assert rows.select(scalar.minute_stamp().alias("h")).first()["h"] == dt.datetime(2020, 1, 5, 3, 7)


def test_unknown_class_gets_the_last_name(spark):
    rows = spark.createDataFrame([(0,), (1,), (2,), (9,)], "label int")
    names = [r["class_name"] for r in classify.named(rows).collect()]
    assert names == ["sentosa", "versicolor", "virginica", "virginica"]
