import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.decode import decode_replay, encode_avro_bars, encode_bars, frame
from tidemark.sources import tables, topics
from tidemark.sources.layout import Lake
from tidemark.sources.storage import Storage
from tidemark.streaming import bronze, silver

START = dt.datetime(2024, 1, 2, 10)


def _bars(spark, rows):
    full = [(t, START + dt.timedelta(minutes=m), c, c, c, c, 1) for t, m, c in rows]
    return spark.createDataFrame(
        full, "ticker string, timestamp timestamp, open double, high double, low double, close double, volume bigint"
    )


def _send(spark, rows, path):
    topics.write_topic(encode_bars(_bars(spark, rows).coalesce(1)), "stocks", path=path)


def _drain(spark, lake, topic, max_files=None, counts=None):
    bronze_path, silver_path = lake.path("bronze", "bars"), lake.path("silver", "bars")
    bronze.topic_to_bronze(
        topics.stream_topic(spark, "stocks", path=topic, max_files=max_files),
        bronze_path,
        lake.checkpoint("bronze", "bars"),
    ).awaitTermination()
    silver.bars_to_silver(
        spark,
        bronze_path,
        silver_path,
        lake.checkpoint("silver", "bars"),
        max_files=max_files,
        report=(lambda *c: counts.append(c)) if counts is not None else None,
    ).awaitTermination()
    return bronze_path, silver_path


def _content(spark, path):
    rows = tables.read_table(spark, path).select("ticker", F.minute("timestamp"), "close").collect()
    return sorted(map(tuple, rows))


def test_many_batches_restart_and_late_correction(spark, path):
    lake, topic, counts = Lake(path), f"{path}/_topic", []
    _send(spark, [("A", 0, 1.0), ("B", 0, 5.0)], topic)
    _send(spark, [("A", 0, 1.0), ("A", 1, 2.0)], topic)
    bronze_path, silver_path = _drain(spark, lake, topic, max_files=1, counts=counts)
    assert _content(spark, silver_path) == [("A", 0, 1.0), ("A", 1, 2.0), ("B", 0, 5.0)]
    assert tables.read_table(spark, bronze_path).count() == 4
    assert sum(c[1] for c in counts) == 4 and [c[0] for c in counts] == list(range(len(counts)))
    # The next run takes up where the last one stopped; a later capture of a bar wins.
    _send(spark, [("A", 0, 9.0), ("C", 3, 7.0)], topic)
    _drain(spark, lake, topic, max_files=1, counts=counts)
    assert _content(spark, silver_path) == [("A", 0, 9.0), ("A", 1, 2.0), ("B", 0, 5.0), ("C", 3, 7.0)]
    before = len(counts)
    _drain(spark, lake, topic, counts=counts)
    assert len(counts) == before
    audit = tables.read_table(spark, silver_path)
    assert audit.count() == audit.select("ticker", "timestamp").distinct().count()


def test_batch_run_twice_changes_nothing(spark, path):
    lake, topic = Lake(path), f"{path}/_topic"
    _send(spark, [("A", 0, 1.0), ("B", 0, 5.0)], topic)
    bronze_path, silver_path = _drain(spark, lake, topic)
    before = _content(spark, silver_path)
    # A new checkpoint replays all of bronze into the same table.
    silver.bars_to_silver(
        spark, bronze_path, silver_path, lake.checkpoint("silver", "bars", reader="again")
    ).awaitTermination()
    assert _content(spark, silver_path) == before


def test_avro_topics(spark, path):
    bars = _bars(spark, [("A", 0, 1.0), ("B", 1, 2.0)])
    encoded = encode_avro_bars(bars)
    for encoding, rows in (
        ("avro", encoded),
        ("framed", encoded.withColumn("value", frame(F.col("value"), 3))),
    ):
        topics.write_topic(rows, "stocks", path=f"{path}/{encoding}")
        table = f"{path}/table-{encoding}"
        bronze.topic_to_bronze(
            topics.stream_topic(spark, "stocks", path=f"{path}/{encoding}"),
            table,
            f"{path}/_checkpoint-{encoding}",
            encoding,
            partition_by=["ticker"],
        ).awaitTermination()
        got = tables.read_table(spark, table)
        assert sorted(map(tuple, got.select("ticker", "close").collect())) == [("A", 1.0), ("B", 2.0)]
        assert got.where("_capture_time_kafka is null or _capture_time_bronze is null").count() == 0


def test_stream_written_table_is_not_swapped(spark, path):
    """A table that a file sink of Spark's own writes belongs to the log of that sink."""
    spark.range(3).write.parquet(f"{path}/in")
    rows = spark.readStream.schema("id long").parquet(f"{path}/in")
    rows.writeStream.format("parquet").option("checkpointLocation", f"{path}/_c").trigger(availableNow=True).start(f"{path}/out").awaitTermination()
    with pytest.raises(ValueError, match="stream"):
        tables.publish(spark.range(1), f"{path}/out")
    with pytest.raises(ValueError, match="batches"):
        tables.append(spark.range(1), f"{path}/out", run="1")


def test_a_repeated_batch_leaves_the_same_bronze(spark, path):
    """The commit of a batch is lost after its rows were written: Spark runs it again."""
    lake, topic = Lake(path), f"{path}/_topic"
    _send(spark, [("A", 0, 1.0), ("B", 0, 5.0)], topic)
    topics.write_topic(spark.createDataFrame([(None, bytearray(b"no json"))], "key binary, value binary"), "stocks", path=topic)
    table, checkpoint = lake.path("bronze", "bars"), lake.checkpoint("bronze", "bars")
    for _ in range(2):
        bronze.topic_to_bronze(topics.stream_topic(spark, "stocks", path=topic), table, checkpoint).awaitTermination()
        assert tables.read_table(spark, table).count() == 2
        assert tables.read_table(spark, f"{table}/_rejects").count() == 1
        Storage(spark, path).delete(f"{checkpoint}/commits")
    # Another checkpoint is another run: its batch 0 does not take the place of this one's.
    bronze.topic_to_bronze(topics.stream_topic(spark, "stocks", path=topic), table, f"{checkpoint}-2").awaitTermination()
    assert tables.read_table(spark, table).count() == 4


def test_a_message_is_parsed_once(spark, path, monkeypatch):
    """Rows and rejects come from one plan with one from_json."""
    lake, topic, plans = Lake(path), f"{path}/_topic", []
    real = bronze.materialized

    def seen(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(bronze, "materialized", seen)
    _send(spark, [("A", 0, 1.0)], topic)
    bronze.topic_to_bronze(topics.stream_topic(spark, "stocks", path=topic), lake.path("bronze", "bars"), lake.checkpoint("bronze", "bars")).awaitTermination()
    assert len(plans) == 1 and plans[0].lower().count("from_json") == 1


@pytest.mark.parametrize("encoding", ["avro", "framed"])
def test_cut_avro_goes_to_the_rejects(spark, path, encoding):
    good = encode_avro_bars(_bars(spark, [("A", 0, 1.0), ("B", 1, 2.0)]))
    rows = good.unionByName(good.withColumn("value", F.expr("substring(value, 1, 12)")))
    rows = rows.withColumn("value", frame(F.col("value"), 3)) if encoding == "framed" else rows
    topics.write_topic(rows, "stocks", path=f"{path}/_topic")
    bronze.topic_to_bronze(topics.stream_topic(spark, "stocks", path=f"{path}/_topic"), f"{path}/t", f"{path}/_c", encoding, rejects=f"{path}/r").awaitTermination()
    assert sorted(r["ticker"] for r in tables.read_table(spark, f"{path}/t").collect()) == ["A", "B"]
    lost = tables.read_table(spark, f"{path}/r").collect()
    assert [r["reason"] for r in lost] == ["unreadable Avro"] * 2 and all(r["value"] for r in lost)


def test_append_by_run_may_be_repeated(spark, path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    for run, df in (("d1", rows), ("d2", rows.limit(1)), ("d1", rows.withColumn("extra", F.lit(1)))):
        tables.append(df, path, ["p"], run=run)
    got = tables.read_table(spark, path)
    assert got.columns == ["k", "p", "extra"] and got.count() == 3
    with pytest.raises(ValueError, match="named"):
        tables.append(rows, path, run="a/b")


def test_replay_names_topics_by_file(spark, path):
    header = "ticker,timestamp,open,high,low,close,volume\n"
    folder = tmp_files(spark, path, {
        "AAPL.2024.csv": header + "AAPL,2024-01-02 10:00:00,1.5,2,1,1.75,10\n",
        "MSFT.csv": header + "MSFT,2024-01-02 10:00:00,2.5,3,2,2.75,20\nMSFT,2024-01-02 10:01:00,2,2,2,2,5\n",
        "notes.txt": "not bars",
    })
    bronze.replay(spark, folder, f"{path}/_checkpoint", path=f"{path}/topics").awaitTermination()
    sent = topics.read_topic(spark, "MSFT", path=f"{path}/topics")
    got = decode_replay(sent).select("ticker", "description", "timestamp", "close", "volume").collect()
    assert sorted(map(tuple, got)) == [
        ("MSFT", None, "2024-01-02T10:00:00.000000Z", 2.75, 20),
        ("MSFT", None, "2024-01-02T10:01:00.000000Z", 2.0, 5),
    ]
    assert topics.read_topic(spark, "AAPL", path=f"{path}/topics").count() == 1


def tmp_files(spark, path, contents):
    from tidemark.sources.storage import Storage

    folder = f"{path}/files"
    for name, text in contents.items():
        Storage(spark, path).write_text(f"{folder}/{name}", text)
    return folder
