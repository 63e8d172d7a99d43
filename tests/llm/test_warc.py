import hashlib

from pyspark.sql import functions as F

from tidemark.llm import warc

SCHEMA = "page_id long, url string, html string, node string, hash int"


def pages(spark, n, change=(), lose=(), extra=()):
    rows = [(k, f"http://x/{k}", f"<p>{'#' if k in change else ''}{k}</p>", "n", 1) for k in [*range(n), *extra] if k not in lose]
    return spark.createDataFrame(rows, SCHEMA)


def tree(df, name):
    return warc.tree(warc.manifest(df, "page_id", "url", "html"), name)


def test_audit_descends_to_the_damage_only(spark):
    a = tree(pages(spark, 3000), "a")
    b = tree(pages(spark, 3000, change=(17, 2100), lose=(2101,), extra=(3000,)), "b")
    bad, compared = warc.audit(a, b)
    rows = {r["node"]: r for r in bad.collect()}
    assert set(rows) == {17, 2100, 2101, 3000}
    assert rows[2101]["found"] is None and rows[3000]["expected"] is None
    record = lambda k, body: (
        f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{k}>\r\nWARC-Target-URI: http://x/{k}\r\n"
        f"Content-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r\n"
    )
    assert rows[17]["expected"] == hashlib.sha256(record(17, "<p>17</p>").encode()).hexdigest()
    assert rows[17]["found"] == hashlib.sha256(record(17, "<p>#17</p>").encode()).hexdigest()
    assert rows[17]["end"] - rows[17]["start"] == len(record(17, "<p>17</p>"))
    assert rows[17]["start"] == sum(len(record(k, f"<p>{k}</p>")) for k in range(17))
    # The root, what is right below it, and then at most FANOUT children of each of three branches.
    assert compared[0] == 1 and compared[1] <= warc.FANOUT and all(n <= 4 * warc.FANOUT for n in compared[2:])


def test_equal_replicas_have_equal_roots(spark):
    a, b = tree(pages(spark, 500), "a"), tree(pages(spark, 500).repartition(7), "b")
    assert a[-1].first()["hash"] == b[-1].first()["hash"]
    bad, compared = warc.audit(a, b)
    assert bad.count() == 0 and sum(compared) == 1


def test_odd_rows(spark):
    rows = [(1, None, None, "n", 1), (2, "u", "", "n", 1), (2, "u", "other", "n", 1), (None, "u", "x" * 100_000, "n", 1), (None, "u", "y", "n", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    a, b = tree(df, "a"), tree(df.orderBy(F.desc("html")), "b")
    assert a[-1].first()["hash"] == b[-1].first()["hash"]
    c = tree(df.filter("html is null or html != 'other'"), "c")
    assert [r["node"] for r in warc.audit(a, c)[0].collect()] == [2]
    none = tree(df.limit(0), "d")
    assert warc.audit(none, none)[0].count() == 0
    assert sorted(r["node"] for r in warc.audit(a, none)[0].collect()) == [-1, 1, 2]


def test_records_at_other_places_are_found(spark):
    stored = warc.write(pages(spark, 300), "page_id", "url", "html")
    a = warc.tree(warc.stored_manifest(stored), "a")
    size = {r["slot"]: (r["start"], r["end"] - r["start"]) for r in stored.collect()}

    def moved(start, name):
        at = start.cast("long")
        rows = stored.select("slot", "file", at.alias("start"), (at + F.octet_length("data")).alias("end"), "data")
        b = warc.tree(warc.stored_manifest(rows), name)
        assert a[-1].first()["hash"] != b[-1].first()["hash"]
        found = warc.audit(a, b)[0].collect()
        assert all(r["expected"] == r["found"] for r in found)
        return sorted(r["node"] for r in found)

    at = F.col("start")
    swapped = F.when(F.col("slot") == 50, at + size[51][1]).when(F.col("slot") == 51, F.lit(size[50][0])).otherwise(at)
    assert moved(swapped, "b") == [50, 51]
    assert moved(at + 10, "c") == [0]
    assert moved(F.when(F.col("slot") >= 70, at + 4).otherwise(at), "d") == [70]


def test_located_ranges_open_in_the_stored_bytes(spark):
    first = warc.write(pages(spark, 5000), "page_id", "url", "html")
    second = warc.write(pages(spark, 5000, change=(17, 4500)), "page_id", "url", "html")
    bad, _ = warc.audit(*[warc.tree(warc.stored_manifest(s), n) for s, n in ((first, "a"), (second, "b"))])
    rows = bad.collect()
    assert sorted((r["node"], r["file"]) for r in rows) == [(17, 0), (4500, 1)]
    for r in rows:
        data = warc.read_range(first, r["file"], r["start"], r["end"])
        assert hashlib.sha256(data).hexdigest() == r["expected"] and f"<p>{r['node']}</p>".encode() in data
    whole = sorted((r["start"], bytes(r["data"])) for r in first.filter("file = 1").collect())
    joined = b"".join(d for _, d in whole)
    assert warc.read_range(first, 1, 100, 5000) == joined[100:5000] and joined.count(b"WARC/1.1") == 5000 - 4096


def test_damaged_stored_bytes_are_found(spark):
    stored = warc.write(pages(spark, 100), "page_id", "url", "html")
    hurt = F.when(F.col("slot") == 40, F.concat(F.expr("substring(data, 1, 20)"), F.lit("!").cast("binary"), F.expr("substring(data, 22)"))).otherwise(F.col("data"))
    a, b = (warc.tree(warc.stored_manifest(s), n) for s, n in ((stored, "a"), (stored.withColumn("data", hurt), "b")))
    assert [r["node"] for r in warc.audit(a, b)[0].collect()] == [40]


def test_a_hot_id_is_spread(spark):
    """Half of all records have no id, a quarter are copies of one: offsets are without gaps, in the order of hashes."""
    rows = [(None, f"u{k}", "x" * (k % 50), "n", 1) for k in range(400)] + [(7, "same", "body", "n", 1)] * 200 + [(k, "u", "y", "n", 1) for k in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    stored = warc.write(df, "page_id", "url", "html").collect()
    assert len(stored) == len(rows)
    for file in {r["file"] for r in stored}:
        mine = sorted((r["start"], r["end"], r["slot"], hashlib.sha256(r["data"]).hexdigest()) for r in stored if r["file"] == file)
        assert [m[0] for m in mine] == [0, *[m[1] for m in mine[:-1]]]
        assert [m[2:] for m in mine] == sorted(m[2:] for m in mine)
