"""Fixity audit of WARC replicas by Merkle trees.

A replica is stored as rows, one for each WARC record: its file, its offsets there and its bytes; a file is the bytes of its
rows in the order of their offsets. The audit reads these rows: hashes and lengths are those of the stored bytes, and
``read_range`` opens a range of offsets that it names.

A leaf hashes the file, the place, the length and the SHA-256 of its slot's bytes. The place is the distance from the furthest end
of the slots before it in the file, so that equal leaves mean equal offsets, and yet a longer record does not make all that
follow it differ. A node of the next level covers an ordered range of ``FANOUT`` slots below it: its hash is that of its
children's hashes with their numbers, and it knows the range of file offsets under it. Levels
follow until at most ``FANOUT`` nodes are left, whose hash is the root. Replicas with equal roots have the same records at the
same offsets. Else the audit goes down from the root, level by level, and looks only at children of nodes that differ, down
to the records. One with the same bytes at another place has equal hashes: where a file is shifted, that is the first one.

A file holds ``FILE_RECORDS`` slots. Its offsets come from narrow rows, one for each different record with its hash, size and
number of copies: prefix sums within a slot and the first digits of the hash, then over the totals of these, so that an id with
a third of all records is spread like any other. The bytes are shuffled once, by file, slot and hash, and meet their offset
there; no task has a whole file. The audit shuffles hashes and offsets only, and a group of its tree never has more than
``FANOUT`` rows.

Defined cases: null urls and bodies are empty; records of one id share a slot, whose leaf then does not depend on their
order; records with a null id have slot -1. An empty replica has no nodes, and two of them are equal. Other columns are
ignored; long bodies are hashed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import text as texts
from tidemark.shared import scratch_path

FANOUT = 16
FILE_RECORDS = 4096
HEAD_DIGITS = 3  # of the hash, by which the records of one slot are spread


def record(key: Column, url: Column, body: Column) -> Column:
    """The bytes of a response record."""
    body = F.encode(F.coalesce(body, F.lit("")), "UTF-8")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(key.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(F.encode(head, "UTF-8"), body, F.encode(F.lit("\r\n\r\n"), "UTF-8"))


def write(pages: DataFrame, key: str, url: str, body: str) -> DataFrame:
    """Store the records, in files of consecutive slots, and return them as (slot, file, start, end, data) read from there.

    Records of one slot follow each other by their SHA-256, equal ones are copies of one row.
    """
    rows = pages.select(F.coalesce(F.col(key).cast("long"), F.lit(-1)).alias("slot"), record(F.col(key), F.col(url), F.col(body)).alias("data"))
    rows = rows.withColumn("file", F.floor(F.col("slot") / FILE_RECORDS)).withColumn("sha", F.sha2("data", 256))
    same = ["file", "slot", "sha"]
    offsets = _offsets(rows.groupBy(*same, F.octet_length("data").cast("long").alias("size")).agg(F.count("*").alias("copies")))
    placed = rows.groupBy(*same).agg(F.first("data").alias("data")).join(offsets, same)
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy")
    placed = placed.select("slot", "file", "first", "size", "data", copy).withColumn("start", F.col("first") + F.col("copy") * F.col("size"))
    placed = placed.select("slot", "file", "start", (F.col("start") + F.col("size")).alias("end"), "data")
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    placed.write.option("compression", "zstd").parquet(path)
    spark.sparkContext._jvm.System.gc()  # drops the shuffle files, see texts.stored
    return spark.read.schema(placed.schema).parquet(path)


def _offsets(records: DataFrame) -> DataFrame:
    """(file, slot, sha, size, copies, first): where the first copy of each record begins in its file."""
    records = texts.stored(records.withColumn("head", F.substring("sha", 1, HEAD_DIGITS)).withColumn("bytes", F.col("size") * F.col("copies")), "warc-records")
    part = ["file", "slot", "head"]
    inside = Window.partitionBy(*part).orderBy("sha").rowsBetween(Window.unboundedPreceding, 0)
    over = Window.partitionBy("file").orderBy("slot", "head").rowsBetween(Window.unboundedPreceding, 0)
    totals = records.groupBy(*part).agg(F.sum("bytes").alias("bytes"))
    totals = totals.select(*part, (F.sum("bytes").over(over) - F.col("bytes")).alias("before"))
    within = records.withColumn("within", F.sum("bytes").over(inside) - F.col("bytes"))
    found = within.join(totals, part).select("file", "slot", "sha", "size", "copies", (F.col("before") + F.col("within")).alias("first"))
    return texts.stored(found, "warc-offsets")


def read_range(stored: DataFrame, file: int, start: int, end: int) -> bytes:
    """The bytes from ``start`` up to ``end`` of a stored file, zeros where nothing stands."""
    out = bytearray(end - start)
    for r in stored.filter((F.col("file") == file) & (F.col("start") < end) & (F.col("end") > start)).orderBy("start").toLocalIterator():
        low, high = max(start, r["start"]), min(end, r["end"])
        out[low - start : high - start] = r["data"][low - r["start"] : high - r["start"]]
    return bytes(out)


def stored_manifest(stored: DataFrame) -> DataFrame:
    """(slot, file, start, end, sha256) of the stored bytes of each slot."""
    rows = stored.select("slot", "file", "start", F.octet_length("data").cast("long").alias("size"), F.sha2("data", 256).alias("sha256"))
    # Records of one slot are summed up before the offsets, so that a file's rows are bounded by its slots.
    part = lambda i: F.conv(F.substring("sha256", i, 15), 16, 10).cast("decimal(20,0)")
    slots = rows.groupBy("file", "slot").agg(
        F.count("*").alias("n"), F.min("start").alias("start"), F.max(F.col("start") + F.col("size")).alias("end"),
        F.max("sha256").alias("one"), *[F.sum(part(1 + 15 * i)).alias(f"p{i}") for i in range(4)],
    )
    several = F.sha2(F.concat_ws(":", "n", *[F.col(f"p{i}").cast("string") for i in range(4)]), 256)
    return slots.select("slot", "file", "start", "end", F.when(F.col("n") == 1, F.col("one")).otherwise(several).alias("sha256"))


def manifest(pages: DataFrame, key: str, url: str, body: str) -> DataFrame:
    """The manifest of the pages once they are stored."""
    return stored_manifest(write(pages, key, url, body))


def tree(records: DataFrame, name: str) -> list[DataFrame]:
    """The levels from the records up to the root: (node, hash, file, start, end), the last with node 0 only.

    The first has the SHA-256 of the bytes as well.
    """
    before = Window.partitionBy("file").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    place = F.col("start") - F.coalesce(F.max("end").over(before), F.lit(0))
    leaf = F.sha2(F.concat_ws(":", *[c.cast("string") for c in (F.col("file"), place, F.col("end") - F.col("start"), F.col("sha256"))]), 256)
    leaves = records.select(F.col("slot").alias("node"), leaf.alias("hash"), "file", "start", "end", "sha256")
    levels = [texts.stored(leaves, f"{name}0")]
    while levels[-1].count() > FANOUT:
        levels.append(texts.stored(_above(levels[-1], F.floor(F.col("node") / FANOUT)), f"{name}{len(levels)}"))
    return [*levels, texts.stored(_above(levels[-1], F.lit(0).cast("long")), f"{name}root")]


def _above(level: DataFrame, node: Column) -> DataFrame:
    children = F.array_sort(F.collect_list(F.struct("node", "hash")))
    grouped = level.withColumn("parent", node).groupBy("parent").agg(
        children.alias("children"), F.min("file").alias("file"), F.min("start").alias("start"), F.max("end").alias("end")
    )
    text = F.array_join(F.transform("children", lambda c: F.concat(c["node"].cast("string"), F.lit(":"), c["hash"])), "\n")
    return grouped.select(F.col("parent").alias("node"), F.sha2(text, 256).alias("hash"), "file", "start", "end")


def _differing(a: DataFrame, b: DataFrame, shown: str = "hash") -> DataFrame:
    left = a.select("node", F.col(shown).alias("expected"), "hash", "file", "start", "end")
    right = b.select("node", F.col(shown).alias("found"), F.col("hash").alias("hash_b"), F.col("file").alias("file_b"), F.col("start").alias("start_b"), F.col("end").alias("end_b"))
    both = left.join(right, "node", "full").filter(~F.col("hash").eqNullSafe(F.col("hash_b")))
    return both.select("node", "expected", "found", *[F.coalesce(c, f"{c}_b").alias(c) for c in ("file", "start", "end")])


def audit(a: list[DataFrame], b: list[DataFrame]) -> tuple[DataFrame, list[int]]:
    """The records that differ, with hashes and offsets, and how many nodes of each level were compared on the way down."""
    depth = max(len(a), len(b))

    def level(levels: list[DataFrame], k: int) -> DataFrame:
        if k < len(levels) - 1:
            return levels[k]
        # A lower tree goes on upwards until both are of one height.
        return _above(level(levels, k - 1), F.floor(F.col("node") / FANOUT)) if k < depth - 1 else levels[-1]

    bad = _differing(a[-1], b[-1])
    compared = [1]
    for k in range(depth - 2, -1, -1):
        parent = F.lit(0).cast("long") if k == depth - 2 else F.floor(F.col("node") / FANOUT)
        parents = bad.select(F.col("node").alias("parent"))
        under = lambda t: t.withColumn("parent", parent).join(parents, "parent", "left_semi").drop("parent")  # noqa: B023, E731
        left, right = under(level(a, k)), under(level(b, k))
        compared.append(left.select("node").union(right.select("node")).distinct().count())
        bad = texts.stored(_differing(left, right, "hash" if k else "sha256"), f"differing{k}")
    return bad, compared


CHANGED, LOST = (97, 13), (211, 7)


def op4_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged records of a second copy of all pages, in which some bodies got a byte more and some records are gone."""
    pages = texts.table(spark, sf_dir, "pages")
    hurt = lambda rule: F.coalesce(F.col("page_id") % rule[0] == rule[1], F.lit(False))
    body = F.when(hurt(CHANGED), F.concat(F.coalesce("html", F.lit("")), F.lit("\0"))).otherwise(F.col("html"))
    copy = pages.filter(~hurt(LOST)).select("page_id", "url", body.alias("html"))
    trees = [tree(manifest(p, "page_id", "url", "html"), n) for p, n in ((pages, "first"), (copy, "second"))]
    bad, _ = audit(*trees)
    status = F.when(F.col("found").isNull(), "lost").when(F.col("expected").isNull(), "extra").when(F.col("expected") == F.col("found"), "moved").otherwise("changed")
    return bad.select(F.col("node").alias("page_id"), "file", F.col("start").alias("start_offset"), F.col("end").alias("end_offset"), "expected", "found", status.alias("status"))


OP4_SQL = f"""
with records as (
  select page_id, cast(floor(page_id / {FILE_RECORDS}) as bigint) as file,
         'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
         || page_id || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
         || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' as head,
         chr(13) || chr(10) || chr(13) || chr(10) as gap, coalesce(html, '') as body
  from pages),
written as (
  select *, head || strlen(body) || gap || body || gap as a,
         head || (strlen(body) + 1) || gap || body || chr(0) || gap as b
  from records),
placed as (
  select *, cast(sum(strlen(a)) over (partition by file order by page_id rows unbounded preceding) as bigint) as end_offset
  from written)
select page_id, file, end_offset - strlen(a) as start_offset, end_offset, sha256(a) as expected,
       case when page_id % {LOST[0]} = {LOST[1]} then null else sha256(b) end as found,
       case when page_id % {LOST[0]} = {LOST[1]} then 'lost' else 'changed' end as status
from placed where page_id % {LOST[0]} = {LOST[1]} or page_id % {CHANGED[0]} = {CHANGED[1]}"""
