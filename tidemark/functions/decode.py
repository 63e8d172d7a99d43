"""Message payloads to columns and back."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field names and types of the messages this library reads and writes.
BAR_JSON = (
    "ticker string, timestamp string, open double, high double, low double, close double, volume bigint"
)
REPLAY_JSON = (
    "ticker string, description string, datetime string, openv double, highv double, lowv double, "
    "closev double, volume bigint"
)
REPLAY_NAMES = {
    "timestamp": "datetime",
    "open": "openv",
    "high": "highv",
    "low": "lowv",
    "close": "closev",
}
CDC_ENVELOPE = (
    "before struct<string:string>, after struct<string:string>, "
    "source struct<db:string, collection:string>, op struct<string:string>, ts_ms struct<long:bigint>"
)
CDC_DOCUMENT = (
    "_id struct<`$oid`:string>, ticker string, description string, timestamp struct<`$date`:bigint>, "
    "open double, high double, low double, close double, volume bigint"
)
FLAT_CHANGE = (
    "_id string, ticker string, description string, timestamp bigint, open double, high double, low double, "
    "close double, volume bigint, __op string, __collection string, __ts_ms bigint"
)
API_PAGE = "data array<struct<t:bigint, o:float, h:float, l:float, c:float, v:int>>"
FRAME_BYTES = 5

# Fixed value: the plain Avro record of a bar, as schema text.
BAR_AVRO = """{"type": "record", "name": "Stock", "fields": [
  {"name": "ticker", "type": "string"},
  {"name": "timestamp", "type": "string"},
  {"name": "open", "type": "double"},
  {"name": "high", "type": "double"},
  {"name": "low", "type": "double"},
  {"name": "close", "type": "double"},
  {"name": "volume", "type": "long"}]}"""


def utf8(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def rfc3339(ts: str) -> Column:
    """An instant as text with microseconds and a zone, so that parsing gives it back."""
    return F.date_format(F.col(ts).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


# ---- D3, D5, D6: JSON ---------------------------------------------------------------------------


def decode_json(df: DataFrame, schema: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The JSON value as columns; ``keep`` names message columns to carry along."""
    value = F.from_json(F.col("value").cast("string"), schema).alias("value")
    return df.select(value, *keep).select("value.*", *keep)


# ---- checked decoding -------------------------------------------------------------------------------
# A checked message keeps its columns and gets ``row``, what it decodes to, and ``reason``, why it does not. Both are
# NULL for what is meant to be dropped, as tombstones and deletes. The value is parsed once.

BROKEN = "_broken"


def _parsed(text: Column, schema: str) -> Column:
    """The JSON value as a struct that ends with the text itself where it does not fit the schema."""
    return F.from_json(text, f"{schema}, {BROKEN} string", {"columnNameOfCorruptRecord": BROKEN})


def _is_broken(parsed: str) -> Column:
    return F.col(parsed).isNull() | F.col(f"{parsed}.{BROKEN}").isNotNull()


def checked_json(messages: DataFrame, schema: str = BAR_JSON) -> DataFrame:
    """JSON objects that fit ``schema``; no value, no row."""
    parsed = messages.withColumn("_parsed", _parsed(F.col("value").cast("string"), schema))
    reason = F.when(F.col("value").isNotNull() & _is_broken("_parsed"), F.lit("unreadable JSON"))
    return _with_row(parsed, F.col("_parsed").dropFields(BROKEN), reason)


def _with_row(messages: DataFrame, row: Column, reason: Column) -> DataFrame:
    checked = messages.withColumn("reason", reason)
    there = F.col("reason").isNull() & F.col("value").isNotNull()
    return checked.withColumn("row", F.when(there, row)).drop("_parsed", "_document")


def checked_avro(messages: DataFrame) -> DataFrame:
    """Plain Avro bars; a payload that is cut or is something else has a reason."""
    decoded = messages.withColumn("_parsed", avro_value(messages.sparkSession))
    reason = F.when(F.col("value").isNotNull() & F.col("_parsed.ticker").isNull(), F.lit("unreadable Avro"))
    return _with_row(decoded, F.col("_parsed"), reason)


def checked_frame(messages: DataFrame, inside: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Messages behind registry framing, checked by ``inside`` without it; values that have none have a reason."""
    framed = F.substring("value", 1, 1) == F.unhex(F.lit("00"))
    framed = framed & (F.octet_length("value") >= FRAME_BYTES)
    whole = messages.withColumn("_value", F.col("value")).withColumn("_framed", F.coalesce(framed, F.col("value").isNull()))
    bare = unframe(whole).withColumn("value", F.when(F.col("_framed"), F.col("value")))
    checked = inside(bare).withColumn("reason", F.when(F.col("_framed"), F.col("reason")).otherwise("no frame"))
    return checked.withColumn("value", F.col("_value")).drop("_value", "_framed")


def checked_flat_changes(messages: DataFrame, schema: str = FLAT_CHANGE) -> DataFrame:
    """Flat change records behind registry framing."""
    checked = checked_frame(messages, lambda inner: checked_json(inner, schema))
    stamped = F.col("row").withField("timestamp", F.timestamp_millis(F.col("row.timestamp")))
    return checked.withColumn("row", F.when(F.col("row").isNotNull(), stamped.withField("schema_id", F.col("schema_id")))).drop("schema_id")


def checked_changes(messages: DataFrame) -> DataFrame:
    """Change messages: the document after the change, or why there is none.

    Tombstones and deletes have neither. An envelope that does not parse, has no operation or lacks the document,
    and a document that does not parse or has no ``_id``, each have their reason.
    """
    parsed = messages.withColumn("_parsed", _parsed(F.col("value").cast("string"), CDC_ENVELOPE))
    parsed = parsed.withColumn("_document", _parsed(F.col("_parsed.after.string"), CDC_DOCUMENT))
    op, after = F.col("_parsed.op.string"), F.col("_parsed.after.string")
    reason = (
        F.when(F.col("value").isNull(), F.lit(None))
        .when(_is_broken("_parsed"), "unreadable envelope")
        .when(op.isNull(), "no operation")
        .when(op == "d", F.lit(None))
        .when(after.isNull(), "no document")
        .when(_is_broken("_document"), "unreadable document")
        .when(F.col("_document._id").getField("$oid").isNull(), "no _id")
    )
    same = ("ticker", "description", "open", "high", "low", "close", "volume")
    field = {c: F.col(f"_document.{c}").alias(c) for c in same}
    row = F.struct(
        F.col("_document._id").getField("$oid").alias("_id"), field["ticker"], field["description"],
        F.timestamp_millis(F.col("_document.timestamp").getField("$date")).alias("timestamp"),
        *[field[c] for c in same[2:]], op.alias("__op"),
        F.col("_parsed.source.collection").alias("__collection"), F.col("_parsed.ts_ms.long").alias("__ts_ms"),
    )
    return _with_row(parsed, F.when(op != "d", row), reason)


def accepted(checked: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows of checked messages; ``keep`` names message columns to carry along."""
    return checked.where(F.col("row").isNotNull()).select("row.*", *keep)


def rejected_messages(checked: DataFrame) -> DataFrame:
    """The messages that do not decode, as they came, with the reason."""
    return checked.where(F.col("reason").isNotNull()).drop("row")


def decode_flat_changes(df: DataFrame, schema: str = FLAT_CHANGE) -> DataFrame:
    """The flat change record that a connector's unwrap leaves, behind registry framing.

    ``schema`` is the record's schema as text; all fields may be missing.
    """
    return accepted(checked_flat_changes(df, schema))


def encode_bars(df: DataFrame) -> DataFrame:
    """Key ``"{ticker} {timestamp}"`` and the bar as JSON."""
    stamped = df.withColumn("timestamp", rfc3339("timestamp"))
    return stamped.select(
        utf8(F.concat_ws(" ", "ticker", "timestamp")).alias("key"),
        utf8(
            F.to_json(F.struct("ticker", "timestamp", "open", "high", "low", "close", "volume"))
        ).alias("value"),
    )


def encode_replay(df: DataFrame, topic: str = "topic") -> DataFrame:
    """Renamed fields, no key, an empty description left out, the topic as a column."""
    fields = [
        F.col("ticker"),
        F.nullif(F.col("description"), F.lit("")).alias("description"),
        rfc3339("timestamp").alias(REPLAY_NAMES["timestamp"]),
        *[F.col(c).alias(REPLAY_NAMES[c]) for c in ("open", "high", "low", "close")],
        F.col("volume"),
    ]
    return df.select(
        F.lit(None).cast("binary").alias("key"),
        utf8(F.to_json(F.struct(*fields), {"ignoreNullFields": "true"})).alias("value"),
        F.col(topic).alias("topic"),
    )


def decode_replay(df: DataFrame) -> DataFrame:
    """D6 read back under the bar names."""
    named = decode_json(df, REPLAY_JSON)
    return named.withColumnsRenamed({new: old for old, new in REPLAY_NAMES.items()})


# ---- D2: registry framing -----------------------------------------------------------------------


def frame(payload: Column, schema_id: int) -> Column:
    """Put the magic byte and the four-byte schema id in front of a payload."""
    return F.concat(F.unhex(F.lit(f"00{schema_id:08X}")), payload)


def unframe(df: DataFrame) -> DataFrame:
    """Drop the five framing bytes and expose the schema id."""
    value = F.col("value")
    return df.withColumn(
        "schema_id", F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("int")
    ).withColumn("value", F.substring(value, FRAME_BYTES + 1, 2**31 - 1))


# ---- D1: plain Avro bars ------------------------------------------------------------------------


def has_avro(spark) -> bool:
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.avro.AvroDataToCatalyst")
        return True
    except Exception:
        return False


def _varint(data: bytes, at: int) -> tuple[int, int]:
    shift = number = 0
    while True:
        byte = data[at]
        at += 1
        number |= (byte & 0x7F) << shift
        if byte < 0x80:
            return (number >> 1) ^ -(number & 1), at
        shift += 7


def _zigzag(number: int) -> bytes:
    left = (number << 1) ^ (number >> 63)
    out = bytearray()
    while left > 0x7F:
        out.append(left & 0x7F | 0x80)
        left >>= 7
    out.append(left)
    return bytes(out)


def _bar_from_avro(data: bytes) -> tuple:
    size, at = _varint(data, 0)
    ticker = data[at : at + size].decode()
    size, at = _varint(data, at + size)
    stamp = data[at : at + size].decode()
    at += size
    prices = struct.unpack_from("<4d", data, at)
    volume, _ = _varint(data, at + 32)
    return (ticker, stamp, *prices, volume)


def _bar_to_avro(ticker: str, stamp: str, *rest) -> bytes:
    *prices, volume = rest
    texts = b"".join(_zigzag(len(t)) + t for t in (ticker.encode(), stamp.encode()))
    return texts + struct.pack("<4d", *prices) + _zigzag(int(volume))


BAR_NAMES = ["ticker", "timestamp", "open", "high", "low", "close", "volume"]
BAR_TYPES = [T.StringType()] * 2 + [T.DoubleType()] * 4 + [T.LongType()]
BAR_RECORD = T.StructType([T.StructField(n, t) for n, t in zip(BAR_NAMES, BAR_TYPES)])


@F.pandas_udf(BAR_RECORD)
def _avro_bars(values: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_readable_bar(v) for v in values], columns=BAR_NAMES)


def _readable_bar(data: bytes | None) -> tuple:
    """The bar, or nothing but NULLs where there is none or it is cut."""
    try:
        return _bar_from_avro(data)
    except (TypeError, IndexError, UnicodeDecodeError, struct.error):
        return (None,) * len(BAR_NAMES)


@F.pandas_udf(T.BinaryType())
def _bars_avro(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
    for rows in batches:
        yield pd.Series([_bar_to_avro(*row) for row in rows.itertuples(index=False)])


def avro_value(spark) -> Column:
    """The value as a bar: by the Avro module where the cluster has it, else by a small decoder of this one record.

    All fields are NULL if it cannot be read.
    """
    if not has_avro(spark):
        return _avro_bars("value")
    from pyspark.sql.avro.functions import from_avro

    return from_avro(F.col("value"), BAR_AVRO, {"mode": "PERMISSIVE"})


def decode_avro_bars(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Plain Avro bars to columns; null messages and those that cannot be read are dropped."""
    return accepted(checked_avro(df), keep)


def encode_avro_bars(df: DataFrame) -> DataFrame:
    """D5 in Avro: the bar as one plain Avro record, keyed like the JSON form."""
    stamped = df.withColumn("timestamp", rfc3339("timestamp"))
    row = F.struct(*BAR_NAMES)
    if has_avro(df.sparkSession):
        from pyspark.sql.avro.functions import to_avro

        value = to_avro(row, BAR_AVRO)
    else:
        value = _bars_avro(row)
    return stamped.select(
        utf8(F.concat_ws(" ", "ticker", "timestamp")).alias("key"), value.alias("value")
    )


# ---- D4: change data capture --------------------------------------------------------------------


def cdc_envelope(row: Column, op: Column, collection: str, ts_ms: Column | None = None) -> Column:
    """A change message around ``row`` (struct with ``_id`` and ``timestamp``); deletes carry no
    ``after``. The stamp travels as epoch microseconds in ``ts_ms`` only if given."""
    document = F.to_json(
        row.withField("_id", F.struct(row["_id"].alias("$oid"))).withField(
            "timestamp",
            F.struct(F.unix_millis(row["timestamp"].cast("timestamp")).alias("$date")),
        )
    )
    stamp = ts_ms if ts_ms is not None else F.unix_millis(row["timestamp"].cast("timestamp"))
    after = F.when(op != "d", F.struct(document.alias("string")))
    envelope = F.struct(
        after.alias("after"),
        F.struct(F.lit(collection).alias("collection")).alias("source"),
        F.struct(op.alias("string")).alias("op"),
        F.struct(stamp.alias("long")).alias("ts_ms"),
    )
    return utf8(F.to_json(envelope))


def unwrap_cdc(messages: DataFrame) -> DataFrame:
    """The document after each change, with ``__op``, ``__collection``, ``__ts_ms``.

    Tombstones and deletes are dropped, and so are broken messages, which ``checked_changes`` tells apart.
    """
    return accepted(checked_changes(messages))


# ---- S9: API pages ------------------------------------------------------------------------------


def bars_from_pages(pages: DataFrame) -> DataFrame:
    """Landed response pages (``ticker``, ``body``) to bars.

    Prices are 32-bit in the response and are widened to double; stamps are whole seconds.
    """
    item = F.explode(F.from_json("body", API_PAGE)["data"]).alias("i")
    return pages.select("ticker", item).select(
        "ticker",
        F.timestamp_seconds("i.t").alias("timestamp"),
        F.col("i.o").cast("double").alias("open"),
        F.col("i.h").cast("double").alias("high"),
        F.col("i.l").cast("double").alias("low"),
        F.col("i.c").cast("double").alias("close"),
        F.col("i.v").cast("bigint").alias("volume"),
    )
