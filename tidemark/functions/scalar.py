"""Column expressions shared by the jobs. All are built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_cancelled(invoice: str = "InvoiceNo") -> Column:
    """a leading capital C marks a cancellation; a small c does not."""
    return F.coalesce(F.left(invoice, F.lit(1)) == "C", F.lit(False))


def invoice_type(invoice: str = "InvoiceNo") -> Column:
    """``C`` for a cancellation, ``I`` for everything else, NULL included."""
    return F.when(is_cancelled(invoice), "C").otherwise("I")


def invoice_number(invoice: str = "InvoiceNo") -> Column:
    """the number without its mark; NULL when what is left is no number."""
    bare = F.when(is_cancelled(invoice), F.substring(invoice, 2, 2**31 - 1)).otherwise(F.col(invoice))
    return bare.try_cast("bigint")


def day_key(ts: str) -> Column:
    """the day as ``yyyy-MM-dd`` text."""
    return F.date_format(ts, "yyyy-MM-dd")


def time_parts(ts: str) -> dict[str, Column]:
    """year to minute as integers, named as the event tables name them."""
    return {
        "ano": F.year(ts),
        "mes": F.month(ts),
        "dia": F.dayofmonth(ts),
        "hora": F.hour(ts),
        "minuto": F.minute(ts),
    }


def parse_timestamp(text: str) -> Column:
    """text to instant, NULL when it does not parse; offsets are honored.

    One-digit parts (``2020-1-5 3:7``) parse through the cast, which accepts them.
    """
    return F.col(text).try_cast("timestamp")


def parse_date(text: str) -> Column:
    """F8: the date of a timestamp text, NULL when it does not parse."""
    return F.col(text).try_cast("timestamp").cast("date")


def rejected(parsed: Column, text: str) -> Column:
    """True where a non-null input failed to parse, to be counted beside F3 and F7."""
    return F.col(text).isNotNull() & parsed.isNull()


def from_epoch_millis(ms: str) -> Column:
    """epoch milliseconds to an instant, milliseconds kept."""
    return F.timestamp_millis(F.col(ms))


def shift_hours(ts: Column, hours: int) -> Column:
    """a fixed shift, whatever the zone rules of the day."""
    return ts + F.make_dt_interval(hours=F.lit(hours))


def to_zone(ts: str, zone: str) -> Column:
    """F10 by zone name: the wall clock in ``zone`` of a UTC instant."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(ts).cast("timestamp_ntz"))


def seconds_between(earlier: str, later: str) -> Column:
    """whole seconds from one stamp to the next, each floored first."""
    unix = lambda c: F.unix_timestamp(F.col(c).cast("timestamp"))
    return (unix(later) - unix(earlier)).cast("int")


def minute_stamp(ano="ano", mes="mes", dia="dia", hora="hora", minuto="minuto") -> Column:
    """the minute that five integer parts name."""
    return F.make_timestamp_ntz(
        F.col(ano), F.col(mes), F.col(dia), F.col(hora), F.col(minuto), F.lit(0)
    )


def code_name(code: str, names: dict[int, str], otherwise: str) -> Column:
    """code to name; every code not listed gets the catch-all."""
    pairs = [(F.col(code) == value, name) for value, name in names.items()]
    chain = F.when(*pairs[0])
    for condition, name in pairs[1:]:
        chain = chain.when(condition, name)
    return chain.otherwise(otherwise)
