"""Scalar functions on text, time, maps and tagged payloads."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.columns import as_column

VALUE_TYPE = "struct<kind:string,s:string,i:int,ts:timestamp_ntz>"
STRING_KIND = "string"
INT_KIND = "int"
DATETIME_KIND = "datetime"
OTHER_KIND = "other"

_INT_MIN, _INT_MAX = -(1 << 31), (1 << 31) - 1

# The Unicode white space characters.
WHITESPACE = (
    "\t\n\v\f\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Spark upper-cases by full case mapping, where one character may become
# several; the invariant rule maps one to one. These are the characters where
# the two differ, found by rule, each with its one-to-one result. The dotless i
# and the long s, which the invariant rule leaves alone, are added.
_UNCHANGED = "ıſ"
_SIMPLE_UPPER = {
    c: c.title() if len(c.title()) == 1 else c
    for c in map(chr, range(0x80, 0x10000))
    if not 0xD800 <= ord(c) <= 0xDFFF and len(c.upper()) > 1
} | {c: c for c in _UNCHANGED}
_SPECIAL_CHARS = "".join(_SIMPLE_UPPER)
_STAND_INS = "".join(chr(0x100000 + i) for i in range(len(_SIMPLE_UPPER)))
_SPECIAL_RESULTS = "".join(_SIMPLE_UPPER.values())


def trim_whitespace(value: Column | str) -> Column:
    """Strip every Unicode white space character from both ends."""
    return F.btrim(as_column(value), F.lit(WHITESPACE))


def upper_invariant(value: Column | str, full: Column | None = None) -> Column:
    """Upper case by one-to-one mapping, so that sharp s stays as it is.

    Only text that full mapping would lengthen, or that holds one of the
    excluded letters, takes the longer way. ``full`` may be a column that
    already holds ``upper(value)``.
    """
    value = as_column(value)
    full = F.upper(value) if full is None else full
    special = F.length(full) != F.length(value)
    for letter in _UNCHANGED:
        special = special | F.contains(value, F.lit(letter))
    kept = F.translate(F.upper(F.translate(value, _SPECIAL_CHARS, _STAND_INS)), _STAND_INS, _SPECIAL_RESULTS)
    return F.when(special, kept).otherwise(full)


def to_utc(timestamp: Column | str, zone: str) -> Column:
    """Wall clock time of ``zone`` as UTC wall clock time."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), as_column(timestamp))


def month_filter(timestamp: Column | str, month: int) -> Column:
    """True in the given calendar month of any year."""
    return F.month(as_column(timestamp)) == month


def day_filter(timestamp: Column | str, day: str) -> Column:
    """True on one day; a range test on the bare column, so it reaches the scan."""
    start = F.to_timestamp_ntz(F.lit(day), F.lit("yyyy-MM-dd"))
    timestamp = as_column(timestamp)
    return (timestamp >= start) & (timestamp < start + F.expr("INTERVAL 1 DAY"))


def temperature_f(celsius: Column | str) -> Column:
    """Fahrenheit from whole degrees Celsius, truncated toward zero."""
    return F.lit(32) + (as_column(celsius) / F.lit(0.5556)).cast("int")


def map_default(mapping: Column | str, key: str, default: Column | None = None) -> Column:
    """Value of ``key``, or ``default`` when the key is missing or null."""
    found = F.try_element_at(as_column(mapping), F.lit(key))
    return found if default is None else F.coalesce(found, default)


def new_id() -> Column:
    """A random identifier; differs on every evaluation."""
    return F.uuid()


def stable_id(*business_key: Column | str) -> Column:
    """An identifier that is the same whenever the business key is."""
    parts = [F.coalesce(as_column(part).cast("string"), F.lit("")) for part in business_key]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def processed_label(item: Column | str) -> Column:
    """``Processed <item>``."""
    return F.concat(F.lit("Processed "), as_column(item).cast("string"))


def progress_json(fields: Iterable[str]) -> Column:
    """JSON text of the named columns, nulls included."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _tagged(kind: str, s: Column | None = None, i: Column | None = None, ts: Column | None = None) -> Column:
    payload = next(part for part in (s, i, ts) if part is not None)
    fields = F.struct(
        F.lit(kind).alias("kind"),
        (F.lit(None) if s is None else s).cast("string").alias("s"),
        (F.lit(None) if i is None else i).cast("int").alias("i"),
        (F.lit(None) if ts is None else ts).cast("timestamp_ntz").alias("ts"),
    )
    return F.when(payload.isNotNull(), fields)


def tag_string(value: Column | str) -> Column:
    """Tagged payload holding text; null for null."""
    return _tagged(STRING_KIND, s=as_column(value))


def tag_int(value: Column | str) -> Column:
    """Tagged payload holding an int; null for null."""
    return _tagged(INT_KIND, i=as_column(value))


def tag_datetime(value: Column | str) -> Column:
    """Tagged payload holding a time; null for null."""
    return _tagged(DATETIME_KIND, ts=as_column(value))


def tag_other(value: Column | str) -> Column:
    """Tagged payload of any other type, kept as text; null for null."""
    return _tagged(OTHER_KIND, s=as_column(value))


def value_text(value: Column | str) -> Column:
    """A tagged payload as text."""
    value = as_column(value)
    return F.coalesce(
        value["s"], value["i"].cast("string"), F.date_format(value["ts"], "yyyy-MM-dd'T'HH:mm:ss")
    )


def transform_by_type(df: DataFrame, payload: str, output: str, zone: str = "UTC") -> DataFrame:
    """Text: trimmed and upper-cased; int: doubled; time: to UTC; else unchanged.

    An int whose double does not fit is null in the ``i`` field; a range test
    finds it, as ``try_`` arithmetic throws and catches an exception per such
    row. The trimmed and the upper-cased text are columns of their own, so that
    each is computed once per row.
    """
    value = F.col(payload)
    kind = value["kind"]
    doubled = F.when(value["i"].between(_INT_MIN // 2, _INT_MAX // 2), value["i"] * 2)
    return (
        df.withColumn("_clean", F.when(kind == STRING_KIND, trim_whitespace(value["s"])))
        .withColumn("_upper", F.upper("_clean"))
        .withColumn(
            output,
            F.when(
                value.isNotNull(),
                F.struct(
                    kind.alias("kind"),
                    F.when(kind == STRING_KIND, upper_invariant("_clean", F.col("_upper")))
                    .otherwise(value["s"])
                    .alias("s"),
                    F.when(kind == INT_KIND, doubled).otherwise(value["i"]).alias("i"),
                    F.when(kind == DATETIME_KIND, to_utc(value["ts"], zone)).otherwise(value["ts"]).alias("ts"),
                ),
            ),
        )
        .drop("_clean", "_upper")
    )


def transform_failed(before: Column | str, after: Column | str) -> Column:
    """True where an int payload was lost by :func:`transform_by_type`."""
    before, after = as_column(before), as_column(after)
    return F.coalesce((before["kind"] == INT_KIND) & before["i"].isNotNull() & after["i"].isNull(), F.lit(False))
