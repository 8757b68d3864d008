"""Text of rows and values: delimited lines, JSON, HTML, time stamps in milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Replacements for text shown in a page, the ampersand first.
HTML_ESCAPES = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")]

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def html_escape(text: Column) -> Column:
    for raw, safe in HTML_ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def or_empty(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def csv_field(value: Column) -> Column:
    """Field of a delimited line: NULL is empty, special characters are quoted."""
    text = or_empty(value)
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike('[",\r\n]'), quoted).otherwise(text)


def csv_line(values: list[Column], separator: str = ",") -> Column:
    return F.concat_ws(separator, *[csv_field(v) for v in values])


def json_string(value: Column) -> Column:
    """The value as a JSON string literal, quotes included."""
    listed = F.to_json(F.array(or_empty(value)))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def to_millis(local_time: Column) -> Column:
    """Milliseconds since the epoch of a UTC wall clock time without zone."""
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH), local_time)


def to_micros(local_time: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), local_time)


def from_millis(millis: Column) -> Column:
    return F.timestamp_add("MILLISECOND", millis, F.expr(_EPOCH))
