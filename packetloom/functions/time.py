"""Column functions for timestamps, latency and key texts. They need a UTC session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from packetloom.functions.text import WHITESPACE

COMPACT_FORMATS = ["yyyyMMdd'T'HHmmss", "yyyyMMdd'T'HHmmssXXX", "yyyyMMdd'T'HHmmssXX"]
ISO_TEXT = "yyyy-MM-dd'T'HH:mm:ssxxx"


def iso_time(c: Column) -> Column:
    """Timestamp of ISO-8601 text; no offset means UTC, text that does not parse gives null."""
    text = F.trim(c.cast("string"), F.lit(WHITESPACE))
    # A text of digits alone is a year for Spark, but no ISO date.
    dated = F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.try_to_timestamp(text))
    compact = [F.try_to_timestamp(text, F.lit(f)) for f in COMPACT_FORMATS]
    return F.coalesce(dated, *compact)


def iso_text(ts: Column) -> Column:
    """ISO-8601 text with offset and whole seconds."""
    return F.date_format(ts, ISO_TEXT)


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from start to end, not below zero; null if either is null."""
    seconds = (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)
    return F.when(seconds.isNotNull(), F.greatest(F.lit(0.0), seconds))


def seconds_since_window_end(window_end: Column, at: Column) -> Column:
    return seconds_between(iso_time(window_end), at)


def duration_text(c: Column) -> Column:
    """'12.3s' below a minute, '2m 3.4s' above, 'n/a' without a number."""
    seconds = c.try_cast("double")
    seconds = F.when(~F.isnan(seconds), seconds)
    minutes = F.floor(seconds / 60)
    return (
        F.when(seconds.isNull(), "n/a")
        .when(seconds < 60, F.concat(one_decimal(seconds), F.lit("s")))
        .otherwise(F.concat(minutes.cast("string"), F.lit("m "), one_decimal(seconds - minutes * 60), F.lit("s")))
    )


def one_decimal(c: Column) -> Column:
    """One digit after the point. A format pattern rounds the binary value half to
    even, as printf in C does; format_string would round its decimal text half up."""
    return F.call_function("format_number", c, F.lit("0.0"))


def window_key(window_id: Column, start: Column) -> Column:
    """Key of a capture window, and name of its document."""
    return F.format_string("window_%06d_%s.json", window_id, F.date_format(start, "yyyyMMdd_HHmmss"))


def fallback_window_key(stream_file: Column, source_file: Column, batch_id: int) -> Column:
    """stream_file, else the name of the file read, else a name from the batch number."""
    given = F.when(stream_file != "", stream_file)
    return F.coalesce(given, source_file, F.lit(f"window_{batch_id:06d}"))
