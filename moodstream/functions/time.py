"""Timestamp helpers. All arithmetic is done in integer microseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_FRACTION = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
ISO_WHOLE = "yyyy-MM-dd'T'HH:mm:ssxxx"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def utc_ts(col) -> Column:
    """TIMESTAMP (UTC instant) from TIMESTAMP, TIMESTAMP_NTZ or ISO-8601 text.

    Parquet timestamps without time zone load as TIMESTAMP_NTZ; under the
    UTC session the cast reads them as UTC wall time.
    """
    return _c(col).cast("timestamp")


def parse_iso(col) -> Column:
    """ISO-8601 text (with offset, optional fraction) to TIMESTAMP; bad → null."""
    return F.try_to_timestamp(_c(col))


def epoch_micros(col) -> Column:
    return F.unix_micros(utc_ts(col))


def from_micros(col) -> Column:
    return F.timestamp_micros(_c(col))


def iso_utc(col) -> Column:
    """UTC ISO-8601 text with ``+00:00``; the fraction is left out when zero,
    as Python's ``datetime.isoformat`` does."""
    ts = utc_ts(col)
    return F.when(ts.isNull(), F.lit(None).cast("string")).when(
        F.unix_micros(ts) % 1_000_000 == 0, F.date_format(ts, ISO_WHOLE)
    ).otherwise(F.date_format(ts, ISO_FRACTION))


def ms_between(start, end, digits: int | None = 1) -> Column:
    """Milliseconds from ``start`` to ``end``; null when either is missing."""
    ms = (epoch_micros(end) - epoch_micros(start)) / F.lit(1000.0)
    return F.round(ms, digits) if digits is not None else ms


def floor_micros(col, step_us: int) -> Column:
    """Epoch-aligned floor of a timestamp to a bucket of ``step_us`` micros."""
    us = epoch_micros(col)
    return us - F.pmod(us, F.lit(int(step_us)))
