"""Dashboard tables over joined predictions (``id, label, predicted_at,
end_to_end_ms, model_version, ...``)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodstream.functions.numeric import safe_div
from moodstream.functions.time import epoch_micros, floor_micros, from_micros
from moodstream.plans.calendar import time_grid
from moodstream.plans.ordered import percentiles_row
from moodstream.plans.scalar import attach_row
from moodstream.plans.sweep import covering
from moodstream.schemas import LABELS
from moodstream.session import checkpoint_dir

# Bucket sizes offered by the dashboard (seconds), default 30 s.
FREQS = {"10s": 10, "30s": 30, "1min": 60, "5min": 300}
# Time ranges offered by the dashboard (minutes before the newest row), default All.
RANGES = {"All": None, "5 min": 5, "30 min": 30, "2 h": 120}

# Columns of the dashboard tables (latest reviews, alerts).
LATEST_COLUMNS = ["label", "confidence", "text"]
ALERT_COLUMNS = ["status", "window_end", "negative", "total", "negative_share", "threshold"]


def bucket_counts(df: DataFrame, freq_seconds: int = 30, ts_col: str = "predicted_at",
                  label_col: str = "label", id_col: str = "id") -> DataFrame:
    """Long form ``bucket, label, count, total, negative_share``; every bucket
    between the first and last one is present (zeros included) for every
    label. The range covers all rows with a bucket and a label, even labels
    outside the domain, which are not counted in ``total``. Rows with a null
    id are not counted.

    One shuffle on the bucket (partial aggregation first). The per-bucket
    counts are checkpointed: they give the range of the calendar, which is
    generated in chunks, and are joined to it.
    """
    checkpoint_dir(df.sparkSession)
    step = int(freq_seconds) * 1_000_000
    b = df.select(floor_micros(ts_col, step).alias("bucket_us"), F.col(label_col).alias("_l"),
                  F.col(id_col).alias("_id")) \
        .where(F.col("bucket_us").isNotNull() & F.col("_l").isNotNull())
    per = b.groupBy("bucket_us").agg(
        *[F.count(F.when(F.col("_l") == F.lit(lab), F.col("_id"))).alias(f"_n{i}")
          for i, lab in enumerate(LABELS)]).checkpoint()
    return fill_counts(per, step)


def fill_counts(per: DataFrame, step: int) -> DataFrame:
    """``bucket_counts`` from one row per bucket that occurs: ``bucket_us`` and
    ``_n0, _n1, ...``, the counts of the labels in their fixed order."""
    bounds = per.agg(F.min("bucket_us").alias("_lo"), F.max("bucket_us").alias("_hi"))
    grid = time_grid(bounds, "_lo", "_hi", step)
    full = grid.join(per, "bucket_us", "left").na.fill(0, [f"_n{i}" for i in range(len(LABELS))])
    total = sum((F.col(f"_n{i}") for i in range(1, len(LABELS))), F.col("_n0"))
    neg = F.col(f"_n{LABELS.index('negative')}")
    wide = full.select("bucket_us", *[f"_n{i}" for i in range(len(LABELS))],
                       total.alias("total"), safe_div(neg, total).alias("negative_share"))
    long = wide.select(
        from_micros("bucket_us").alias("bucket"),
        F.inline(F.array(*[F.struct(F.lit(lab).alias("label"), F.col(f"_n{i}").cast("long").alias("count"))
                           for i, lab in enumerate(LABELS)])),
        F.col("total").cast("long").alias("total"), "negative_share")
    return long


def label_ordinal(col: str = "label") -> Column:
    """Stacking order of a label: its 0-based place in the fixed label
    order; null for a label outside the domain."""
    pos = F.array_position(F.array(*[F.lit(x) for x in LABELS]), F.col(col))
    return F.when(pos > 0, pos - 1)


def sort_counts(counts: DataFrame) -> DataFrame:
    """Bucket counts in display order ``(bucket, label)``."""
    return counts.orderBy("bucket", "label")


def share_overlay(counts: DataFrame, intervals: DataFrame, freq_seconds: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Negative share per bucket with the alert intervals covering it:
    ``bucket, negative_share, total, alert_start, alert_end, peak_share``
    (alert columns null outside every interval; one row per interval where
    several overlap). ``keys``: intervals and buckets of one stream each.

    An interval still open ends at the last bucket of its key. The condition
    ``start ≤ bucket ≤ end`` is answered by a sweep over both in order of time
    (``plans.sweep``), so its work follows the rows that come out. The buckets
    are taken as they are; ``freq_seconds`` is only accepted for earlier callers.
    """
    keys = list(keys)
    share = counts.where(F.col("label") == F.lit("negative")) \
        .select(*keys, epoch_micros("bucket").alias("bucket_us"), "negative_share", "total")
    last = share.groupBy(*keys).agg(F.max("bucket_us").alias("_last_us"))
    if keys:
        own = last.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_last_us")
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
        ended = intervals.join(own, same, "left")
    else:
        ended = attach_row(intervals, last)
    spans = ended.select(*keys, epoch_micros("start").alias("_lo"), F.coalesce(epoch_micros("end"), F.col("_last_us")).alias("_hi"), "peak_share")
    return covering(share, spans, "bucket_us", "_lo", "_hi", keys).select(
        *keys, from_micros("bucket_us").alias("bucket"), "negative_share", "total",
        from_micros("_lo").alias("alert_start"), from_micros("_hi").alias("alert_end"), "peak_share")


def alert_table(alerts: DataFrame) -> DataFrame:
    """Alert table of the dashboard: its fixed columns, newest first."""
    return alerts.select(*ALERT_COLUMNS).orderBy(F.col("window_end").desc())


def kpis(df: DataFrame, label_col: str = "label", latency_col: str = "end_to_end_ms",
         version_col: str = "model_version") -> DataFrame:
    """One row: ``total``, ``{label}_share`` per label (over rows with a
    label, unknown labels in the denominator), exact ``p50_latency_ms`` /
    ``p95_latency_ms`` (linear interpolation; null without latencies) and
    the sorted distinct ``model_versions``."""
    lat = df.select(F.col(latency_col).cast("string").try_cast("double").alias("_lat"))
    base = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[safe_div(F.count_if(F.col(label_col) == F.lit(lab)), F.count(label_col)).alias(f"{lab}_share")
          for lab in LABELS],
    )
    pct = percentiles_row(lat, "_lat", {"p50_latency_ms": 0.5, "p95_latency_ms": 0.95})
    return attach_row(attach_row(base, version_list(df, version_col)), pct)


def version_list(df: DataFrame, version_col: str = "model_version") -> DataFrame:
    """One row: the sorted distinct versions (a display list). Repeats go in a
    distributed ``distinct``; only one row per version is gathered."""
    return df.select(version_col).where(F.col(version_col).isNotNull()).distinct() \
        .agg(F.array_sort(F.collect_list(version_col)).alias("model_versions"))


def label_shares(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Label distribution: ``label, count, share`` (share of rows with a label)."""
    counts = df.where(F.col(label_col).isNotNull()).groupBy(F.col(label_col).alias("label")) \
        .agg(F.count(F.lit(1)).alias("count"))
    n = counts.agg(F.sum("count").alias("_n"))
    return attach_row(counts, n) \
        .select("label", "count", (F.col("count") / F.col("_n")).alias("share"))


def latest(df: DataFrame, n: int = 15, ts_col: str = "predicted_at",
           columns: list[str] | None = None, tie_col: str = "id") -> DataFrame:
    """The ``n`` most recent rows (a top-k: TakeOrderedAndProject)."""
    cols = columns or LATEST_COLUMNS
    return df.orderBy(F.col(ts_col).desc_nulls_last(), F.col(tie_col).desc()).limit(n).select(*cols)


def last_minutes(df: DataFrame, minutes: float, ts_col: str = "predicted_at") -> DataFrame:
    """Rows with ``ts ≥ max(ts) − minutes``: the right edge is the data, not
    the clock. The max is a scalar subquery (run once, no join)."""
    cut = int(round(minutes * 60 * 1_000_000))
    edge = df.agg(F.timestamp_micros(F.max(epoch_micros(ts_col)) - F.lit(cut)).alias("_edge"))
    return df.where(F.col(ts_col) >= edge.scalar())


def time_range(df: DataFrame, choice: str = "All", ts_col: str = "predicted_at") -> DataFrame:
    """Rows inside one of the dashboard's ``RANGES`` (``All`` keeps every row)."""
    minutes = RANGES[choice]
    return df if minutes is None else last_minutes(df, minutes, ts_col)


def sort_by_time(df: DataFrame, ts_col: str = "predicted_at") -> DataFrame:
    return df.orderBy(F.col(ts_col).asc_nulls_last())
