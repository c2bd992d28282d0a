"""Negative-share spike detection over an exact sliding event-time window.

Semantics (per event, in event-time order ``(ts, seq)``):

- the window of event *i* holds the events *j ≤ i* with ``ts_j > ts_i − W``
  (left edge exclusive, right edge = the latest timestamp seen);
  ``window_start`` is the first timestamp inside it;
- the detector fires when ``total ≥ min_count`` and ``share ≥ threshold``
  while quiet, and resolves when ``total ≥ min_count`` and
  ``share < rearm_below`` while firing; below ``min_count`` nothing changes.

Plan: no single-task window over all events, nor over those of a key. Counts come from a
distributed ordered scan (``plans.ordered``): each event contributes a data
row at ``ts`` and a probe row at ``ts − W``; the window count is the
difference of two counts from the end. With keys, the scan starts anew at each
key's first row and a key with most of the rows spans many partitions. The firing state is a run-length problem:
inside fixed-size blocks of consecutive events only rows where the signal
changes survive; each of these finds the one before it by a distributed rank
and an equi-join, so no window runs over all of them.

``arrival_share`` is the same window in order of arrival, where late events
count from the moment they arrive if they are still inside.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodstream.functions.numeric import safe_div
from moodstream.functions.time import epoch_micros, from_micros, iso_utc, parse_iso
from moodstream.plans.ordered import first_time_after, running_totals, with_neighbour
from moodstream.schemas import SCHEMA_VERSION

ALERT_TYPE = "negative_spike"


@dataclass(frozen=True)
class SpikeParams:
    window_seconds: float = 60.0
    threshold: float = 0.4
    rearm_below: float | None = None
    min_count: int = 20

    def __post_init__(self):
        if self.rearm_below is None:
            object.__setattr__(self, "rearm_below", round(self.threshold * 0.8, 4))
        if not 0 <= self.rearm_below <= self.threshold <= 1:
            raise ValueError(f"rearm_below {self.rearm_below} and threshold {self.threshold} must be shares in this order")
        if self.window_seconds <= 0:
            raise ValueError("window_seconds must be positive")

    @property
    def window_us(self) -> int:
        return int(round(self.window_seconds * 1_000_000))


def _keyed(df: DataFrame, keys) -> tuple[list[Column], list[str], list[Column]]:
    """Keys under names of their own, those names, and the way back."""
    own = [f"_key{i}" for i in range(len(keys))]
    return [F.col(k).alias(o) for k, o in zip(keys, own, strict=True)], own, [F.col(o).alias(k) for k, o in zip(keys, own, strict=True)]


def sliding_share(df: DataFrame, window_seconds: float, ts_col: str = "predicted_at",
                  label_col: str = "label", seq_col: str = "seq",
                  negative_label: str = "negative",
                  num_partitions: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Per event: ``seq, window_start, window_end, total, negative,
    negative_share, order_desc`` (``order_desc`` = 1 for the last event).

    ``seq`` must be unique; it breaks ties between equal timestamps in
    arrival order. Events with a null timestamp are skipped. ``keys``: one
    stream per key, the columns of which come first in the result; a stream
    that holds most events is cut into pieces by time."""
    w_us = int(round(window_seconds * 1_000_000))
    given, own, back = _keyed(df, keys)
    ev = df.select(
        *given,
        F.col(seq_col).cast("long").alias("_seq"),
        epoch_micros(ts_col).alias("_t"),
        (F.col(label_col) == F.lit(negative_label)).cast("long").alias("_n"),
    ).where(F.col("_t").isNotNull())
    # From the last event to the first: sums over this row and all later ones; the least time so far is the next one.
    none = F.lit(0).cast("long")
    data = ev.select(*own, (-F.col("_t")).alias("_t"), F.lit(0).alias("_k"), (-F.col("_seq")).alias("_seq"), F.lit(1).cast("long").alias("_d"),
                     F.coalesce("_n", none).alias("_n"), (-F.col("_t")).alias("_ft"))
    probes = ev.select(*own, (F.lit(w_us) - F.col("_t")).alias("_t"), F.lit(-1).alias("_k"), (-F.col("_seq")).alias("_seq"), none.alias("_d"), none.alias("_n"),
                       F.lit(None).cast("long").alias("_ft"))
    scanned = running_totals(data.unionByName(probes), ["_t", "_k", "_seq"], ["_d", "_n"], ["_ft"], num_partitions, own)
    is_d, is_p = F.col("_k") == 0, F.col("_k") == -1
    per = scanned.groupBy(*own, "_seq").agg(
        F.max(F.when(is_d, -F.col("_t"))).alias("_t"),
        F.max(F.when(is_d, F.col("_n"))).alias("_self_n"),
        F.max(F.when(is_d, F.col("pre__d"))).alias("_sd"),
        F.max(F.when(is_p, F.col("pre__d"))).alias("_sp"),
        F.max(F.when(is_d, F.col("pre__n"))).alias("_nd"),
        F.max(F.when(is_p, F.col("pre__n"))).alias("_np"),
        F.max(F.when(is_p, -F.col("pre__ft"))).alias("_start"),
    )
    total = F.col("_sp") - F.col("_sd") + 1
    negative = F.col("_np") - F.col("_nd") + F.col("_self_n")
    return per.select(
        *back,
        (-F.col("_seq")).alias("seq"),
        from_micros("_start").alias("window_start"),
        from_micros("_t").alias("window_end"),
        total.alias("total"),
        negative.alias("negative"),
        safe_div(negative, total).alias("negative_share"),
        F.col("_sd").alias("order_desc"),
    )


def _arrivals(df: DataFrame, window_seconds: float, order_cols: list[str], ts_col: str, label_col: str, negative_label: str,
              num_partitions: int | None, keys: Sequence[str]) -> DataFrame:
    """The rows of ``arrival_share`` with keys as ``_key0`` ..., the row's own time ``_t`` and the edge ``_edge``."""
    w_us = int(round(window_seconds * 1_000_000))
    given, own, _ = _keyed(df, keys)
    none = F.lit(0).cast("long")
    ev = df.select(*given, *order_cols, epoch_micros(ts_col).alias("_t"),
                   F.coalesce((F.col(label_col) == F.lit(negative_label)).cast("long"), F.lit(0)).alias("_n")).where(F.col("_t").isNotNull())
    seen = running_totals(ev.withColumn("_one", F.lit(1).cast("long")), order_cols, ["_one"], ["_t"], num_partitions, own)
    seen = seen.select(*own, *order_cols, "_t", "_n", F.col("pre__one").alias("arrival"), F.col("pre__t").alias("_edge"))
    seen = seen.withColumn("_in", (F.col("_t") > F.col("_edge") - F.lit(w_us)).cast("long")).withColumn("_nin", F.col("_in") * F.col("_n"))
    kept = running_totals(seen, ["arrival"], ["_in", "_nin"], num_partitions=num_partitions, keys=own)
    # Each row is also a probe at its cutoff, which carries it through the scan in order of time.
    row = F.struct(*order_cols, "_t", "_edge", "pre__in", "pre__nin")
    probe = kept.select(*own, (F.col("_edge") - F.lit(w_us)).alias("_at"), F.lit(1).alias("_k"), "arrival", none.alias("_d"), none.alias("_m"), row.alias("_row"))
    point = kept.where("_in = 1").select(*own, F.col("_t").alias("_at"), F.lit(0).alias("_k"), "arrival", F.col("_in").alias("_d"), F.col("_nin").alias("_m"),
                                         F.lit(None).cast(probe.schema["_row"].dataType).alias("_row"))
    gone = running_totals(point.unionByName(probe), ["_at", "_k", "arrival"], ["_d", "_m"], num_partitions=num_partitions, keys=own).where("_k = 1")
    total, negative = F.col("_row.pre__in") - F.col("pre__d"), F.col("_row.pre__nin") - F.col("pre__m")
    return gone.select(*own, *[F.col(f"_row.{c}") for c in order_cols], "arrival", F.col("_row._t"), F.col("_row._edge"), from_micros("_row._edge").alias("window_end"),
                       total.alias("total"), negative.alias("negative"), safe_div(negative, total).alias("negative_share"))


def arrival_share(df: DataFrame, window_seconds: float, order_cols: list[str], ts_col: str = "predicted_at",
                  label_col: str = "label", negative_label: str = "negative", num_partitions: int | None = None,
                  keys: Sequence[str] = ()) -> DataFrame:
    """The window in order of arrival (``order_cols``, unique): the right edge
    is the latest time seen so far; a late event is counted from its arrival
    if it lies inside (edge − W, edge], and never otherwise. Adds to
    ``order_cols``: ``window_end, total, negative, negative_share`` and
    ``arrival`` (1-based place). ``keys``: one stream, with an edge of its own, per key.

    Let K be the events that were inside when they arrived. An event of K at
    or before a row's cutoff always arrived before that row, because cutoffs
    only grow. So a row's window is (K up to its arrival) minus (K up to its
    cutoff in time): running totals in order of arrival, and in order of time
    over K and one probe per row."""
    out = _arrivals(df, window_seconds, order_cols, ts_col, label_col, negative_label, num_partitions, keys)
    return out.select(*_keyed(df, keys)[2], *order_cols, "arrival", "window_end", "total", "negative", "negative_share")


def arrival_spikes(df: DataFrame, params: SpikeParams, order_cols: list[str], ts_col: str = "predicted_at",
                   label_col: str = "label", rows=None, firing: bool = False, block_rows: int = 1 << 20,
                   num_partitions: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Transitions of the detector in order of arrival, with ``window_start``.
    ``rows``: a condition on the rows that may raise one (the others only
    fill the window); ``firing``: the detector's state before them;
    ``keys``: one detector per key.

    The start of a window is the first time inside it among the events that
    had arrived. It is looked up for the transitions alone
    (``first_time_after``)."""
    _, own, back = _keyed(df, keys)
    win = _arrivals(df, params.window_seconds, order_cols, ts_col, label_col, "negative", num_partitions, keys).checkpoint()
    raised = transitions(win if rows is None else win.where(rows), params, "arrival", firing, block_rows, num_partitions, own).checkpoint()
    asks = raised.select(*own, (F.col("_edge") - F.lit(params.window_us)).alias("_t"), F.col("arrival").alias("_a"))
    starts = first_time_after(win.select(*own, "_t", F.col("arrival").alias("_a")), asks, own, num_partitions)
    starts = starts.select(*[F.col(o).alias(f"_of{i}") for i, o in enumerate(own)], F.col("_a").alias("_place"), "_found")
    same = F.col("arrival") == F.col("_place")
    for i, o in enumerate(own):
        same = same & F.col(o).eqNullSafe(F.col(f"_of{i}"))
    return raised.join(starts, same, "left").select(
        *back, *order_cols, "arrival", "status", F.coalesce(from_micros("_found"), F.col("window_end")).alias("window_start"),
        "window_end", "total", "negative", "negative_share")


def _signal(p: SpikeParams):
    enough = F.col("total") >= F.lit(p.min_count)
    share = F.col("negative_share")
    return F.when(enough & (share >= F.lit(p.threshold)), F.lit(1)) \
        .when(enough & (share < F.lit(p.rearm_below)), F.lit(-1))


def transitions(windows: DataFrame, params: SpikeParams, place_col: str, firing: bool = False,
                block_rows: int = 1 << 20, num_partitions: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """The rows of ``windows`` (with ``total``, ``negative_share`` and a
    1-based ``place_col``, per key if there are ``keys``) where the detector
    fires or resolves, with ``status``. ``firing``: its state before the first
    row."""
    keys = list(keys)
    sig = windows.withColumn("signal", _signal(params)).where(F.col("signal").isNotNull())
    # Per block of consecutive events, the first signal and every change.
    sig = sig.withColumn("_blk", F.floor((F.col(place_col) - 1) / F.lit(block_rows)))
    in_block = Window.partitionBy(*keys, "_blk").orderBy(place_col)
    runs = sig.withColumn("_prev", F.lag("signal").over(in_block)) \
        .where(F.col("_prev").isNull() | (F.col("_prev") != F.col("signal"))).drop("_prev", "_blk")
    paired = with_neighbour(runs, [*keys, place_col], ["signal", *keys], -1, num_partitions)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"near_{k}"))
    before = F.coalesce(F.when(same, F.col("near_signal")), F.lit(1 if firing else -1))
    return paired.where(F.col("signal") != before) \
        .withColumn("status", F.when(F.col("signal") == 1, F.lit("firing")).otherwise(F.lit("resolved"))) \
        .drop("signal", "near_signal", *[f"near_{k}" for k in keys])


def detect_spikes(df: DataFrame, params: SpikeParams, ts_col: str = "predicted_at",
                  label_col: str = "label", seq_col: str = "seq",
                  block_rows: int = 1 << 20, num_partitions: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Transitions of the hysteresis detector: ``seq, status, window_start,
    window_end, total, negative, negative_share`` (share unrounded).
    ``keys``: one detector per key, the columns of which come first."""
    win = sliding_share(df, params.window_seconds, ts_col, label_col, seq_col, num_partitions=num_partitions, keys=keys)
    # Places count from the end of the stream; negated they run with time.
    win = win.withColumn("_place", -F.col("order_desc"))
    out = transitions(win, params, "_place", block_rows=block_rows, num_partitions=num_partitions, keys=keys)
    return out.select(*keys, "seq", "status", "window_start", "window_end", "total", "negative", "negative_share")


def build_alerts(spikes: DataFrame, params: SpikeParams, with_ids: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Alert payload rows (V16): timestamps as UTC ISO text, share to 4 dp.
    ``alert_id``/``emitted_at`` are random/current and only added when
    ``with_ids``. ``keep``: columns to carry along, such as ``seq``, the order
    of alerts that end at one time."""
    cols = [
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        *([F.expr("uuid()").alias("alert_id")] if with_ids else []),
        F.lit(ALERT_TYPE).alias("type"),
        F.col("status"),
        iso_utc("window_start").alias("window_start"),
        iso_utc("window_end").alias("window_end"),
        F.lit(float(params.window_seconds)).alias("window_seconds"),
        F.col("total").cast("long").alias("total"),
        F.col("negative").cast("long").alias("negative"),
        F.round("negative_share", 4).alias("negative_share"),
        F.lit(float(params.threshold)).alias("threshold"),
        F.lit(int(params.min_count)).cast("long").alias("min_count"),
        *([iso_utc(F.current_timestamp()).alias("emitted_at")] if with_ids else []),
        *keep,
    ]
    return spikes.select(*cols)


def _times(alerts: DataFrame) -> DataFrame:
    text = dict(alerts.dtypes).get("window_end") == "string"
    return alerts.withColumn("_end", parse_iso("window_end") if text else F.col("window_end").cast("timestamp"))


def alert_intervals(alerts: DataFrame, partition_cols: list[str] | None = None, tie_cols: tuple[str, ...] = ("seq",),
                    num_partitions: int | None = None) -> DataFrame:
    """Pairs each ``firing`` alert with the next ``resolved`` one:
    ``start, end, peak_share, threshold, window_seconds``; an alert still
    open has ``end`` null. Repeated statuses are ignored.

    ``window_end`` may be ISO text (the alert sink) or a timestamp. Alerts
    are ordered by it and then by the ``tie_cols`` that they have (the
    order in which they were raised). ``partition_cols``: one alert stream
    per key. Both neighbours are found by rank (``with_neighbour``)."""
    keys = partition_cols or []
    order = [*keys, "_end", *[c for c in tie_cols if c in alerts.columns]]
    own = {k: f"_key{i}" for i, k in enumerate(keys)}
    a = _times(alerts).where(F.col("status").isin("firing", "resolved"))
    a = a.select("*", *[F.col(k).alias(v) for k, v in own.items()])
    same = F.lit(True)
    for k, v in own.items():
        same = same & F.col(k).eqNullSafe(F.col(f"near_{v}"))
    carried = list(own.values())
    changes = with_neighbour(a, order, ["status", *carried], -1, num_partitions)
    before = F.coalesce(F.when(same, F.col("near_status")), F.lit("resolved"))
    changes = changes.where(F.col("status") != before).drop("near_status", *[f"near_{v}" for v in carried])
    paired = with_neighbour(changes, order, ["_end", *carried], 1, num_partitions)
    return paired.where(F.col("status") == "firing").select(
        *keys,
        F.col("_end").alias("start"),
        F.when(same, F.col("near__end")).alias("end"),
        F.col("negative_share").cast("double").alias("peak_share"),
        F.col("threshold").cast("double").alias("threshold"),
        F.col("window_seconds").cast("double").alias("window_seconds"),
    )


def alert_status(alerts: DataFrame, tie_cols: tuple[str, ...] = ("seq",)) -> DataFrame:
    """One row: ``fired`` (firing alerts so far) and ``last_threshold`` (of
    the newest alert; null without alerts)."""
    newest = F.struct("_end", *[c for c in tie_cols if c in alerts.columns])
    return _times(alerts).agg(F.count_if(F.col("status") == "firing").alias("fired"),
                              F.max_by(F.col("threshold").cast("double"), newest).alias("last_threshold"))
