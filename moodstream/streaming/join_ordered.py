"""TTL join of the raw and prediction topics in event time, in the order of the
events whatever the order of files and batches.

The result is that of ``operators.join_chains`` over the same halves. Per id the
state (RocksDB state store) is:

- ``buffer``: halves that the watermark has not passed, in any order;
- ``pending``: the half that waits for its partner;
- ``joined``: the time of the last join, kept for the dedupe period;
- ``due``: the one timer of the id, at the earliest time that one of these needs.

Halves only leave the buffer when the watermark has passed them. None that is
earlier can come any more (Spark drops it as late), so those that leave, sorted
by time, partition, offset and side, are the next stretch of the id's history:
a half joins the pending one of the other side less than ``ttl`` after it, is a
duplicate beside one of its own side or within ``dedupe`` of a join, and waits
otherwise. A half expires when the watermark has passed its time by ``ttl``.

An id's state holds what came within the watermark's delay, so the delay bounds
the buffer; a timer's work is one pass over it. Defined cases: a half without an
id or a time is not seen (the join contract sends it to the dead letters);
equal halves are duplicates of each other; other columns are ignored.
"""

from __future__ import annotations

from itertools import islice

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from moodstream.functions.time import epoch_micros
from moodstream.operators.joining import PREDICTION, RAW
from moodstream.schemas import RAW_TOPIC
from moodstream.streaming.join_stream import dedupe_period
from moodstream.streaming.join_timers import OUTCOMES as TIMER_OUTCOMES
from moodstream.streaming.join_timers import ROCKSDB

# Halves that go to the state store in one call.
CHUNK = 1000

HALF = T.StructType([
    T.StructField("t", T.LongType()), T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()),
    T.StructField("side", T.StringType()), T.StructField("topic", T.StringType()), T.StructField("payload", T.StringType())])
JOINED = T.StructType([T.StructField("t", T.LongType())])
DUE = T.StructType([T.StructField("ms", T.LongType())])
OUTCOMES = T.StructType([*TIMER_OUTCOMES.fields, T.StructField("at_us", T.LongType())])


def _order(half):
    return half[0], half[1] or 0, half[2] or 0, half[3]


class OrderedTtlJoin(StatefulProcessor):
    def __init__(self, ttl_seconds: float, dedupe_seconds: float):
        self.ttl, self.dedupe = (int(round(s * 1_000_000)) for s in (ttl_seconds, dedupe_seconds))
        self.ttl_text = repr(float(ttl_seconds))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buffer = handle.getListState("buffer", HALF)
        self.pending = handle.getValueState("pending", HALF)
        self.joined = handle.getValueState("joined", JOINED)
        self.due = handle.getValueState("due", DUE)

    def _wake(self, t: int) -> None:
        """Sees to it that the id's timer is not later than ``t`` (micros)."""
        ms = -(-t // 1000)
        held = self.due.get()[0] if self.due.exists() else None
        if held is None or ms < held:
            if held is not None:
                self.handle.deleteTimer(held)
            self.handle.registerTimer(ms)
            self.due.update((ms,))

    def _row(self, id_, outcome, t, half, raw=None, prediction=None, error=None):
        return Row(id=id_, outcome=outcome, raw_payload=raw, prediction_payload=prediction, at_ms=t // 1000, error=error,
                   topic=half[4], partition=half[1], offset=half[2], at_us=t)

    def _expired(self, id_, half):
        missing = PREDICTION if half[3] == RAW else RAW
        error = f"join_ttl_expired: no {missing} for id within {self.ttl_text}s"
        return self._row(id_, "expired", half[0] + self.ttl, half, half[5] if half[3] == RAW else None, half[5] if half[3] == PREDICTION else None, error)

    def handleInputRows(self, key, rows, timerValues):
        halves, first = ((r["t"], r["partition"], r["offset"], r["side"], r["topic"], r["payload"]) for r in rows), None
        while some := list(islice(halves, CHUNK)):
            self.buffer.appendList(some)
            least = min(h[0] for h in some)
            first = least if first is None else min(first, least)
        if first is not None:
            self._wake(first)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        # All halves up to here have come: timers run after the rows of a batch, and later ones are dropped as late.
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        ready, rest = [], []
        for h in self.buffer.get() if self.buffer.exists() else ():
            (ready if h[0] <= passed else rest).append(tuple(h))
        pending = tuple(self.pending.get()) if self.pending.exists() else None
        joined = self.joined.get()[0] if self.joined.exists() else None
        out = []
        for half in sorted(ready, key=_order):
            t, side = half[0], half[3]
            if pending is not None and t - pending[0] >= self.ttl:
                out.append(self._expired(key[0], pending))
                pending = None
            if joined is not None and t - joined >= self.dedupe:
                joined = None
            if joined is not None or (pending is not None and pending[3] == side):
                out.append(self._row(key[0], "duplicate", t, half))
            elif pending is None:
                pending = half
            else:
                raw, prediction = (pending, half) if side == PREDICTION else (half, pending)
                out.append(self._row(key[0], "joined", t, half, raw[5], prediction[5]))
                pending, joined = None, t
        if pending is not None and passed - pending[0] >= self.ttl:
            out.append(self._expired(key[0], pending))
            pending = None
        if joined is not None and passed - joined >= self.dedupe:
            joined = None

        self._keep(ready, rest, pending, joined)
        return iter(out)

    def _keep(self, ready, rest, pending, joined) -> None:
        if ready:
            self.buffer.clear()
            for k in range(0, len(rest), CHUNK):
                self.buffer.appendList(rest[k : k + CHUNK])
        for state, value in ((self.pending, pending), (self.joined, None if joined is None else (joined,))):
            if value is not None:
                state.update(value)
            else:
                state.clear()
        self.due.clear()
        needs = [h[0] for h in rest]
        if pending is not None:
            needs.append(pending[0] + self.ttl)
        if joined is not None:
            needs.append(joined + self.dedupe)
        if needs:
            self._wake(min(needs))

    def close(self) -> None:
        pass


def join_in_order(halves: DataFrame, ttl_seconds: float, delay_seconds: float, dedupe_seconds: float | None = None,
                  at_col: str = "at", raw_topic: str = RAW_TOPIC) -> DataFrame:
    """Outcome rows (``joined`` / ``duplicate`` / ``expired``) of a stream of
    halves of both topics (``id, payload, topic, partition, offset`` and their
    time ``at_col``), with the time of the outcome in ``at_us`` (of the join: its
    later half; of an expiry: the half's time plus ``ttl``).
    ``delay_seconds``: how far behind the newest half one may be; later ones
    are dropped. ``dedupe_seconds`` defaults to max(600, 5·ttl). The rows can
    be written by ``join_timers.start_timer_join``."""
    spark = halves.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        raise RuntimeError(f"timers need spark.sql.streaming.stateStore.providerClass={ROCKSDB}")
    dedupe = dedupe_seconds if dedupe_seconds is not None else dedupe_period(ttl_seconds)
    seen = halves.where(F.col("id").isNotNull() & F.col(at_col).isNotNull())
    keyed = seen.withWatermark(at_col, f"{round(delay_seconds * 1_000_000)} microseconds").select(
        "id", F.col(at_col), epoch_micros(at_col).alias("t"), F.col("partition").cast("int").alias("partition"), F.col("offset").cast("long").alias("offset"),
        F.when(F.col("topic") == F.lit(raw_topic), F.lit(RAW)).otherwise(F.lit(PREDICTION)).alias("side"), "topic",
        F.col("payload").cast("string").alias("payload"))
    return keyed.groupBy("id").transformWithState(OrderedTtlJoin(ttl_seconds, dedupe), OUTCOMES, "Append", "EventTime")
