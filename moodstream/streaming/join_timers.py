"""Processing-time TTL join of the raw and prediction topics (exact stream
semantics of the in-memory join buffer, as keyed state with timers).

Per id (state lives in the query checkpoint, RocksDB state store):

- ``pending``: the one half waiting for its partner (side, arrival ms,
  payload, source coordinates);
- ``joined``: a marker written at join time with a state TTL of
  ``dedupe_seconds``, so a redelivered half within that time is a
  duplicate and afterwards waits again alone;
- a processing-time timer at arrival + TTL. It fires on a quiet stream
  too, and expires the pending half (``age ≥ ttl``) into the DLQ.

Within a micro-batch, rows of one id are handled in arrival order
(partition, offset). One query reads both topics; the side comes from the
topic name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from moodstream.operators.contracts import STAGE_JOIN
from moodstream.schemas import SCHEMA_VERSION
from moodstream.session import stream_checkpoint
from moodstream.streaming.commits import commit_batch
from moodstream.streaming.join_stream import dedupe_period

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

PENDING = T.StructType([
    T.StructField("side", T.StringType()), T.StructField("arrived_ms", T.LongType()),
    T.StructField("payload", T.StringType()), T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType())])
JOINED = T.StructType([T.StructField("joined_ms", T.LongType())])

OUTCOMES = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("outcome", T.StringType()),
    T.StructField("raw_payload", T.StringType()), T.StructField("prediction_payload", T.StringType()),
    T.StructField("at_ms", T.LongType()), T.StructField("error", T.StringType()),
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType())])

RAW, PREDICTION = "raw", "prediction"


class TtlJoin(StatefulProcessor):
    def __init__(self, ttl_seconds: float, dedupe_seconds: float):
        self.ttl_ms = int(round(ttl_seconds * 1000))
        self.dedupe_ms = int(round(dedupe_seconds * 1000))
        self.ttl_text = repr(float(ttl_seconds))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getValueState("pending", PENDING)
        self.joined = handle.getValueState("joined", JOINED, self.dedupe_ms)

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        id_ = key[0]
        out = []
        for r in sorted(rows, key=lambda x: (x["partition"] or 0, x["offset"] or 0)):
            if self.joined.exists() or (self.pending.exists() and self.pending.get()[0] == r["side"]):
                out.append(Row(id=id_, outcome="duplicate", raw_payload=None, prediction_payload=None,
                               at_ms=now, error=None, topic=r["topic"], partition=r["partition"],
                               offset=r["offset"]))
            elif self.pending.exists():
                side, arrived, payload, *_ = self.pending.get()
                raw_p, pred_p = (payload, r["payload"]) if side == RAW else (r["payload"], payload)
                self.handle.deleteTimer(arrived + self.ttl_ms)
                self.pending.clear()
                self.joined.update((now,))
                out.append(Row(id=id_, outcome="joined", raw_payload=raw_p, prediction_payload=pred_p,
                               at_ms=now, error=None, topic=r["topic"], partition=r["partition"],
                               offset=r["offset"]))
            else:
                self.pending.update((r["side"], now, r["payload"], r["topic"], r["partition"], r["offset"]))
                self.handle.registerTimer(now + self.ttl_ms)
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if not self.pending.exists():
            return iter([])
        side, arrived, payload, topic, partition, offset = self.pending.get()
        self.pending.clear()
        missing = PREDICTION if side == RAW else RAW
        return iter([Row(id=key[0], outcome="expired",
                         raw_payload=payload if side == RAW else None,
                         prediction_payload=payload if side == PREDICTION else None,
                         at_ms=timerValues.getCurrentProcessingTimeInMs(),
                         error=f"join_ttl_expired: no {missing} for id within {self.ttl_text}s",
                         topic=topic, partition=partition, offset=offset)])

    def close(self) -> None:
        pass


def join_with_timers(messages: DataFrame, ttl_seconds: float = 300.0, dedupe_seconds: float | None = None,
                     raw_topic: str = "reviews.raw") -> DataFrame:
    """Outcome rows (``joined`` / ``duplicate`` / ``expired``) of a stream of
    parsed keyed messages (``id, payload, topic, partition, offset``; rows
    that failed the join contract should go to the DLQ before this).
    ``dedupe_seconds`` defaults to max(600, 5·ttl)."""
    spark = messages.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        raise RuntimeError(f"timers need spark.sql.streaming.stateStore.providerClass={ROCKSDB}")
    dedupe = dedupe_seconds if dedupe_seconds is not None else dedupe_period(ttl_seconds)
    keyed = messages.select(
        "id", F.when(F.col("topic") == F.lit(raw_topic), F.lit(RAW)).otherwise(F.lit(PREDICTION)).alias("side"),
        F.col("payload").cast("string").alias("payload"), "topic",
        F.col("partition").cast("int").alias("partition"), F.col("offset").cast("long").alias("offset"))
    return keyed.groupBy("id").transformWithState(
        TtlJoin(ttl_seconds, dedupe), OUTCOMES, "Append", "ProcessingTime")


def outcome_dlq(outcomes: DataFrame) -> DataFrame:
    """DLQ rows of the expired halves (payload as received)."""
    return outcomes.where(F.col("outcome") == "expired").select(
        F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(STAGE_JOIN).alias("stage"), "error",
        F.coalesce("raw_payload", "prediction_payload").alias("original_payload"),
        F.struct("topic", "partition", "offset").alias("source"),
        F.timestamp_millis("at_ms").alias("failed_at"))


def start_timer_join(outcomes: DataFrame, commits: str, query_name: str = "timer_join", trigger: dict | None = None):
    """Starts the sinks of ``join_with_timers``: joined pairs and the DLQ of
    expired halves in one commit a batch, with the counters of a run (joined,
    expired, duplicates)."""
    def run(batch: DataFrame, batch_id: int):
        b = batch.persist()
        pairs = b.where(F.col("outcome") == "joined").select("id", "raw_payload", "prediction_payload", F.timestamp_millis("at_ms").alias("joined_at"))
        counts = b.agg(*[F.count_if(F.col("outcome") == k).alias(name) for k, name in (("expired", "expired"), ("duplicate", "duplicates"))])
        commit_batch(commits, batch_id, {"joined": (pairs, "parquet"), "dlq": (outcome_dlq(b), "parquet")}, counts)
        b.unpersist()

    w = outcomes.writeStream.queryName(query_name).foreachBatch(run) \
        .option("checkpointLocation", stream_checkpoint(outcomes.sparkSession, query_name))
    return w.trigger(**(trigger or {"processingTime": "1 second"})).start()
