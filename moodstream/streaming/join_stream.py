"""Joining the raw stream to the prediction stream by id, live.

Event-time form (pure Catalyst): both sides get a watermark and are
deduplicated by id within it (a redelivered half must not join twice), then
a full outer stream-stream join on id with ``|t_pred − t_raw| < ttl``. A
row with one side null is an expired half; Spark emits it once the
watermark has passed its TTL, i.e. when later events arrive.

``start_join_stream`` writes the joined rows as JSON lines and the expired
halves to the dead-letter folder, from one micro-batch each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodstream.functions.time import ms_between
from moodstream.operators.contracts import STAGE_JOIN, source_struct
from moodstream.operators.joining import PREDICTION, RAW, contract_payload, expired_error
from moodstream.schemas import JOINED, PREDICTIONS_TOPIC, RAW_TOPIC, SCHEMA_VERSION
from moodstream.schemas import PREDICTION as PREDICTION_SCHEMA
from moodstream.schemas import RAW as RAW_SCHEMA
from moodstream.session import stream_checkpoint
from moodstream.streaming.commits import commit_batch


def dedupe_period(ttl_seconds: float) -> float:
    """How long an id is remembered: five TTLs, ten minutes at least."""
    return max(600.0, 5 * ttl_seconds)


def join_streams(raw: DataFrame, predictions: DataFrame, ttl_seconds: float,
                 raw_ts: str = "produced_at", pred_ts: str = "predicted_at",
                 delay_seconds: float | None = None) -> DataFrame:
    """Full outer stream-stream join; raw columns prefixed ``r_``,
    prediction columns ``p_``. ``delay_seconds`` is the allowed lateness of
    each side's watermark and how long ids are remembered against
    redelivery (default ``dedupe_period``); an expired half comes out when
    the watermark has passed it by the TTL."""
    micros = lambda s: f"{round(s * 1_000_000)} microseconds"
    delay = micros(dedupe_period(ttl_seconds) if delay_seconds is None else delay_seconds)
    r = raw.withWatermark(raw_ts, delay).dropDuplicatesWithinWatermark(["id"])
    p = predictions.withWatermark(pred_ts, delay).dropDuplicatesWithinWatermark(["id"])
    r = r.select(*[F.col(c).alias(f"r_{c}") for c in r.columns])
    p = p.select(*[F.col(c).alias(f"p_{c}") for c in p.columns])
    ttl = F.expr(f"INTERVAL '{ttl_seconds:.6f}' SECOND")
    cond = (F.col("r_id") == F.col("p_id")) & \
        (F.col(f"p_{pred_ts}") > F.col(f"r_{raw_ts}") - ttl) & \
        (F.col(f"p_{pred_ts}") < F.col(f"r_{raw_ts}") + ttl)
    return r.join(p, cond, "full_outer")


def joined_rows(j: DataFrame, raw_ts: str = "produced_at", pred_ts: str = "predicted_at") -> DataFrame:
    """Both halves present → joined record (joined at the later half), all
    fields of the contract; null where a half does not have one."""
    both = j.where(F.col("r_id").isNotNull() & F.col("p_id").isNotNull())
    joined_at = F.greatest(F.col(f"r_{raw_ts}"), F.col(f"p_{pred_ts}"))
    made = {"schema_version": F.lit(SCHEMA_VERSION), "id": F.col("r_id"), "joined_at": joined_at,
            "produced_at": F.col(f"r_{raw_ts}"), "predicted_at": F.col(f"p_{pred_ts}"),
            "end_to_end_ms": ms_between(F.col(f"r_{raw_ts}"), joined_at, 1)}
    cols = []
    for f in JOINED.fields:
        side = "r_" if f.name in ("text", "source", "source_id") else "p_"
        value = made.get(f.name)
        if value is None:
            value = F.col(side + f.name) if side + f.name in j.columns else F.lit(None).cast(f.dataType)
        cols.append(value.alias(f.name))
    return both.select(*cols)


def expired_rows(j: DataFrame, ttl_seconds: float) -> DataFrame:
    """One side null → complete DLQ row: contract fields of the half as JSON,
    its source coordinates where the half carries them, and the time."""
    def half(prefix: str, missing: str, topic: str, contract):
        has = [c.removeprefix(prefix) for c in j.columns if c.startswith(prefix)]
        at = lambda c, default: F.col(prefix + c) if c in has else F.lit(default)
        return F.struct(
            expired_error(missing, ttl_seconds).alias("error"),
            contract_payload(prefix, has, contract.fieldNames()).alias("original_payload"),
            source_struct(at("topic", topic), at("partition", None), at("offset", None)).alias("source"),
            F.col(prefix + "id").alias("id"))

    alone = j.where(F.col("r_id").isNull() | F.col("p_id").isNull())
    row = F.when(F.col("p_id").isNull(), half("r_", PREDICTION, RAW_TOPIC, RAW_SCHEMA)) \
        .otherwise(half("p_", RAW, PREDICTIONS_TOPIC, PREDICTION_SCHEMA))
    return alone.select(row.alias("_x")).select(
        F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(STAGE_JOIN).alias("stage"), "_x.error", "_x.original_payload",
        "_x.source", F.current_timestamp().alias("failed_at"), "_x.id")


def start_join_stream(j: DataFrame, ttl_seconds: float, joined_dir: str | None = None, dlq_dir: str | None = None, query_name: str = "join",
                      trigger: dict | None = None, commits: str | None = None):
    """Starts the sinks of a ``join_streams`` frame: JSON lines of joined
    rows and Parquet of DLQ rows, one folder per batch id, so a batch that is
    run again replaces its own output. With ``commits``, a folder, both go
    there in one commit a batch (tables ``joined`` and ``dlq``) with their counts."""
    def run(batch: DataFrame, batch_id: int):
        b = batch.persist()
        joined, lost = joined_rows(b), expired_rows(b, ttl_seconds).drop("id")
        if commits:
            commit_batch(commits, batch_id, {"joined": (joined, "json"), "dlq": (lost, "parquet")})
        else:
            joined.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{joined_dir}/batch_id={batch_id}")
            lost.write.mode("overwrite").parquet(f"{dlq_dir}/batch_id={batch_id}")
        b.unpersist()

    w = j.writeStream.queryName(query_name).foreachBatch(run) \
        .option("checkpointLocation", stream_checkpoint(j.sparkSession, query_name))
    return w.trigger(**(trigger or {"availableNow": True})).start()
