"""Joining each raw review to its prediction by id, with a TTL and
duplicate handling (batch form; the stream forms are in
``moodstream.streaming.join_stream``).

Batch semantics (event time = arrival time of each half):

- per id and side, the first-arrived half wins (ordered by arrival time,
  then offset); every other half of that side is a *duplicate*;
- the two first halves join when both exist and arrived less than
  ``ttl`` apart; ``joined_at`` is the arrival of the later half;
- otherwise every first half that exists *expires* and goes to the DLQ as
  ``join_ttl_expired: no {other side} for id within {ttl}s``.

Plan: one ``groupBy(id)`` per side with ``min_by`` (partial aggregation, so
a hot id with many redeliveries is combined map-side), then a full outer
join of two frames with at most one row per id on each side — no key can be
skewed in the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodstream.functions.time import epoch_micros, iso_utc, ms_between
from moodstream.operators.contracts import STAGE_JOIN, source_struct
from moodstream.schemas import PREDICTION as PREDICTION_SCHEMA
from moodstream.schemas import PREDICTIONS_TOPIC, RAW_TOPIC, SCHEMA_VERSION
from moodstream.schemas import RAW as RAW_SCHEMA

RAW, PREDICTION = "raw", "prediction"


def _ttl_text(ttl_seconds: float) -> str:
    return repr(float(ttl_seconds))


def _firsts(df: DataFrame, id_col: str, ts_col: str, offset_col: str, prefix: str,
            tie_cols: tuple[str, ...] = ()) -> DataFrame:
    payload = F.struct(*[F.col(c) for c in df.columns if c not in tie_cols])
    order = F.struct(F.col(ts_col).isNull(), epoch_micros(ts_col), F.col(offset_col),
                     *[F.col(c) for c in tie_cols])
    return df.groupBy(F.col(id_col).alias("id")).agg(
        F.min_by(payload, order).alias(prefix),
        F.count(F.lit(1)).alias(f"n_{prefix}"),
    )


def join_reviews(raw: DataFrame, predictions: DataFrame, ttl_seconds: float,
                 id_col: str = "id", raw_ts: str = "produced_at", pred_ts: str = "predicted_at",
                 offset_col: str = "offset", tie_cols: tuple[str, ...] = ()) -> DataFrame:
    """One row per id: ``id, raw, prediction`` (first halves as structs,
    null when absent), ``n_raw, n_prediction`` (arrivals per side),
    ``joined`` and ``joined_at`` (timestamp of the later half).

    Arrival order is (timestamp, offset, *tie_cols*); ``tie_cols`` break
    ties where offsets repeat and are left out of the payload."""
    r = _firsts(raw, id_col, raw_ts, offset_col, RAW, tuple(c for c in tie_cols if c in raw.columns))
    p = _firsts(predictions, id_col, pred_ts, offset_col, PREDICTION,
                tuple(c for c in tie_cols if c in predictions.columns))
    j = r.join(p, "id", "full_outer")
    t_raw = epoch_micros(F.col(f"{RAW}.{raw_ts}"))
    t_pred = epoch_micros(F.col(f"{PREDICTION}.{pred_ts}"))
    ttl_us = int(round(ttl_seconds * 1_000_000))
    joined = F.col(RAW).isNotNull() & F.col(PREDICTION).isNotNull() & \
        (F.abs(t_pred - t_raw) < F.lit(ttl_us))
    return j.select(
        "id", RAW, PREDICTION,
        F.coalesce(F.col(f"n_{RAW}"), F.lit(0)).alias(f"n_{RAW}"),
        F.coalesce(F.col(f"n_{PREDICTION}"), F.lit(0)).alias(f"n_{PREDICTION}"),
        F.coalesce(joined, F.lit(False)).alias("joined"),
        F.when(joined, F.timestamp_micros(F.greatest(t_raw, t_pred))).alias("joined_at"),
    )


def build_joined(pairs: DataFrame, raw_ts: str = "produced_at", pred_ts: str = "predicted_at") -> DataFrame:
    """Joined rows (V15): raw fields, prediction fields, ``joined_at`` and
    ``end_to_end_ms`` (produce → join, 1 dp; null without ``produced_at``)."""
    rf = lambda c: F.col(f"{RAW}.{c}")
    pf = lambda c: F.col(f"{PREDICTION}.{c}")
    raw_cols = pairs.schema[RAW].dataType.fieldNames()
    pred_cols = pairs.schema[PREDICTION].dataType.fieldNames()
    opt = lambda getter, names, c, t="string": getter(c) if c in names else F.lit(None).cast(t)
    return pairs.where("joined").select(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.col("id"),
        opt(rf, raw_cols, "text").alias("text"),
        opt(rf, raw_cols, "source").alias("source"),
        opt(rf, raw_cols, "source_id").alias("source_id"),
        opt(pf, pred_cols, "label").alias("label"),
        opt(pf, pred_cols, "confidence", "double").alias("confidence"),
        opt(pf, pred_cols, "scores", "map<string,double>").alias("scores"),
        opt(pf, pred_cols, "model_version").alias("model_version"),
        rf(raw_ts).cast("timestamp").alias("produced_at"),
        pf(pred_ts).cast("timestamp").alias("predicted_at"),
        F.col("joined_at"),
        ms_between(rf(raw_ts), F.col("joined_at"), 1).alias("end_to_end_ms"),
    )


def contract_payload(half: str, names: list[str], contract: list[str]) -> Column:
    """A half as JSON: the fields of its message contract that it has, in
    contract order (the transport columns around them are left out)."""
    cols = []
    for c in contract:
        if c == "schema_version" and c not in names:
            cols.append(F.lit(SCHEMA_VERSION).alias(c))
        elif c in names:
            value = F.col(f"{half}{c}")
            cols.append((iso_utc(value) if c.endswith("_at") else value).alias(c))
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def expired_error(missing: str, ttl_seconds: float) -> Column:
    return F.lit(f"join_ttl_expired: no {missing} for id within {_ttl_text(ttl_seconds)}s")


def expired(pairs: DataFrame, ttl_seconds: float, raw_topic: str = RAW_TOPIC,
            pred_topic: str = PREDICTIONS_TOPIC, offset_col: str = "offset",
            partition_col: str | None = "partition", with_time: bool = True) -> DataFrame:
    """DLQ rows for first halves that did not join (J2): one per side
    present, both sides out of one pass over the pairs.
    ``original_payload`` holds the half's contract fields as JSON."""
    halves = []
    for side, other, topic, contract in ((RAW, PREDICTION, raw_topic, RAW_SCHEMA), (PREDICTION, RAW, pred_topic, PREDICTION_SCHEMA)):
        names = pairs.schema[side].dataType.fieldNames()
        part = F.col(f"{side}.{partition_col}") if partition_col and partition_col in names else F.lit(0)
        halves.append(F.when(F.col(side).isNotNull(), F.struct(
            expired_error(other, ttl_seconds).alias("error"),
            contract_payload(f"{side}.", names, contract.fieldNames()).alias("original_payload"),
            source_struct(F.lit(topic), part, F.col(f"{side}.{offset_col}")).alias("source"))))
    present = F.filter(F.array(*halves), lambda h: h.isNotNull())
    return pairs.where(~F.col("joined")).select(F.inline(present)).select(
        F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(STAGE_JOIN).alias("stage"), "error", "original_payload", "source",
        *([F.current_timestamp().alias("failed_at")] if with_time else []))


def run_counters(pairs: DataFrame, parsed: DataFrame) -> DataFrame:
    """``outcome, n`` of a run: the join's outcomes and the ``malformed``
    messages of its input (``parsed``: rows with ``error``)."""
    bad = parsed.agg(F.count("error").alias("n")).select(F.lit("malformed").alias("outcome"), "n")
    return outcome_counts(pairs).unionByName(bad)


def outcome_counts(pairs: DataFrame) -> DataFrame:
    """``outcome, n`` for joined / duplicates / expired (A16)."""
    agg = pairs.agg(
        F.count_if("joined").alias("joined"),
        F.sum(F.greatest(F.col(f"n_{RAW}") - 1, F.lit(0)) + F.greatest(F.col(f"n_{PREDICTION}") - 1, F.lit(0)))
        .alias("duplicates"),
        F.sum(F.when(~F.col("joined"), F.col(RAW).isNotNull().cast("int") + F.col(PREDICTION).isNotNull()
                     .cast("int")).otherwise(0)).alias("expired"),
    )
    return agg.select(F.inline(F.array(
        F.struct(F.lit("joined").alias("outcome"), F.col("joined").cast("long").alias("n")),
        F.struct(F.lit("duplicates").alias("outcome"), F.coalesce(F.col("duplicates"), F.lit(0)).cast("long")
                 .alias("n")),
        F.struct(F.lit("expired").alias("outcome"), F.coalesce(F.col("expired"), F.lit(0)).cast("long").alias("n")),
    )))
