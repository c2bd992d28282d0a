"""Registered queries over the driver tables, and their DuckDB oracle SQL.

Each query reads whole tables (or frames Spark derives from them) and
returns a DataFrame whose column names match the oracle SQL's aliases.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.functions.time import floor_micros, from_micros
from moodstream.operators import alerts, dashboard
from moodstream.sources.tables import event_label, predictions_from_events, table

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered event-stream queries. The detection window is
# as long as 80 mean gaps between events, whatever the scale factor.
BUCKET_SECONDS = 300
RECENT_MINUTES = 24 * 60
WINDOW_EVENTS, THRESHOLD, MIN_COUNT = 80, 0.5, 20
REARM = alerts.SpikeParams(1.0, THRESHOLD, min_count=MIN_COUNT).rearm_below
# In the late-arrival query, the events of every tenth user arrive this many events late.
LATE_BY = 40
# Streams beside the hot one, and how much longer their detection window is.
KEYS, KEYED_WINDOWS = 4, 3


def spike_params(spark: SparkSession, sf: str) -> alerts.SpikeParams:
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    row = table(spark, sf, "events").agg(F.min(us).alias("a"), F.max(us).alias("b"), F.count("ts").alias("n")).first()
    window = WINDOW_EVENTS * ((row["b"] - row["a"]) // row["n"])
    return alerts.SpikeParams(window / 1e6, THRESHOLD, min_count=MIN_COUNT)


# --- shared SQL fragments (DuckDB) -------------------------------------------
SQL_PRED = """(SELECT event_id AS seq, CAST(event_id AS VARCHAR) AS id, ts AS predicted_at,
  CASE event_type WHEN 'error' THEN 'negative' WHEN 'click' THEN 'negative'
    WHEN 'view' THEN 'neutral' WHEN 'signup' THEN 'positive' WHEN 'purchase' THEN 'positive'
    ELSE event_type END AS label,
  value AS end_to_end_ms, 'v' || CAST(user_id % 3 AS VARCHAR) AS model_version
 FROM events)"""


def sql_iso(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN epoch_us({x}) % 1000000 = 0 "
            f"THEN strftime({x}, '%Y-%m-%dT%H:%M:%S+00:00') "
            f"ELSE strftime({x}, '%Y-%m-%dT%H:%M:%S.%f+00:00') END")


SQL_WIN = f"(SELECT {WINDOW_EVENTS} * ((max(epoch_us(ts)) - min(epoch_us(ts))) // count(ts)) FROM events)"
SQL_WINDOW = f"""w AS (
  SELECT seq, t,
    CAST(count(*) OVER (ORDER BY t, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
      - count(*) OVER (ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND wus PRECEDING) AS BIGINT) AS total,
    CAST(sum(neg) OVER (ORDER BY t, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
      - coalesce(sum(neg) OVER (ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND wus PRECEDING), 0)
      AS BIGINT) AS negative,
    min(t) OVER (ORDER BY t RANGE BETWEEN wus - 1 PRECEDING AND CURRENT ROW) AS start_us
  FROM (SELECT seq, epoch_us(predicted_at) AS t, CASE WHEN label = 'negative' THEN 1 ELSE 0 END AS neg, {SQL_WIN} AS wus
        FROM {SQL_PRED} WHERE predicted_at IS NOT NULL)),
ws AS (SELECT *, CASE WHEN total > 0 THEN negative / total ELSE 0.0 END AS share FROM w)"""

SQL_SPIKES = f"""{SQL_WINDOW},
sg AS (SELECT *, CASE WHEN total >= {MIN_COUNT} AND share >= {THRESHOLD} THEN 1
                      WHEN total >= {MIN_COUNT} AND share < {REARM} THEN -1 END AS sig
       FROM ws),
st AS (SELECT *, coalesce(last_value(sig IGNORE NULLS) OVER (ORDER BY t, seq
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS before FROM sg),
spikes AS (SELECT seq, CASE WHEN sig = 1 THEN 'firing' ELSE 'resolved' END AS status,
                  make_timestamp(start_us) AS ws_ts, make_timestamp(t) AS we_ts,
                  total, negative, share, {SQL_WIN} / 1e6 AS wsec
           FROM st WHERE sig IS NOT NULL AND sig <> before)"""


SQL_STREAM = f"CASE WHEN user_id % 3 = 0 THEN 'hot' ELSE 'k' || CAST(user_id % {KEYS} AS VARCHAR) END"
SQL_NEGATIVE = "CASE WHEN event_type IN ('error', 'click') THEN 1 ELSE 0 END"
SQL_KEYED_WINDOW = f"""w AS (
  SELECT stream, seq, t,
    CAST(count(*) OVER (PARTITION BY stream ORDER BY t, seq ROWS UNBOUNDED PRECEDING)
      - count(*) OVER (PARTITION BY stream ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND wus PRECEDING) AS BIGINT) AS total,
    CAST(sum(neg) OVER (PARTITION BY stream ORDER BY t, seq ROWS UNBOUNDED PRECEDING)
      - coalesce(sum(neg) OVER (PARTITION BY stream ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND wus PRECEDING), 0) AS BIGINT) AS negative,
    min(t) OVER (PARTITION BY stream ORDER BY t RANGE BETWEEN wus - 1 PRECEDING AND CURRENT ROW) AS start_us
  FROM (SELECT {SQL_STREAM} AS stream, event_id AS seq, epoch_us(ts) AS t, {SQL_NEGATIVE} AS neg, {KEYED_WINDOWS} * {SQL_WIN} AS wus
        FROM events WHERE ts IS NOT NULL)),
ws AS (SELECT *, negative / total AS share, row_number() OVER (PARTITION BY stream ORDER BY t, seq) AS place, t AS end_us FROM w)"""


def sql_late_window(stream: str, windows: int) -> str:
    """Each arrival with all events of its window that had arrived."""
    return f"""a AS (
  SELECT *, row_number() OVER (PARTITION BY stream ORDER BY place, seq) AS arrival, max(t) OVER (PARTITION BY stream ORDER BY place, seq) AS edge
  FROM (SELECT {stream} AS stream, event_id AS seq, event_id + CASE WHEN user_id % 10 = 0 THEN {LATE_BY} ELSE 0 END AS place,
               epoch_us(ts) AS t, {SQL_NEGATIVE} AS neg FROM events WHERE ts IS NOT NULL)),
ws AS (
  SELECT r.stream, r.seq, r.arrival AS place, r.edge AS end_us, count(*) AS total, CAST(sum(o.neg) AS BIGINT) AS negative, sum(o.neg) / count(*) AS share,
    min(o.t) AS start_us
  FROM a r JOIN a o ON o.stream = r.stream AND o.t > r.edge - {windows} * {SQL_WIN} AND o.t <= r.edge AND o.arrival <= r.arrival
  GROUP BY r.stream, r.seq, r.arrival, r.edge)"""


SQL_TRANSITIONS = f"""sg AS (
  SELECT *, CASE WHEN total >= {MIN_COUNT} AND share >= {THRESHOLD} THEN 1 WHEN total >= {MIN_COUNT} AND share < {REARM} THEN -1 END AS sig FROM ws),
st AS (SELECT *, coalesce(last_value(sig IGNORE NULLS) OVER (PARTITION BY stream ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS before
       FROM sg),
tr AS (SELECT stream, seq, place AS arrival, CASE WHEN sig = 1 THEN 'firing' ELSE 'resolved' END AS status, make_timestamp(start_us) AS window_start,
         make_timestamp(end_us) AS window_end, total, negative, share AS negative_share FROM st WHERE sig IS NOT NULL AND sig <> before)"""


# --- events as predictions: dashboard ----------------------------------------

def q_bucket_counts(spark, sf):
    return dashboard.bucket_counts(predictions_from_events(spark, sf), BUCKET_SECONDS)


def q_kpis(spark, sf):
    k = dashboard.kpis(predictions_from_events(spark, sf))
    return k.select(
        "total", "negative_share", "neutral_share", "positive_share",
        F.round("p50_latency_ms", 6).alias("p50_latency_ms"),
        F.round("p95_latency_ms", 6).alias("p95_latency_ms"),
        F.array_join("model_versions", ",").alias("model_versions"))


def q_label_shares(spark, sf):
    return dashboard.label_shares(predictions_from_events(spark, sf))


def q_latest_reviews(spark, sf):
    return dashboard.latest(predictions_from_events(spark, sf), 15,
                            columns=["id", "predicted_at", "label", "end_to_end_ms"])


def q_recent_predictions(spark, sf):
    return dashboard.last_minutes(predictions_from_events(spark, sf), RECENT_MINUTES) \
        .select("id", "label", "predicted_at")


# --- events as predictions: alerting -----------------------------------------

def q_sliding_share(spark, sf):
    window = spike_params(spark, sf).window_seconds
    return alerts.sliding_share(predictions_from_events(spark, sf), window).drop("order_desc")


def q_late_sliding_share(spark, sf):
    """The window in order of arrival, with late events."""
    late = F.when(F.col("user_id") % 10 == 0, F.lit(LATE_BY)).otherwise(F.lit(0))
    ev = table(spark, sf, "events").select((F.col("event_id") + late).alias("place"), F.col("event_id").alias("seq"),
                                           F.col("ts").cast("timestamp").alias("predicted_at"), event_label().alias("label"))
    return alerts.arrival_share(ev, spike_params(spark, sf).window_seconds, ["place", "seq"]) \
        .select("seq", "window_end", "total", "negative", "negative_share")


def _alerts(spark, sf):
    params = spike_params(spark, sf)
    spikes = alerts.detect_spikes(predictions_from_events(spark, sf), params)
    return alerts.build_alerts(spikes, params, with_ids=False, keep=("seq",))


def q_detect_spikes(spark, sf):
    return _alerts(spark, sf).drop("seq")


def q_alert_intervals(spark, sf):
    return alerts.alert_intervals(_alerts(spark, sf))


def q_alert_overlay(spark, sf):
    counts = dashboard.bucket_counts(predictions_from_events(spark, sf), BUCKET_SECONDS)
    return dashboard.share_overlay(counts, alerts.alert_intervals(_alerts(spark, sf)))


def q_alert_table(spark, sf):
    return dashboard.alert_table(_alerts(spark, sf))


def q_alert_status(spark, sf):
    return alerts.alert_status(_alerts(spark, sf))


# --- several streams: a third of the events in one of them --------------------

def _stream_key():
    return F.when(F.col("user_id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("user_id") % KEYS).cast("string")))


def _keyed_events(spark, sf):
    late = F.when(F.col("user_id") % 10 == 0, F.lit(LATE_BY)).otherwise(F.lit(0))
    return table(spark, sf, "events").select(
        _stream_key().alias("stream"), (F.col("event_id") + late).alias("place"), F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("predicted_at"), event_label().alias("label"))


def _keyed_params(spark, sf):
    p = spike_params(spark, sf)
    return alerts.SpikeParams(KEYED_WINDOWS * p.window_us / 1e6, THRESHOLD, min_count=MIN_COUNT)


def q_keyed_sliding_share(spark, sf):
    return alerts.sliding_share(_keyed_events(spark, sf), _keyed_params(spark, sf).window_seconds, keys=["stream"]).drop("order_desc")


def q_keyed_spikes(spark, sf):
    return alerts.detect_spikes(_keyed_events(spark, sf), _keyed_params(spark, sf), keys=["stream"])


def q_arrival_spikes(spark, sf):
    """Transitions in order of arrival, with late events and the start of each window."""
    return alerts.arrival_spikes(_keyed_events(spark, sf).drop("stream"), spike_params(spark, sf), ["place", "seq"]).drop("place")


def q_keyed_arrival_spikes(spark, sf):
    return alerts.arrival_spikes(_keyed_events(spark, sf), _keyed_params(spark, sf), ["place", "seq"], keys=["stream"]).drop("place")


def q_keyed_alert_overlay(spark, sf):
    """Buckets of each stream under the windows of its transitions, which overlap;
    those of firing ones stay open to the stream's last bucket."""
    events = _keyed_events(spark, sf).where("predicted_at IS NOT NULL AND label IS NOT NULL")
    per = events.groupBy("stream", floor_micros("predicted_at", BUCKET_SECONDS * 1_000_000).alias("us")).agg(
        F.count("*").alias("total"), F.count_if(F.col("label") == "negative").alias("n"))
    counts = per.select("stream", from_micros("us").alias("bucket"), F.lit("negative").alias("label"), (F.col("n") / F.col("total")).alias("negative_share"), "total")
    spikes = q_keyed_spikes(spark, sf)
    spans = spikes.select("stream", F.col("window_start").alias("start"), F.when(F.col("status") == "resolved", F.col("window_end")).alias("end"), F.col("negative_share").alias("peak_share"))
    return dashboard.share_overlay(counts, spans, keys=["stream"])


QUERIES: dict[str, Query] = {
    "keyed_alert_overlay": q_keyed_alert_overlay,
    "keyed_sliding_share": q_keyed_sliding_share,
    "keyed_spikes": q_keyed_spikes,
    "arrival_spikes": q_arrival_spikes,
    "keyed_arrival_spikes": q_keyed_arrival_spikes,
    "bucket_counts": q_bucket_counts,
    "kpis": q_kpis,
    "label_shares": q_label_shares,
    "latest_reviews": q_latest_reviews,
    "recent_predictions": q_recent_predictions,
    "sliding_share": q_sliding_share,
    "detect_spikes": q_detect_spikes,
    "alert_intervals": q_alert_intervals,
    "alert_overlay": q_alert_overlay,
    "alert_table": q_alert_table,
    "alert_status": q_alert_status,
    "late_sliding_share": q_late_sliding_share,
}

ORACLE_SQL: dict[str, str] = {
    "keyed_sliding_share": f"""
WITH {SQL_KEYED_WINDOW}
SELECT stream, seq, make_timestamp(start_us) AS window_start, make_timestamp(t) AS window_end, total, negative, share AS negative_share FROM ws""",
    "keyed_spikes": f"WITH {SQL_KEYED_WINDOW}, {SQL_TRANSITIONS} SELECT * EXCLUDE (arrival) FROM tr",
    "arrival_spikes": f"""WITH {sql_late_window("'all'", 1)}, {SQL_TRANSITIONS} SELECT * EXCLUDE (stream) FROM tr""",
    "keyed_arrival_spikes": f"WITH {sql_late_window(SQL_STREAM, KEYED_WINDOWS)}, {SQL_TRANSITIONS} SELECT * FROM tr",
    "bucket_counts": f"""
WITH b AS (SELECT epoch_us(predicted_at) - (epoch_us(predicted_at) % {BUCKET_SECONDS * 1_000_000}) AS bucket_us,
                  label, id FROM {SQL_PRED} WHERE predicted_at IS NOT NULL AND label IS NOT NULL),
per AS (SELECT bucket_us,
          count(id) FILTER (WHERE label = 'negative') AS n0,
          count(id) FILTER (WHERE label = 'neutral') AS n1,
          count(id) FILTER (WHERE label = 'positive') AS n2 FROM b GROUP BY bucket_us),
grid AS (SELECT unnest(generate_series(min(bucket_us), max(bucket_us), {BUCKET_SECONDS * 1_000_000})) AS bucket_us
         FROM per),
f AS (SELECT g.bucket_us, coalesce(n0, 0) AS n0, coalesce(n1, 0) AS n1, coalesce(n2, 0) AS n2,
             coalesce(n0, 0) + coalesce(n1, 0) + coalesce(n2, 0) AS total
      FROM grid g LEFT JOIN per USING (bucket_us)),
l AS (SELECT bucket_us, 'negative' AS label, n0 AS count, total, n0 FROM f
      UNION ALL SELECT bucket_us, 'neutral', n1, total, n0 FROM f
      UNION ALL SELECT bucket_us, 'positive', n2, total, n0 FROM f)
SELECT make_timestamp(bucket_us) AS bucket, label, CAST(count AS BIGINT) AS count, CAST(total AS BIGINT) AS total,
       CASE WHEN total > 0 THEN n0 / total ELSE 0.0 END AS negative_share
FROM l""",
    "kpis": f"""
SELECT count(*) AS total,
  CASE WHEN count(label) > 0 THEN count(*) FILTER (WHERE label = 'negative') / count(label) ELSE 0.0 END
    AS negative_share,
  CASE WHEN count(label) > 0 THEN count(*) FILTER (WHERE label = 'neutral') / count(label) ELSE 0.0 END
    AS neutral_share,
  CASE WHEN count(label) > 0 THEN count(*) FILTER (WHERE label = 'positive') / count(label) ELSE 0.0 END
    AS positive_share,
  round(quantile_cont(end_to_end_ms, 0.5), 6) AS p50_latency_ms,
  round(quantile_cont(end_to_end_ms, 0.95), 6) AS p95_latency_ms,
  array_to_string(list_sort(list_distinct(list(model_version))), ',') AS model_versions
FROM {SQL_PRED}""",
    "label_shares": f"""
SELECT label, count(*) AS count, count(*) / sum(count(*)) OVER () AS share
FROM {SQL_PRED} WHERE label IS NOT NULL GROUP BY label""",
    "latest_reviews": f"""
SELECT id, predicted_at, label, end_to_end_ms FROM {SQL_PRED}
ORDER BY predicted_at DESC NULLS LAST, id DESC LIMIT 15""",
    "recent_predictions": f"""
SELECT id, label, predicted_at FROM {SQL_PRED}
WHERE epoch_us(predicted_at) >= (SELECT max(epoch_us(predicted_at)) FROM {SQL_PRED}) - {RECENT_MINUTES * 60_000_000}""",
    "sliding_share": f"""
WITH {SQL_WINDOW}
SELECT seq, make_timestamp(start_us) AS window_start, make_timestamp(t) AS window_end,
       total, negative, share AS negative_share FROM ws""",
    "detect_spikes": f"""
WITH {SQL_SPIKES}
SELECT 1 AS schema_version, 'negative_spike' AS type, status,
       {sql_iso('ws_ts')} AS window_start, {sql_iso('we_ts')} AS window_end,
       CAST(wsec AS DOUBLE) AS window_seconds, total, negative,
       round(share, 4) AS negative_share, CAST({THRESHOLD} AS DOUBLE) AS threshold,
       CAST({MIN_COUNT} AS BIGINT) AS min_count
FROM spikes""",
    "alert_status": f"""
WITH {SQL_SPIKES}
SELECT count(*) FILTER (WHERE status = 'firing') AS fired,
  CASE WHEN count(*) > 0 THEN CAST({THRESHOLD} AS DOUBLE) END AS last_threshold FROM spikes""",
    "late_sliding_share": f"""
WITH p AS (SELECT e.seq, e.seq + CASE WHEN user_id % 10 = 0 THEN {LATE_BY} ELSE 0 END AS place, epoch_us(predicted_at) AS t,
    CASE WHEN label = 'negative' THEN 1 ELSE 0 END AS neg
  FROM {SQL_PRED} e JOIN events ON event_id = seq WHERE predicted_at IS NOT NULL),
a AS (SELECT *, row_number() OVER (ORDER BY place, seq) AS arr, max(t) OVER (ORDER BY place, seq ROWS UNBOUNDED PRECEDING) AS edge FROM p),
j AS (SELECT i.seq, i.edge, count(j.arr) AS total, coalesce(sum(j.neg), 0) AS negative
  FROM a i LEFT JOIN a j ON j.arr <= i.arr AND j.t > i.edge - {SQL_WIN} GROUP BY i.seq, i.edge)
SELECT seq, make_timestamp(edge) AS window_end, total, CAST(negative AS BIGINT) AS negative,
  CASE WHEN total > 0 THEN negative / total ELSE 0.0 END AS negative_share FROM j""",
    "alert_intervals": f"""
WITH {SQL_SPIKES},
c AS (SELECT *, lag(status, 1, 'resolved') OVER (ORDER BY we_ts, seq) AS prev FROM spikes),
d AS (SELECT *, lead(we_ts) OVER (ORDER BY we_ts, seq) AS nxt FROM c WHERE status <> prev)
SELECT we_ts AS start, nxt AS "end", round(share, 4) AS peak_share, CAST({THRESHOLD} AS DOUBLE) AS threshold,
       CAST(wsec AS DOUBLE) AS window_seconds
FROM d WHERE status = 'firing'""",
}

ORACLE_SQL.update({
    "keyed_alert_overlay": f"""
WITH spans AS (SELECT stream, window_start AS start, CASE WHEN status = 'resolved' THEN window_end END AS stop, negative_share AS peak_share
  FROM ({ORACLE_SQL["keyed_spikes"]})),
share AS (SELECT {SQL_STREAM} AS stream, make_timestamp(epoch_us(predicted_at) - (epoch_us(predicted_at) % {BUCKET_SECONDS * 1_000_000})) AS bucket,
    count(*) AS total, count(*) FILTER (WHERE label = 'negative') / count(*) AS negative_share
  FROM {SQL_PRED} p JOIN events ON event_id = seq WHERE predicted_at IS NOT NULL AND label IS NOT NULL GROUP BY ALL),
ends AS (SELECT stream, max(bucket) AS last FROM share GROUP BY stream),
closed AS (SELECT spans.stream, start, coalesce(stop, last) AS stop, peak_share FROM spans JOIN ends USING (stream))
SELECT s.stream, s.bucket, s.negative_share, s.total, c.start AS alert_start, c.stop AS alert_end, c.peak_share
FROM share s LEFT JOIN closed c ON s.stream = c.stream AND s.bucket >= c.start AND s.bucket <= c.stop""",
    "alert_overlay": f"""
WITH counts AS ({ORACLE_SQL["bucket_counts"]}),
iv AS ({ORACLE_SQL["alert_intervals"]}),
share AS (SELECT bucket, negative_share, total FROM counts WHERE label = 'negative'),
spans AS (SELECT start, coalesce("end", (SELECT max(bucket) FROM share)) AS stop, peak_share FROM iv)
SELECT s.bucket, s.negative_share, s.total, sp.start AS alert_start, sp.stop AS alert_end, sp.peak_share
FROM share s LEFT JOIN spans sp ON s.bucket >= sp.start AND s.bucket <= sp.stop""",
    "alert_table": f"""
WITH {SQL_SPIKES}
SELECT status, {sql_iso('we_ts')} AS window_end, negative, total, round(share, 4) AS negative_share,
       CAST({THRESHOLD} AS DOUBLE) AS threshold
FROM spikes ORDER BY we_ts DESC""",
})


# --- messages: contracts and DLQ ----------------------------------------------
from moodstream.operators import contracts, join_chains, joining  # noqa: E402
from moodstream.functions.time import iso_utc, utc_ts  # noqa: E402
from moodstream.schemas import RAW_TOPIC  # noqa: E402
from moodstream.sources.messages import as_messages, raw_messages_from_tables  # noqa: E402
from moodstream.sources.tables import gold_from_customers, predictions_from_lineitem, raw_from_orders  # noqa: E402

JOIN_TTL_SECONDS = 365 * 24 * 3600.0


def q_parse_raw(spark, sf):
    p = contracts.parse_raw(raw_messages_from_tables(spark, sf))
    return p.select("topic", "partition", "offset", "error", "schema_version", "id")


def q_parse_keyed(spark, sf):
    p = contracts.parse_keyed(raw_messages_from_tables(spark, sf))
    return p.select("topic", "partition", "offset", "error")


def q_dlq_rows(spark, sf):
    _, bad = contracts.split_valid(contracts.parse_raw(raw_messages_from_tables(spark, sf)))
    d = contracts.to_dlq(bad, with_time=False)
    return d.select("schema_version", "stage", "error", "original_payload",
                    F.col("source.topic").alias("source_topic"),
                    F.col("source.partition").alias("source_partition"),
                    F.col("source.offset").alias("source_offset"))


def q_validate_incoming(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", "text", "source", F.col("doc_id").cast("string").alias("source_id"))
    return contracts.validate_incoming(docs).select("doc_id", "rejected_reason")


def q_ingest_raw(spark, sf):
    """Accepted documents as keyed raw messages (fixed ids and time)."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "source", F.col("doc_id").cast("string").alias("source_id"))
    raw = contracts.build_raw(contracts.validate_incoming(docs), F.concat(F.lit("doc-"), F.col("source_id")),
                              F.lit("2026-01-01 00:00:00").cast("timestamp"))
    sent = contracts.to_json_value(raw, topic=RAW_TOPIC)
    return sent.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "topic")


def q_alert_input(spark, sf):
    """Events as prediction messages, every seventh without an id."""
    ev = predictions_from_events(spark, sf)
    id_ = F.when(F.col("seq") % 7 != 0, F.col("id"))
    msgs = as_messages(ev, F.to_json(F.struct(F.lit(1).alias("schema_version"), id_.alias("id"), "label",
                                              iso_utc("predicted_at").alias("predicted_at"))), "predictions", F.col("seq"))
    return contracts.parse_predictions(msgs).select("offset", "id", "label", "predicted_at")


def _pairs(spark, sf):
    return joining.join_reviews(raw_from_orders(spark, sf), predictions_from_lineitem(spark, sf),
                                JOIN_TTL_SECONDS, tie_cols=("_tie_part", "_tie_supp"))


def q_ttl_join(spark, sf):
    return joining.build_joined(_pairs(spark, sf)).drop("scores")


def q_join_dlq(spark, sf):
    """Join-stage DLQ: malformed messages of the join input and TTL-expired
    halves, one feed (``unionByName``)."""
    _, bad = contracts.split_valid(contracts.parse_keyed(raw_messages_from_tables(spark, sf)))
    malformed = contracts.to_dlq(bad, stage=contracts.STAGE_JOIN, with_time=False)
    d = malformed.unionByName(joining.expired(_pairs(spark, sf), JOIN_TTL_SECONDS, with_time=False))
    return d.select("schema_version", "stage", "error", "original_payload",
                    F.col("source.topic").alias("source_topic"),
                    F.col("source.partition").alias("source_partition"),
                    F.col("source.offset").alias("source_offset"))


def q_join_expired(spark, sf):
    d = joining.expired(_pairs(spark, sf), JOIN_TTL_SECONDS, with_time=False)
    return d.select("schema_version", "stage", "error", "original_payload",
                    F.col("source.topic").alias("source_topic"),
                    F.col("source.partition").alias("source_partition"),
                    F.col("source.offset").alias("source_offset"))


def q_join_outcomes(spark, sf):
    return joining.outcome_counts(_pairs(spark, sf))


def q_run_counters(spark, sf):
    parsed = contracts.parse_keyed(raw_messages_from_tables(spark, sf))
    return joining.run_counters(_pairs(spark, sf), parsed)


# Every third order shares one id: its halves go through many epochs.
CHAIN_TTL_DAYS, CHAIN_DEDUPE_DAYS = 30, 45


def _halves(spark, sf):
    def half(side, key, at, line, ties):
        id_ = F.when(F.col(key) % 3 == 0, F.lit("hot")).otherwise(F.col(key).cast("string"))
        return [id_.alias("id"), F.lit(side).alias("side"), utc_ts(at).alias("at"), (F.col(key) * 10 + line).alias("offset"),
                *[c.cast("long").alias(f"_tie{i}") for i, c in enumerate(ties)]]

    zero = F.lit(0)
    raw = table(spark, sf, "orders").select(*half(joining.RAW, "o_orderkey", "o_orderdate", zero, [zero, zero]))
    return raw.unionByName(table(spark, sf, "lineitem").select(
        *half(joining.PREDICTION, "l_orderkey", "l_shipdate", F.col("l_linenumber"), [F.col("l_partkey"), F.col("l_suppkey")])))


def _epochs(halves):
    day = 86400
    return join_chains.join_chains(halves, CHAIN_TTL_DAYS * day, CHAIN_DEDUPE_DAYS * day, ("offset", "_tie0", "_tie1"))


def q_ttl_join_chains(spark, sf):
    return _epochs(_halves(spark, sf))


def q_chain_outcomes(spark, sf):
    halves = _halves(spark, sf)
    return join_chains.chain_outcomes(halves, _epochs(halves))


SQL_CHAINS = f"""WITH RECURSIVE h AS (
  SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'hot' ELSE CAST(o_orderkey AS VARCHAR) END AS id, 'raw' AS side, epoch_us(o_orderdate) AS t, o_orderkey * 10 AS off,
    0 AS p, 0 AS s FROM orders
  UNION ALL SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE CAST(l_orderkey AS VARCHAR) END, 'prediction', epoch_us(l_shipdate), l_orderkey * 10 + l_linenumber,
    l_partkey, l_suppkey FROM lineitem),
r AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY id, t, off, p, s, side) AS r FROM h WHERE t IS NOT NULL),
o AS (SELECT *, min(CASE WHEN side = 'raw' THEN r END) OVER later AS next_raw, min(CASE WHEN side <> 'raw' THEN r END) OVER later AS next_pred
  FROM r WINDOW later AS (PARTITION BY id ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
q AS (SELECT o.*, m.t AS pt, m.off AS poff FROM o LEFT JOIN r m ON m.r = CASE WHEN o.side = 'raw' THEN next_pred ELSE next_raw END
  AND m.t - o.t < {CHAIN_TTL_DAYS} * 86400000000),
e AS (SELECT *, CASE WHEN pt IS NULL THEN t + {CHAIN_TTL_DAYS} * 86400000000 ELSE pt + {CHAIN_DEDUPE_DAYS} * 86400000000 END AS end_t FROM q),
f AS (SELECT id, t, min(r) AS r FROM r GROUP BY id, t),
n AS MATERIALIZED (SELECT e.*, f.r AS nxt FROM e ASOF LEFT JOIN f ON e.id = f.id AND e.end_t <= f.t),
reach AS (SELECT min(r) AS r FROM r GROUP BY id UNION ALL SELECT nxt FROM reach JOIN n USING (r) WHERE nxt IS NOT NULL),
epochs AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY r) AS epoch, side, make_timestamp(t) AS started_at,
  CASE WHEN pt IS NULL THEN 'expired' ELSE 'joined' END AS outcome, make_timestamp(coalesce(pt, end_t)) AS ended_at,
  CASE WHEN side = 'raw' THEN off ELSE poff END AS raw_offset, CASE WHEN side = 'raw' THEN poff ELSE off END AS prediction_offset FROM reach JOIN n USING (r))"""

ORACLE_SQL.update({
    "ttl_join_chains": f"{SQL_CHAINS} SELECT * FROM epochs",
    "chain_outcomes": f"""{SQL_CHAINS}, c AS (SELECT count(*) FILTER (outcome = 'joined') AS j, count(*) FILTER (outcome = 'expired') AS x FROM epochs)
SELECT 'joined' AS outcome, j AS n FROM c UNION ALL SELECT 'expired', x FROM c UNION ALL SELECT 'duplicates', (SELECT count(*) FROM r) - 2 * j - x FROM c""",
})

QUERIES.update({
    "ttl_join_chains": q_ttl_join_chains,
    "chain_outcomes": q_chain_outcomes,
    "ingest_raw": q_ingest_raw,
    "alert_input": q_alert_input,
    "run_counters": q_run_counters,
    "parse_raw": q_parse_raw,
    "parse_keyed": q_parse_keyed,
    "dlq_rows": q_dlq_rows,
    "validate_incoming": q_validate_incoming,
    "ttl_join": q_ttl_join,
    "join_expired": q_join_expired,
    "join_outcomes": q_join_outcomes,
    "join_dlq": q_join_dlq,
})

SQL_MSGS = """msgs AS (
  SELECT 'documents' AS topic, 0 AS partition, doc_id AS "offset",
    CAST(to_json({'schema_version': 1, 'id': 'doc-' || doc_id, 'text': text, 'source': source,
             'source_id': CAST(doc_id AS VARCHAR), 'produced_at': NULL}) AS VARCHAR) AS value, NULL AS meant FROM documents
  UNION ALL SELECT 'conversations', 0, conv_id * 1000 + turn,
    CAST(to_json({'schema_version': turn, 'id': 'conv-' || conv_id || '-' || turn, 'text': text,
                  'source': role}) AS VARCHAR), NULL
    FROM conversations
  UNION ALL SELECT 'labels', 0, doc_id, CAST(to_json({'schema_version': quality, 'id': doc_id}) AS VARCHAR), NULL
    FROM labels
  UNION ALL SELECT 'events', 0, event_id, props, NULL FROM events
  UNION ALL SELECT 'pages', 0, page_id, html, NULL FROM pages
  UNION ALL SELECT 'parts', 0, p_partkey, CASE p_partkey % 4 WHEN 0 THEN ok || ' junk'
      WHEN 1 THEN '{"schema_version":9,' || substr(ok, 2) WHEN 2 THEN ok || ' ' || ok ELSE ok || chr(10) || ' ' END,
    CASE WHEN p_partkey % 4 = 1 THEN ok END
    FROM (SELECT p_partkey, '{"schema_version":1,"id":"part-' || p_partkey || '","text":"part ' || p_partkey || '"}' AS ok FROM part)),
msgj AS (SELECT *, coalesce(meant, CASE WHEN json_valid(value) THEN value END) AS j FROM msgs)"""

SQL_VERSION_REPR = """CASE WHEN json_type(j, '$.schema_version') IS NULL
    OR json_type(j, '$.schema_version') = 'NULL' THEN 'None'
  WHEN json_type(j, '$.schema_version') = 'VARCHAR' THEN '''' || json_extract_string(j, '$.schema_version') || ''''
  WHEN json_type(j, '$.schema_version') = 'BOOLEAN' THEN
    CASE WHEN json_extract_string(j, '$.schema_version') = 'true' THEN 'True' ELSE 'False' END
  ELSE CAST(json_extract(j, '$.schema_version') AS VARCHAR) END"""
SQL_VERSION_OK = ("coalesce(json_type(j, '$.schema_version') IN ('UBIGINT', 'BIGINT') "
                  "AND json_extract_string(j, '$.schema_version') = '1', false)")
SQL_ID_OK = ("coalesce(json_type(j, '$.id') = 'VARCHAR' AND length(json_extract_string(j, '$.id')) > 0, false)")
SQL_TEXT_OK = ("coalesce(json_type(j, '$.text') = 'VARCHAR' AND "
               "regexp_replace(json_extract_string(j, '$.text'), '^\\s+|\\s+$', '', 'g') <> '', false)")
SQL_RAW_ERROR = f"""CASE WHEN j IS NULL THEN 'not valid UTF-8 JSON'
  WHEN json_type(j) <> 'OBJECT' THEN 'payload is not a JSON object'
  WHEN NOT {SQL_VERSION_OK} THEN 'unsupported schema_version ' || {SQL_VERSION_REPR}
  WHEN NOT {SQL_ID_OK} THEN 'missing id'
  WHEN NOT {SQL_TEXT_OK} THEN 'missing text' END"""
SQL_KEYED_ERROR = f"""CASE WHEN j IS NULL THEN 'not valid UTF-8 JSON'
  WHEN json_type(j) <> 'OBJECT' OR NOT {SQL_ID_OK} THEN 'payload is not an object with an id'
  WHEN NOT {SQL_VERSION_OK} THEN 'unsupported schema_version ' || {SQL_VERSION_REPR} END"""

SQL_PAIRS = f"""r0 AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS text, 'orders' AS source,
    CAST(o_custkey AS VARCHAR) AS source_id, o_orderdate AS produced_at, o_orderkey AS "offset" FROM orders),
p0 AS (SELECT CAST(l_orderkey AS VARCHAR) AS id,
    CASE l_returnflag WHEN 'R' THEN 'negative' WHEN 'N' THEN 'neutral' WHEN 'A' THEN 'positive' END AS label,
    round(1 - l_discount, 4) AS confidence, 'm-' || l_linestatus AS model_version,
    l_shipdate AS predicted_at, CAST(l_linenumber AS BIGINT) AS "offset",
    l_partkey AS tie_part, l_suppkey AS tie_supp FROM lineitem),
r1 AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY id) AS n_raw, row_number() OVER (PARTITION BY id
         ORDER BY produced_at IS NULL, produced_at, "offset") AS rn FROM r0) WHERE rn = 1),
p1 AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY id) AS n_pred, row_number() OVER (PARTITION BY id
         ORDER BY predicted_at IS NULL, predicted_at, "offset", tie_part, tie_supp) AS rn FROM p0) WHERE rn = 1),
pairs AS (SELECT coalesce(r1.id, p1.id) AS id, r1.id IS NOT NULL AS has_raw, p1.id IS NOT NULL AS has_pred,
    r1.text, r1.source, r1.source_id, r1.produced_at, r1."offset" AS raw_offset,
    p1.label, p1.confidence, p1.model_version, p1.predicted_at, p1."offset" AS pred_offset,
    coalesce(n_raw, 0) AS n_raw, coalesce(n_pred, 0) AS n_pred,
    coalesce(r1.id IS NOT NULL AND p1.id IS NOT NULL
      AND abs(epoch_us(p1.predicted_at) - epoch_us(r1.produced_at)) < {int(JOIN_TTL_SECONDS * 1_000_000)}, false)
      AS joined
  FROM r1 FULL OUTER JOIN p1 ON r1.id = p1.id)"""

SQL_EXPIRED = f"""SELECT 1 AS schema_version, 'consumer_join' AS stage,
  'join_ttl_expired: no prediction for id within {JOIN_TTL_SECONDS!r}s' AS error,
  CAST(to_json({{'schema_version': 1, 'id': id, 'text': text, 'source': source, 'source_id': source_id,
            'produced_at': {sql_iso('produced_at')}}}) AS VARCHAR) AS original_payload,
  'reviews.raw' AS source_topic, 0 AS source_partition, raw_offset AS source_offset
FROM pairs WHERE NOT joined AND has_raw
UNION ALL
SELECT 1, 'consumer_join', 'join_ttl_expired: no raw for id within {JOIN_TTL_SECONDS!r}s',
  CAST(to_json({{'schema_version': 1, 'id': id, 'label': label, 'confidence': confidence, 'model_version': model_version,
            'predicted_at': {sql_iso('predicted_at')}}}) AS VARCHAR),
  'reviews.predictions', 0, pred_offset
FROM pairs WHERE NOT joined AND has_pred"""

ORACLE_SQL.update({
    "parse_raw": f"""
WITH {SQL_MSGS}
SELECT topic, partition, "offset", {SQL_RAW_ERROR} AS error,
  TRY_CAST(json_extract_string(j, '$.schema_version') AS INTEGER) AS schema_version,
  json_extract_string(j, '$.id') AS id
FROM msgj""",
    "parse_keyed": f"""
WITH {SQL_MSGS}
SELECT topic, partition, "offset", {SQL_KEYED_ERROR} AS error FROM msgj""",
    "dlq_rows": f"""
WITH {SQL_MSGS}, e AS (SELECT *, {SQL_RAW_ERROR} AS error FROM msgj)
SELECT 1 AS schema_version, 'consumer_prediction' AS stage, 'ValueError: ' || error AS error,
  value AS original_payload, topic AS source_topic, partition AS source_partition, "offset" AS source_offset
FROM e WHERE error IS NOT NULL""",
    "validate_incoming": """
SELECT doc_id, CASE WHEN text IS NULL THEN 'text: missing' WHEN length(text) < 1 THEN 'text: too short'
  WHEN length(text) > 5000 THEN 'text: too long' WHEN length(source) > 64 THEN 'source: too long'
  WHEN length(CAST(doc_id AS VARCHAR)) > 128 THEN 'source_id: too long' END AS rejected_reason
FROM documents""",
    "ttl_join": f"""
WITH {SQL_PAIRS},
j AS (SELECT *, make_timestamp(greatest(epoch_us(produced_at), epoch_us(predicted_at))) AS joined_at
      FROM pairs WHERE joined)
SELECT 1 AS schema_version, id, text, source, source_id, label, confidence, model_version,
  produced_at, predicted_at, joined_at,
  round((epoch_us(joined_at) - epoch_us(produced_at)) / 1000.0, 1) AS end_to_end_ms
FROM j""",
    "join_expired": f"WITH {SQL_PAIRS}\n{SQL_EXPIRED}",
    "join_dlq": f"""
WITH {SQL_MSGS}, {SQL_PAIRS}, e AS (SELECT *, {SQL_KEYED_ERROR} AS error FROM msgj)
SELECT 1 AS schema_version, 'consumer_join' AS stage, error, value AS original_payload,
  topic AS source_topic, partition AS source_partition, "offset" AS source_offset
FROM e WHERE error IS NOT NULL
UNION ALL
{SQL_EXPIRED}""",
    "ingest_raw": """
SELECT 'doc-' || doc_id AS key, CAST(to_json({'schema_version': 1, 'id': 'doc-' || doc_id, 'text': text, 'source': source,
    'source_id': CAST(doc_id AS VARCHAR), 'produced_at': '2026-01-01T00:00:00+00:00'}) AS VARCHAR) AS value, 'reviews.raw' AS topic
FROM documents WHERE text IS NOT NULL AND length(text) BETWEEN 1 AND 5000 AND coalesce(length(source), 0) <= 64""",
    "alert_input": f"""
SELECT seq AS "offset", id, label, predicted_at FROM {SQL_PRED}
WHERE seq % 7 <> 0 AND label IS NOT NULL AND predicted_at IS NOT NULL""",
    "run_counters": f"""
WITH {SQL_MSGS}, {SQL_PAIRS}, a AS (SELECT count(*) FILTER (WHERE joined) AS j,
    sum(greatest(n_raw - 1, 0) + greatest(n_pred - 1, 0)) AS d,
    sum(CASE WHEN NOT joined THEN CAST(has_raw AS INT) + CAST(has_pred AS INT) ELSE 0 END) AS e FROM pairs)
SELECT 'joined' AS outcome, CAST(j AS BIGINT) AS n FROM a
UNION ALL SELECT 'duplicates', CAST(coalesce(d, 0) AS BIGINT) FROM a
UNION ALL SELECT 'expired', CAST(coalesce(e, 0) AS BIGINT) FROM a
UNION ALL SELECT 'malformed', count(*) FROM msgj WHERE {SQL_KEYED_ERROR} IS NOT NULL""",
    "join_outcomes": f"""
WITH {SQL_PAIRS}, a AS (SELECT count(*) FILTER (WHERE joined) AS j,
    sum(greatest(n_raw - 1, 0) + greatest(n_pred - 1, 0)) AS d,
    sum(CASE WHEN NOT joined THEN CAST(has_raw AS INT) + CAST(has_pred AS INT) ELSE 0 END) AS e FROM pairs)
SELECT 'joined' AS outcome, CAST(j AS BIGINT) AS n FROM a
UNION ALL SELECT 'duplicates', CAST(coalesce(d, 0) AS BIGINT) FROM a
UNION ALL SELECT 'expired', CAST(coalesce(e, 0) AS BIGINT) FROM a""",
})


# --- evaluation ----------------------------------------------------------------
from moodstream.functions import text as textf  # noqa: E402
from moodstream.operators import datasets, evaluation  # noqa: E402
from moodstream.sources.tables import gold_from_labels  # noqa: E402

# Stand-in scorer for the evaluation queries (deterministic, so the oracle
# can recompute it): document length bands → label.
SQL_RULE = ("CASE WHEN n_chars < 1000 THEN 'negative' WHEN n_chars < 3000 THEN 'neutral' "
            "ELSE 'positive' END")


def doc_predictions(spark, sf):
    d = table(spark, sf, "documents")
    label = F.when(F.col("n_chars") < 1000, "negative").when(F.col("n_chars") < 3000, "neutral") \
        .otherwise("positive")
    return d.select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("id"),
                    F.col("source"), F.col("doc_id").cast("string").alias("source_id"),
                    label.alias("label"), F.lit("rule-1").alias("model_version"))


def _matched(spark, sf):
    return evaluation.match_gold(doc_predictions(spark, sf), gold_from_labels(spark, sf))


def q_eval_confusion(spark, sf):
    return evaluation.confusion_matrix(_matched(spark, sf))


def q_eval_class_metrics(spark, sf):
    return evaluation.class_metrics(evaluation.confusion_matrix(_matched(spark, sf)))


def q_eval_summary(spark, sf):
    return evaluation.summary(evaluation.confusion_matrix(_matched(spark, sf)))


def q_classification_report(spark, sf):
    r = evaluation.classification_report(evaluation.confusion_matrix(_matched(spark, sf)))
    return r.select("label", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


def _report(spark, sf):
    joined = joining.build_joined(_pairs(spark, sf)).where(F.col("label").isNotNull())
    return evaluation.evaluation_report(joined, gold_from_customers(spark, sf))


def q_eval_report(spark, sf):
    return _report(spark, sf).select("expected", "joined", "matched", "missing", F.array_join("model_versions", ",").alias("model_versions"),
                                     "n", "accuracy", "macro_f1", "messages", "throughput_per_sec", "produce_to_join_p95")


def q_report_lines(spark, sf):
    return evaluation.report_lines(_report(spark, sf))


def q_eval_coverage(spark, sf):
    j, g = doc_predictions(spark, sf), gold_from_labels(spark, sf)
    return evaluation.coverage(j, g, evaluation.match_gold(j, g))


def q_join_performance(spark, sf):
    return evaluation.performance(joining.build_joined(_pairs(spark, sf)))


def _scored_labels(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id").select("doc_id", F.col("n_chars").cast("double").alias("score"),
                                         (F.col("n_chars") / (F.col("n_chars") + F.lit(2000.0))).alias("prob"),
                                         "quality")


def q_roc_points(spark, sf):
    return evaluation.roc_points(_scored_labels(spark, sf), "score", "quality") \
        .select("threshold", F.round("tpr", 9).alias("tpr"), F.round("fpr", 9).alias("fpr"))


def q_roc_auc(spark, sf):
    return evaluation.roc_auc(_scored_labels(spark, sf), "score", "quality") \
        .select(F.round("auc", 9).alias("auc"))


def q_binary_metrics(spark, sf):
    return evaluation.binary_metrics(_scored_labels(spark, sf), "prob", "quality")


# --- dataset preparation ----------------------------------------------------
SPLIT_SEED = 42
REPLAY_RATE = 20.0
REPLAY_START = "2026-01-01 00:00:00"


def source_dataset(spark, sf):
    """Documents as a four-class source dataset: toxic → 3 (negative),
    quality → 2 (positive), non-English → 1 (objective), else 0 (neutral)."""
    d = table(spark, sf, "documents")
    lab = table(spark, sf, "labels")
    lid = F.when(F.col("toxic") == 1, 3).when(F.col("quality") == 1, 2) \
        .when(F.col("lang") != "en", 1).otherwise(0)
    return d.join(lab, "doc_id", "left").select(F.col("text").alias("tweet"), lid.alias("label"),
                                               F.col("doc_id").alias("_row"))


def dataset(spark, sf):
    m = datasets.map_labels(source_dataset(spark, sf))
    return datasets.with_ids(m, "_row")


def q_dataset_labels(spark, sf):
    return datasets.map_labels(source_dataset(spark, sf)).select(F.col("_row").alias("doc_id"), "label")


def q_dataset_ids(spark, sf):
    return dataset(spark, sf).select("id", F.col("_row").alias("doc_id"))


def q_dataset_split(spark, sf):
    return datasets.stratified_split(dataset(spark, sf), seed=SPLIT_SEED).select("id", "label", "split")


def q_dataset_sample(spark, sf):
    return datasets.stratified_sample(dataset(spark, sf), 0.5, seed=SPLIT_SEED).select("id", "label")


def q_class_weights(spark, sf):
    return datasets.class_weights(datasets.map_labels(source_dataset(spark, sf)))


def q_dataset_union(spark, sf):
    """Documents and conversation turns as one data set."""
    docs = source_dataset(spark, sf).withColumnRenamed("_row", "key")
    turns = table(spark, sf, "conversations").select(F.col("text").alias("tweet"), F.lit(0).alias("label"),
                                                     (F.col("conv_id") * 1000 + F.col("turn")).alias("key"))
    return datasets.union_datasets(docs, turns).select("_set", "key", "label", F.length("tweet").alias("n_chars"))


def q_replay_schedule(spark, sf):
    test = datasets.stratified_split(dataset(spark, sf), seed=SPLIT_SEED).where(F.col("split") == "test")
    return datasets.replay_schedule(test, "_row", REPLAY_RATE, F.lit(REPLAY_START)).select("id", "due_at")


def q_negative_slice(spark, sf):
    test = datasets.stratified_split(dataset(spark, sf), seed=SPLIT_SEED).where(F.col("split") == "test")
    return datasets.negative_slice(test).select("id", "label")


# --- text ---------------------------------------------------------------------
TOKENS = 120


def q_clean_texts(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", textf.clean_text("text").alias("clean"))


def q_token_ids(spark, sf):
    d = table(spark, sf, "documents")
    ids = textf.token_ids("text", TOKENS)
    return d.select("doc_id", F.array_join(ids, " ").alias("ids"),
                    F.aggregate(textf.attention_mask(ids), F.lit(0), lambda a, x: a + x).cast("long")
                    .alias("mask_sum"))


def q_normalized_texts(spark, sf):
    d = table(spark, sf, "conversations")
    return d.select("conv_id", "turn", textf.normalize_arabic("text").alias("normalized"))


QUERIES.update({
    "classification_report": q_classification_report,
    "eval_report": q_eval_report,
    "report_lines": q_report_lines,
    "dataset_union": q_dataset_union,
    "eval_confusion": q_eval_confusion,
    "eval_class_metrics": q_eval_class_metrics,
    "eval_summary": q_eval_summary,
    "eval_coverage": q_eval_coverage,
    "join_performance": q_join_performance,
    "roc_points": q_roc_points,
    "roc_auc": q_roc_auc,
    "binary_metrics": q_binary_metrics,
    "dataset_labels": q_dataset_labels,
    "dataset_ids": q_dataset_ids,
    "dataset_split": q_dataset_split,
    "dataset_sample": q_dataset_sample,
    "class_weights": q_class_weights,
    "replay_schedule": q_replay_schedule,
    "negative_slice": q_negative_slice,
    "clean_texts": q_clean_texts,
    "token_ids": q_token_ids,
    "normalized_texts": q_normalized_texts,
})

SQL_GOLD = """(SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN toxic = 1 THEN 'negative'
  WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS label FROM labels)"""
SQL_JOINED_DOCS = f"""(SELECT 'doc-' || doc_id AS id, source, CAST(doc_id AS VARCHAR) AS source_id,
  {SQL_RULE} AS label, 'rule-1' AS model_version FROM documents)"""
SQL_MATCHED = f"""m AS (SELECT j.*, g.label AS gold_label FROM {SQL_JOINED_DOCS} j JOIN {SQL_GOLD} g
  ON j.source_id = g.id)"""
SQL_CONF = f"""{SQL_MATCHED},
lbl AS (SELECT unnest(['negative', 'neutral', 'positive']) AS l),
grid AS (SELECT a.l AS gold, b.l AS pred FROM lbl a, lbl b),
cnt AS (SELECT gold_label AS gold, label AS pred, count(*) AS n FROM m GROUP BY ALL),
cm AS (SELECT grid.gold, grid.pred, CAST(coalesce(n, 0) AS BIGINT) AS n FROM grid LEFT JOIN cnt USING (gold, pred))"""
SQL_CLASS = f"""{SQL_CONF},
k AS (SELECT l AS label,
    sum(CASE WHEN gold = l AND pred = l THEN n ELSE 0 END) AS tp,
    sum(CASE WHEN gold <> l AND pred = l THEN n ELSE 0 END) AS fp,
    sum(CASE WHEN gold = l AND pred <> l THEN n ELSE 0 END) AS fn FROM cm, lbl GROUP BY l),
pr AS (SELECT label, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p,
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r, CAST(tp + fn AS BIGINT) AS support FROM k),
cls AS (SELECT label, round(p, 4) AS precision, round(r, 4) AS recall,
    round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 4) AS f1, support FROM pr)"""
SQL_SCORED = """sc AS (SELECT d.doc_id, CAST(n_chars AS DOUBLE) AS score, n_chars / (n_chars + 2000.0) AS prob,
  quality FROM documents d JOIN labels l USING (doc_id))"""
SQL_DATASET = """src AS (SELECT d.doc_id, d.text, CASE WHEN toxic = 1 THEN 3 WHEN quality = 1 THEN 2
    WHEN lang <> 'en' THEN 1 ELSE 0 END AS label_id FROM documents d LEFT JOIN labels l USING (doc_id)),
m0 AS (SELECT doc_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS text,
    CASE label_id WHEN 0 THEN 'neutral' WHEN 1 THEN 'neutral' WHEN 2 THEN 'positive' WHEN 3 THEN 'negative' END
    AS label FROM src),
m1 AS (SELECT text, arg_min(label, doc_id) AS label, min(doc_id) AS doc_id FROM m0 WHERE text <> '' GROUP BY text),
ids AS (SELECT 'astd-' || CAST(row_number() OVER (ORDER BY doc_id) - 1 AS VARCHAR) AS id, doc_id, label FROM m1)"""


def _sql_lr(src: str, n: str, draws: str, out: str) -> str:
    """Largest-remainder allocation of ``draws`` over classes (ties by label)."""
    return f"""(SELECT * EXCLUDE (_cont, _fl, _rem, _need, _rn), _fl + CASE WHEN _rn <= _need THEN 1 ELSE 0 END AS {out}
  FROM (SELECT *, row_number() OVER (ORDER BY _rem DESC, label) AS _rn, {draws} - sum(_fl) OVER () AS _need
        FROM (SELECT *, floor(_cont) AS _fl, _cont - floor(_cont) AS _rem
              FROM (SELECT *, {n} * {draws} / sum({n}) OVER () AS _cont FROM {src}))))"""


SQL_SPLIT = f"""{SQL_DATASET},
c0 AS (SELECT label, count(*) AS n FROM ids GROUP BY label),
c1 AS (SELECT *, sum(n) OVER () - ceil(CAST(0.3 AS DOUBLE) * sum(n) OVER ()) AS ntrain FROM c0),
c2 AS {_sql_lr('c1', 'n', 'ntrain', 'train')},
c3 AS (SELECT *, n - train AS rest FROM c2),
c4 AS (SELECT *, sum(rest) OVER () - ceil((CAST(2 AS DOUBLE) / 3) * sum(rest) OVER ()) AS nval FROM c3),
c5 AS {_sql_lr('c4', 'rest', 'nval', 'val')},
rk AS (SELECT ids.*, row_number() OVER (PARTITION BY label ORDER BY md5(id || '{SPLIT_SEED}'), id) AS r FROM ids),
split AS (SELECT rk.id, rk.doc_id, rk.label, CASE WHEN r <= train THEN 'train' WHEN r <= train + val THEN 'val'
    ELSE 'test' END AS split FROM rk JOIN c5 USING (label))"""

# Python's white space, spelled out: RE2's \\s is ASCII only.
SQL_SPACES = ("\\t\\n\\x{0B}\\f\\r \\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
              "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}")
SQL_PY_SPACE, SQL_NOT_SPACE = f"[{SQL_SPACES}]", f"[^{SQL_SPACES}]"
SQL_CLEAN = ("trim(regexp_replace(lower(regexp_replace(regexp_replace(replace(replace(replace(replace("
             "regexp_replace(text, '\\.+([^\\pL\\pN_]|$)', '\\1', 'g'), chr(137) || 'Û_', ' '), '&amp', ' '), "
             "chr(10), ' '), '#', ''), '@[a-zA-Z0-9_]+', '@', 'g'), 'https?" + SQL_NOT_SPACE + "+', 'www', 'g')), '" + SQL_PY_SPACE + "+', ' ', 'g'))")

# The elongation rule (a non-digit repeated 3+ times → two) needs a
# back-reference that RE2 lacks; here a character is dropped when it equals
# the two before it and is not an ASCII digit.
SQL_NORMALIZED = f"""n1 AS (SELECT conv_id, turn, string_split(regexp_replace(regexp_replace(regexp_replace(text,
    '(?:https?://|www\\.){SQL_NOT_SPACE}+', '[رابط]', 'g'),
    '@{SQL_NOT_SPACE}+', '[مستخدم]', 'g'),
    '[\\x{{064B}}-\\x{{0652}}\\x{{0640}}]', '', 'g'), '') AS c FROM conversations),
n2 AS (SELECT conv_id, turn, array_to_string(list_filter(c, lambda x, i: NOT (i >= 3 AND x = c[i - 1]
    AND x = c[i - 2] AND NOT regexp_full_match(x, '[0-9]'))), '') AS t FROM n1)"""

SQL_REPORT = f"""{SQL_PAIRS},
gold AS (SELECT CAST(c_custkey AS VARCHAR) AS gid, CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal > 5000 THEN 'positive'
    ELSE 'neutral' END AS gold_label FROM customer),
jr AS (SELECT *, make_timestamp(greatest(epoch_us(produced_at), epoch_us(predicted_at))) AS joined_at FROM pairs WHERE joined AND label IS NOT NULL),
m AS (SELECT *, round((epoch_us(joined_at) - epoch_us(produced_at)) / 1000.0, 1) AS e2e,
    (epoch_us(predicted_at) - epoch_us(produced_at)) / 1000.0 AS pms FROM jr JOIN gold ON source_id = gid),
lbl AS (SELECT unnest(['negative', 'neutral', 'positive']) AS l),
k AS (SELECT l, count(*) FILTER (WHERE gold_label = l AND label = l) AS tp, count(*) FILTER (WHERE gold_label <> l AND label = l) AS fp,
    count(*) FILTER (WHERE gold_label = l AND label <> l) AS fn FROM lbl, m GROUP BY l),
f AS (SELECT l, tp + fn AS support, round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END, 4) AS f1 FROM k),
r AS (SELECT (SELECT count(DISTINCT gid) FROM gold) AS expected, (SELECT count(*) FROM jr) AS joined, count(*) AS matched,
    (SELECT count(DISTINCT gid) FROM gold WHERE gid NOT IN (SELECT source_id FROM m)) AS missing,
    array_to_string(list_sort(list_distinct(list(model_version))), ',') AS model_versions, count(*) AS n,
    round(count(*) FILTER (WHERE label = gold_label) / count(*), 4) AS accuracy, (SELECT round(sum(f1) / 3, 4) FROM f) AS macro_f1,
    count(*) AS messages,
    round(count(*) / ((max(epoch_us(produced_at)) - min(epoch_us(produced_at))) / 1e6), 2) AS offered_rate_per_sec,
    round(count(*) / ((max(epoch_us(joined_at)) - min(epoch_us(produced_at))) / 1e6), 2) AS throughput_per_sec,
    round(quantile_cont(pms, 0.5), 1) AS p50, round(quantile_cont(pms, 0.95), 1) AS p95,
    round(quantile_cont(e2e, 0.5), 1) AS j50, round(quantile_cont(e2e, 0.95), 1) AS produce_to_join_p95, round(quantile_cont(e2e, 0.99), 1) AS j99
  FROM m)"""


def _sql_number(x: str) -> str:
    return f"coalesce(regexp_replace(CAST(CAST({x} AS DECIMAL(30, 2)) AS VARCHAR), '0$', ''), 'None')"


ORACLE_SQL.update({
    "classification_report": f"""WITH {SQL_CLASS},
u AS (SELECT label, p, r, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f, support FROM pr)
SELECT label, round(p, 9) AS precision, round(r, 9) AS recall, round(f, 9) AS f1, support FROM u
UNION ALL SELECT 'macro avg', round(sum(p) / 3, 9), round(sum(r) / 3, 9), round(sum(f) / 3, 9), CAST(sum(support) AS BIGINT) FROM u
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 9), round(sum(r * support) / sum(support), 9),
  round(sum(f * support) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM u""",
    "eval_report": f"""WITH {SQL_REPORT}
SELECT expected, joined, matched, missing, model_versions, n, accuracy, macro_f1, messages, throughput_per_sec, produce_to_join_p95 FROM r""",
    "report_lines": f"""WITH {SQL_REPORT},
x AS (
  SELECT 0 AS line_no, 'Matched ' || matched || ' / ' || expected || ' dataset rows (' || missing || ' missing) · model: '
    || replace(model_versions, ',', ', ') AS line FROM r
  UNION ALL SELECT 1, '' UNION ALL SELECT 2, '| Metric | Value |' UNION ALL SELECT 3, '|---|---|'
  UNION ALL SELECT 4, '| Accuracy | ' || printf('%.4f', accuracy) || ' |' FROM r
  UNION ALL SELECT 5, '| Macro-F1 | ' || printf('%.4f', macro_f1) || ' |' FROM r
  UNION ALL SELECT 6 + list_position(['negative', 'neutral', 'positive'], l) - 1, '| F1 ' || l || ' (n=' || support || ') | ' || printf('%.4f', f1) || ' |' FROM f
  UNION ALL SELECT 9, '| Offered rate | ' || {_sql_number('offered_rate_per_sec')} || ' msg/s |' FROM r
  UNION ALL SELECT 10, '| Throughput (end to end) | ' || {_sql_number('throughput_per_sec')} || ' msg/s |' FROM r
  UNION ALL SELECT 11, '| Produce→predict p50 / p95 | ' || {_sql_number('p50')} || ' / ' || {_sql_number('p95')} || ' ms |' FROM r
  UNION ALL SELECT 12, '| Produce→join p50 / p95 / p99 | ' || {_sql_number('j50')} || ' / ' || {_sql_number('produce_to_join_p95')} || ' / '
    || {_sql_number('j99')} || ' ms |' FROM r)
SELECT CAST(line_no AS INTEGER) AS line_no, line FROM x""",
    "dataset_union": f"""WITH {SQL_DATASET}
SELECT 0 AS _set, doc_id AS key, label_id AS label, length(text) AS n_chars FROM src
UNION ALL SELECT 1, conv_id * 1000 + turn, 0, length(text) FROM conversations""",
    "normalized_texts": f"""WITH {SQL_NORMALIZED}
SELECT conv_id, turn, regexp_replace(t, '^{SQL_PY_SPACE}+|{SQL_PY_SPACE}+$', '', 'g') AS normalized FROM n2""",
    "eval_confusion": f"WITH {SQL_CONF} SELECT gold, pred, n FROM cm",
    "eval_class_metrics": f"WITH {SQL_CLASS} SELECT * FROM cls",
    "eval_summary": f"""WITH {SQL_CLASS},
a AS (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS n,
  round(CASE WHEN sum(n) > 0 THEN sum(CASE WHEN gold = pred THEN n ELSE 0 END) / sum(n) ELSE 0.0 END, 4)
  AS accuracy FROM cm)
SELECT n, accuracy, (SELECT round(sum(f1) / 3, 4) FROM cls) AS macro_f1 FROM a""",
    "eval_coverage": f"""WITH {SQL_MATCHED}
SELECT (SELECT count(DISTINCT id) FROM {SQL_GOLD}) AS expected,
  (SELECT count(*) FROM {SQL_JOINED_DOCS}) AS joined, (SELECT count(*) FROM m) AS matched,
  (SELECT count(*) FROM (SELECT DISTINCT id FROM {SQL_GOLD}) g WHERE id NOT IN (SELECT source_id FROM m))
  AS missing""",
    "join_performance": f"""WITH {SQL_PAIRS},
j AS (SELECT *, make_timestamp(greatest(epoch_us(produced_at), epoch_us(predicted_at))) AS joined_at
      FROM pairs WHERE joined),
r AS (SELECT *, round((epoch_us(joined_at) - epoch_us(produced_at)) / 1000.0, 1) AS end_to_end_ms,
      (epoch_us(predicted_at) - epoch_us(produced_at)) / 1000.0 AS predict_ms FROM j)
SELECT count(*) AS messages,
  CASE WHEN count(produced_at) > 1 AND max(epoch_us(produced_at)) > min(epoch_us(produced_at))
    THEN round(count(*) / ((max(epoch_us(produced_at)) - min(epoch_us(produced_at))) / 1e6), 2) END
    AS offered_rate_per_sec,
  CASE WHEN max(epoch_us(joined_at)) > min(epoch_us(produced_at))
    THEN round(count(*) / ((max(epoch_us(joined_at)) - min(epoch_us(produced_at))) / 1e6), 2) END
    AS throughput_per_sec,
  round((max(epoch_us(joined_at)) - min(epoch_us(produced_at))) / 1e6, 1) AS wall_seconds,
  round(quantile_cont(predict_ms, 0.5), 1) AS produce_to_predict_p50,
  round(quantile_cont(predict_ms, 0.95), 1) AS produce_to_predict_p95,
  round(quantile_cont(predict_ms, 0.99), 1) AS produce_to_predict_p99,
  round(max(predict_ms), 1) AS produce_to_predict_max,
  round(quantile_cont(end_to_end_ms, 0.5), 1) AS produce_to_join_p50,
  round(quantile_cont(end_to_end_ms, 0.95), 1) AS produce_to_join_p95,
  round(quantile_cont(end_to_end_ms, 0.99), 1) AS produce_to_join_p99,
  round(max(end_to_end_ms), 1) AS produce_to_join_max
FROM r""",
    "roc_points": f"""WITH {SQL_SCORED},
g AS (SELECT score AS threshold, count(*) FILTER (WHERE quality = 1) AS pos,
    count(*) FILTER (WHERE quality <> 1 OR quality IS NULL) AS neg FROM sc GROUP BY score),
t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM g),
c AS (SELECT threshold, sum(pos) OVER (ORDER BY threshold DESC) AS tp,
    sum(neg) OVER (ORDER BY threshold DESC) AS fp FROM g)
SELECT threshold, round(CASE WHEN P > 0 THEN tp / P ELSE 0.0 END, 9) AS tpr,
  round(CASE WHEN N > 0 THEN fp / N ELSE 0.0 END, 9) AS fpr FROM c, t
UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0""",
    "roc_auc": f"""WITH {SQL_SCORED},
g AS (SELECT score, count(*) FILTER (WHERE quality = 1) AS pos,
    count(*) FILTER (WHERE quality <> 1 OR quality IS NULL) AS neg FROM sc GROUP BY score),
c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS below FROM g)
SELECT round(CASE WHEN sum(pos) * sum(neg) > 0 THEN sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg))
  ELSE 0.0 END, 9) AS auc FROM c""",
    "binary_metrics": f"""WITH {SQL_SCORED},
p AS (SELECT CASE WHEN prob < 0.5 THEN 0 ELSE 1 END AS pred, quality AS y FROM sc)
SELECT count(*) AS n, CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE pred = y) / count(*) ELSE 0.0 END
  AS accuracy,
  CASE WHEN 2 * count(*) FILTER (WHERE pred = 1 AND y = 1) + count(*) FILTER (WHERE pred = 1 AND y <> 1)
    + count(*) FILTER (WHERE pred <> 1 AND y = 1) > 0
  THEN 2 * count(*) FILTER (WHERE pred = 1 AND y = 1) / (2 * count(*) FILTER (WHERE pred = 1 AND y = 1)
    + count(*) FILTER (WHERE pred = 1 AND y <> 1) + count(*) FILTER (WHERE pred <> 1 AND y = 1)) ELSE 0.0 END
  AS f1 FROM p""",
    "dataset_labels": f"WITH {SQL_DATASET} SELECT doc_id, label FROM m1",
    "dataset_ids": f"WITH {SQL_DATASET} SELECT id, doc_id FROM ids",
    "dataset_split": f"WITH {SQL_SPLIT} SELECT id, label, split FROM split",
    "dataset_sample": f"""WITH {SQL_DATASET},
rk AS (SELECT ids.*, row_number() OVER (PARTITION BY label ORDER BY md5(id || '{SPLIT_SEED}'), id) AS r,
  count(*) OVER (PARTITION BY label) AS nc FROM ids)
SELECT id, label FROM rk WHERE r <= round_even(CAST(0.5 AS DOUBLE) * nc, 0)""",
    "class_weights": f"""WITH {SQL_DATASET},
lbl AS (SELECT unnest(['negative', 'neutral', 'positive']) AS label),
c AS (SELECT label, count(*) AS n FROM ids GROUP BY label)
SELECT lbl.label, sum(coalesce(n, 0)) OVER () / (3 * greatest(coalesce(n, 0), 1)) AS weight
FROM lbl LEFT JOIN c USING (label)""",
    "replay_schedule": f"""WITH {SQL_SPLIT},
t AS (SELECT id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM split WHERE split = 'test')
SELECT id, make_timestamp(epoch_us(TIMESTAMP '{REPLAY_START}') + CAST(round(i * (1e6 / {REPLAY_RATE})) AS BIGINT))
  AS due_at FROM t""",
    "negative_slice": f"WITH {SQL_SPLIT} SELECT id, label FROM split WHERE split = 'test' AND label = 'negative'",
    "clean_texts": f"SELECT doc_id, {SQL_CLEAN} AS clean FROM documents",
    "token_ids": f"""SELECT doc_id,
  array_to_string(list_resize(list_transform(string_split(text, ''), lambda c: unicode(c)), {TOKENS}, 0), ' ') AS ids,
  CAST(least(length(text), {TOKENS}) AS BIGINT) AS mask_sum FROM documents""",
})


# --- model training and scoring -------------------------------------------------
# Weights of a model are not reproducible in SQL. score_documents and score_binary return
# what must hold for any trained model, row by row; train_eval and binary_held_out hold
# the model against answers by chance, whose figures the SQL works out.
from uuid import uuid4  # noqa: E402

from pyspark.sql import Window  # noqa: E402

from moodstream.operators import training  # noqa: E402
from moodstream.plans.scalar import attach_row  # noqa: E402
from moodstream.schemas import LABELS  # noqa: E402
from moodstream.session import checkpoint_dir  # noqa: E402

FIT = {"reg_params": (0.01, 0.1), "clean_mode": "tweet", "num_features": 1 << 14, "max_iter": 15}


def _trained(spark, sf):
    # Texts are mapped once and written to the shared folder; ids and splits are
    # decided on narrow rows (a text's hash names it) and join the texts once.
    # train, val and test all read what that wrote.
    folder = f"{checkpoint_dir(spark).rstrip('/')}/split-{uuid4().hex}"
    mapped = datasets.map_labels(source_dataset(spark, sf))
    mapped.withColumn("_h", F.unhex(F.sha2("text", 256))).write.parquet(f"{folder}/texts")
    texts = spark.read.parquet(f"{folder}/texts")
    narrow = texts.select("_h", "_row", "label").checkpoint()
    split = datasets.stratified_split(datasets.with_ids(narrow, "_row"), seed=SPLIT_SEED).select("_h", "id", "label", "split")
    texts.select("_h", "text").join(split, "_h").drop("_h").write.parquet(f"{folder}/parts")
    parts = spark.read.parquet(f"{folder}/parts")
    part = lambda name: parts.where(F.col("split") == name).select("id", "text", "label")
    return training.train_classifier(part("train"), part("val"), **FIT), part("test")


def q_train_eval(spark, sf):
    """Per label, of the test split: the support, the answers in its row of the
    confusion matrix (all rows of the split, so the same number), and what a
    model that always gives the most frequent label reaches as macro-F1. The
    trained model has to be above that, and it has to be the first candidate
    with the best validation score."""
    res, test = _trained(spark, sf)
    pred = training.predict(res.model, test.withColumnRenamed("label", "gold_label"))
    cm = evaluation.confusion_matrix(pred).checkpoint()
    rows = cm.groupBy(F.col("gold").alias("label")).agg(F.sum("n").alias("answered"))
    cls = evaluation.class_metrics(cm).select("label", "support", F.col("f1"))
    share = F.col("support") / F.sum("support").over(Window.partitionBy())  # one row per label
    most = F.max(share).over(Window.partitionBy())
    by_chance = (2 * most / (1 + most)) / F.lit(len(LABELS))
    reached = F.avg("f1").over(Window.partitionBy())
    scores = [h["val_macro_f1"] for h in res.history]
    first_best = FIT["reg_params"][scores.index(max(scores))] == res.reg_param
    return cls.join(rows, "label").select("label", "support", "answered", F.round(by_chance, 6).alias("majority_f1"),
                                          (reached > by_chance).alias("above_majority"), F.lit(first_best).alias("first_best"))


def q_score_documents(spark, sf):
    """Per document: whether the label is the first of the highest scores,
    the confidence its score, and the scores sum to 1."""
    res, _ = _trained(spark, sf)
    scored = training.predict(res.model, table(spark, sf, "documents").select("doc_id", "text"))
    values = F.transform(F.array(*[F.lit(x) for x in LABELS]), lambda k: F.element_at("scores", k))
    best = F.element_at(F.array(*[F.lit(x) for x in LABELS]), F.array_position(values, F.array_max(values)).cast("int"))
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return scored.select("doc_id", ((F.col("label") == best) & (F.col("confidence") == F.array_max(values))
                                    & (F.abs(total - 1) < 1e-9)).alias("consistent"))


def q_score_binary(spark, sf):
    """Per document: whether a two-class model's label follows from its
    probability."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    known = d.join(table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id")
    model = training.train_binary(known, class_weights={0: 5.0}, num_features=1 << 12, max_iter=10)
    p = training.predict_binary(model, d)
    return p.select("doc_id", (F.col("prob").between(0, 1) & ((F.col("prob") >= 0.5) == (F.col("label") == 1))).alias("consistent"))


HELD = "0123"  # a quarter of all documents, by the first digit of the hash of the id


def q_binary_held_out(spark, sf):
    """A two-class model learnt from three quarters of the labelled documents
    and its ranking of the rest: counts, whether the area under the curve is
    above chance (0.5), and whether every document was scored."""
    checkpoint_dir(spark)
    d = table(spark, sf, "documents").select("doc_id", "text")
    y = table(spark, sf, "labels").where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("y"))
    held = F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 1).isin(*HELD)
    known = d.join(y, "doc_id")
    model = training.train_binary(known.where(~held).withColumnRenamed("y", "label"), class_weights={1: 5.0}, num_features=1 << 14, max_iter=15)
    scored = training.predict_binary(model, d).select("doc_id", "prob").checkpoint()
    rest = scored.join(y, "doc_id").where(held).select("prob", "y")
    counts = rest.agg(F.count(F.lit(1)).alias("held_out"), F.count_if(F.col("y") == 1).alias("toxic"))
    auc = evaluation.roc_auc(rest, "prob", "y").select((F.col("auc") > 0.5).alias("above_chance"))
    return attach_row(attach_row(counts, auc), scored.agg(F.count("prob").alias("scored")))


QUERIES.update({"train_eval": q_train_eval, "score_documents": q_score_documents, "score_binary": q_score_binary,
                "binary_held_out": q_binary_held_out})

ORACLE_SQL.update({
    "train_eval": f"""WITH {SQL_SPLIT}, lbl AS (SELECT unnest(['negative', 'neutral', 'positive']) AS label),
c AS (SELECT lbl.label, count(split.id) AS support FROM lbl LEFT JOIN split ON split.label = lbl.label AND split = 'test' GROUP BY lbl.label),
m AS (SELECT max(support) / sum(support) AS most FROM c)
SELECT label, support, support AS answered, round(2 * most / (1 + most) / 3, 6) AS majority_f1, true AS above_majority, true AS first_best FROM c, m""",
    "binary_held_out": f"""WITH y AS (SELECT doc_id, max(toxic) AS y FROM labels WHERE doc_id IS NOT NULL AND toxic IS NOT NULL GROUP BY doc_id),
rest AS (SELECT y FROM documents JOIN y USING (doc_id) WHERE md5(CAST(doc_id AS VARCHAR))[1] IN ({", ".join(f"'{h}'" for h in HELD)}))
SELECT count(*) AS held_out, count(*) FILTER (WHERE y = 1) AS toxic, count(DISTINCT y) = 2 AS above_chance,
  (SELECT count(*) FROM documents) AS scored FROM rest""",
    "score_documents": "SELECT doc_id, true AS consistent FROM documents",
    "score_binary": "SELECT doc_id, true AS consistent FROM documents",
})


# --- one query each for operators that the queries above use only in part -----
from moodstream.functions.numeric import label_scores, softmax  # noqa: E402
from moodstream.sources import files  # noqa: E402

RUN_TAG, FIRST_N = "src3", 50


def q_eval_run_tag(spark, sf):
    """Documents of one run tag with their gold label."""
    pairs = evaluation.match_gold(doc_predictions(spark, sf), gold_from_labels(spark, sf), source=RUN_TAG)
    return pairs.select("id", "source", "label", "gold_label")


def q_last_gold(spark, sf):
    """Of a gold id that comes several times (a user) the last row counts."""
    gold = table(spark, sf, "events").select(F.col("user_id").alias("id"), event_label().alias("label"), "event_id")
    return evaluation.one_gold_label(gold, "event_id")


def q_prediction_payloads(spark, sf):
    """Prediction records of three scores per row: softmax, first highest
    label, scores by label, rounded as they are sent."""
    logits = F.transform(F.slice("embedding", 1, len(LABELS)), lambda x: x.cast("double") * 10)
    e = table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("id"), label_scores(softmax(logits), LABELS).alias("s"), F.size("embedding").alias("n"))
    sent = contracts.prediction_payload(e.select("id", "s.*", F.lit("m-1").alias("model_version"), (F.col("n") / 3).alias("inference_ms")), with_time=False)
    return sent.select("schema_version", "id", "label", "confidence", *[F.col("scores")[x].alias(f"score_{x}") for x in LABELS], "model_version", "inference_ms")


def q_stacked_counts(spark, sf):
    """Bucket counts with the place of the label in the stack."""
    return q_bucket_counts(spark, sf).select("bucket", "label", "count", dashboard.label_ordinal().cast("int").alias("place"))


def q_replay_first(spark, sf):
    """The first items of the replay (the limit is the feature)."""
    test = datasets.stratified_split(dataset(spark, sf), seed=SPLIT_SEED).where(F.col("split") == "test")
    return datasets.replay_schedule(test, "_row", REPLAY_RATE, F.lit(REPLAY_START), max_messages=FIRST_N).select("id", "due_at")


def q_first_deliveries(spark, sf):
    """Of the deliveries of a prediction the earliest."""
    p = predictions_from_lineitem(spark, sf)
    return files.dedupe_first(p, "id", ["predicted_at", "offset", "_tie_part", "_tie_supp"]).select("id", "label", "predicted_at", "offset")


def q_joined_lines(spark, sf):
    """Joined results written as JSON lines, one in ten of them torn, read back:
    the earliest time of each id."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/joined-lines-{uuid.uuid4().hex}"
    ev = table(spark, sf, "events").where("ts IS NOT NULL").select("event_id", F.to_json(F.struct(
        F.col("user_id").cast("string").alias("id"), event_label().alias("label"), iso_utc(F.col("ts").cast("timestamp")).alias("joined_at"))).alias("line"))
    torn = F.when(F.col("event_id") % 10 == 0, F.expr("substring(line, 1, length(line) div 2)")).otherwise(F.col("line"))
    ev.select(torn.alias("value")).write.text(folder)
    return files.load_joined(spark, folder).select("id", "joined_at")


QUERIES.update({"eval_run_tag": q_eval_run_tag, "last_gold": q_last_gold, "prediction_payloads": q_prediction_payloads, "stacked_counts": q_stacked_counts,
                "replay_first": q_replay_first, "first_deliveries": q_first_deliveries, "joined_lines": q_joined_lines})

_SQL_SCORE = [f"exp(x[{i + 1}] - m) / (exp(x[1] - m) + exp(x[2] - m) + exp(x[3] - m))" for i in range(len(LABELS))]
ORACLE_SQL.update({
    "eval_run_tag": f"WITH {SQL_MATCHED} SELECT id, source, label, gold_label FROM m WHERE source = '{RUN_TAG}'",
    "last_gold": f"""SELECT user_id AS id, arg_max(label, event_id) AS label
FROM {SQL_PRED} p JOIN events ON event_id = seq GROUP BY user_id""",
    "prediction_payloads": f"""WITH e AS (SELECT vec_id, len(embedding) AS n, list_transform(embedding[1:3], lambda v: CAST(v AS DOUBLE) * 10) AS x FROM embeddings),
t AS (SELECT *, list_max(x) AS m FROM e), s AS (SELECT *, [{", ".join(_SQL_SCORE)}] AS p FROM t)
SELECT 1 AS schema_version, CAST(vec_id AS VARCHAR) AS id, ['negative', 'neutral', 'positive'][list_position(p, list_max(p))] AS label,
  round(list_max(p), 4) AS confidence, round(p[1], 4) AS score_negative, round(p[2], 4) AS score_neutral, round(p[3], 4) AS score_positive,
  'm-1' AS model_version, round(n / 3, 2) AS inference_ms FROM s""",
    "stacked_counts": f"""SELECT bucket, label, "count", list_position(['negative', 'neutral', 'positive'], label) - 1 AS place
FROM ({ORACLE_SQL["bucket_counts"]})""",
    "replay_first": f"""WITH {SQL_SPLIT},
t AS (SELECT id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM split WHERE split = 'test')
SELECT id, make_timestamp(epoch_us(TIMESTAMP '{REPLAY_START}') + CAST(round(i * (1e6 / {REPLAY_RATE})) AS BIGINT)) AS due_at FROM t WHERE i < {FIRST_N}""",
    "first_deliveries": """SELECT CAST(l_orderkey AS VARCHAR) AS id, CASE l_returnflag WHEN 'R' THEN 'negative' WHEN 'N' THEN 'neutral' WHEN 'A' THEN 'positive' END AS label,
  CAST(l_shipdate AS TIMESTAMP) AS predicted_at, CAST(l_linenumber AS BIGINT) AS "offset" FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) = 1""",
    "joined_lines": """SELECT CAST(user_id AS VARCHAR) AS id, min(CAST(ts AS TIMESTAMP)) AS joined_at FROM events
WHERE event_id % 10 <> 0 AND ts IS NOT NULL GROUP BY user_id""",
})
