"""The alert feed of the dashboard: every alert of the topic since its
beginning, kept as committed batches, with what last went wrong.

``start_alert_feed`` reads a message stream (from its earliest offsets, see
``sources.messages``) and commits the alerts of each batch to a folder of its own;
nothing is committed to the topic, so any number of feeds see the whole history.
A message that is not UTF-8 or not a JSON document is left out and counted.
``snapshot`` is the feed as of the newest commit, also while the stream runs or
after it failed. ``last_error`` tells why a stream has stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from moodstream.operators.contracts import payload_text
from moodstream.schemas import ALERT
from moodstream.session import stream_checkpoint
from moodstream.streaming.commits import commit_batch, read_committed

FEED = StructType([*ALERT.fields, StructField("topic", StringType()), StructField("partition", ALERT["schema_version"].dataType), StructField("offset", LongType())])


def parse_alerts(messages: DataFrame) -> DataFrame:
    """Message columns ``topic, partition, offset``, ``known`` (the value is an
    UTF-8 JSON object) and the alert's fields, null where it lacks them."""
    text = payload_text("value")
    rows = messages.select("topic", "partition", "offset", text.alias("_t"))
    known = F.coalesce(F.schema_of_variant(F.try_parse_json("_t")).startswith("OBJECT"), F.lit(False))
    return rows.select(F.from_json("_t", ALERT).alias("_a"), known.alias("known"), "topic", "partition", "offset") \
        .select("known", "_a.*", "topic", "partition", "offset")


def start_alert_feed(messages: DataFrame, commits: str, query_name: str = "alert_feed", trigger: dict | None = None):
    """Starts the feed. Counters of a batch: ``alerts`` and ``skipped``."""
    def run(batch: DataFrame, batch_id: int):
        parsed = parse_alerts(batch).persist()
        skipped = parsed.agg(F.count_if(~F.col("known")).alias("skipped"))
        commit_batch(commits, batch_id, {"alerts": (parsed.where("known").select(*FEED.fieldNames()), "parquet")}, skipped)
        parsed.unpersist()

    w = messages.writeStream.queryName(query_name).foreachBatch(run) \
        .option("checkpointLocation", stream_checkpoint(messages.sparkSession, query_name))
    return w.trigger(**(trigger or {"processingTime": "1 second"})).start()


def snapshot(spark: SparkSession, commits: str) -> DataFrame:
    """All alerts of the feed so far, with their place in it (``topic,
    partition, offset``); no rows before the first commit."""
    return read_committed(spark, commits, "alerts", schema=FEED)


def last_error(query) -> str | None:
    """What stopped the feed's stream; null while it runs or when it was ended."""
    error = query.exception()
    return None if error is None else str(error)
