"""Kafka-shaped message frames: ``key, value, topic, partition, offset, timestamp``.

The Kafka connector is not bundled here; ``read_kafka`` uses it when it is on
the classpath. ``read_message_files`` gives the same columns from Parquet or
JSON files (batch or stream), and ``messages_from_tables`` derives message
streams from the driver tables so that every contract path is exercised by
real rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.functions.time import utc_ts
from moodstream.schemas import MESSAGE
from moodstream.session import stream_checkpoint
from moodstream.sources.tables import table


def as_messages(df: DataFrame, value, topic: str, offset, partition=None, key=None,
                timestamp=None) -> DataFrame:
    """Project any frame to the message shape (partition 0 by default)."""
    partition = F.lit(0) if partition is None else partition
    val = value.cast("binary") if not isinstance(value, str) else F.col(value).cast("binary")
    return df.select(
        (key.cast("binary") if key is not None else F.lit(None).cast("binary")).alias("key"),
        val.alias("value"),
        F.lit(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        (timestamp if timestamp is not None else F.lit(None).cast("timestamp")).alias("timestamp"),
    )


def read_kafka(spark: SparkSession, bootstrap: str, topics: list[str], stream: bool = True,
               starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Kafka source (earliest offsets; the checkpoint replaces consumer-group
    commits). Needs the spark-sql-kafka connector on the classpath."""
    reader = spark.readStream if stream else spark.read
    r = reader.format("kafka").option("kafka.bootstrap.servers", bootstrap) \
        .option("subscribe", ",".join(topics)).option("startingOffsets", starting_offsets)
    if stream and max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load().select(*MESSAGE.fieldNames())


def read_message_files(spark: SparkSession, path: str, fmt: str = "parquet", stream: bool = False,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Message frames stored as files (same columns as the Kafka source)."""
    reader = spark.readStream if stream else spark.read
    r = reader.schema(MESSAGE).format(fmt)
    if stream and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def write_kafka(df: DataFrame, bootstrap: str, topic: str | None = None):
    """Batch write of ``key, value[, topic]`` rows (acks=all)."""
    w = df.write.format("kafka").option("kafka.bootstrap.servers", bootstrap) \
        .option("kafka.acks", "all")
    if topic:
        w = w.option("topic", topic)
    w.save()


def write_kafka_stream(stream: DataFrame, bootstrap: str, query_name: str, trigger: dict | None = None):
    """Streaming write of ``key, value, topic`` rows (each row names its
    topic; at-least-once, offsets in the query's checkpoint)."""
    w = stream.writeStream.format("kafka").queryName(query_name).option("kafka.bootstrap.servers", bootstrap) \
        .option("kafka.acks", "all").option("checkpointLocation", stream_checkpoint(stream.sparkSession, query_name))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def raw_messages_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw-review topic derived from whole driver tables:

    - ``documents``: well-formed reviews (id ``doc-<doc_id>``, provenance
      ``source``/``doc_id``);
    - ``conversations``: ``schema_version`` = turn number, so turn 1 passes
      and the others are rejected for their version;
    - ``labels``: objects whose ``id`` is a number (rejected: missing id)
      and ``schema_version`` = quality;
    - ``events.props``: JSON objects without a version;
    - ``pages.html``: not JSON at all;
    - ``part``: by key modulo 4, an object with text after it, one that
      repeats a key (valid by its last value), two objects, and one followed
      by white space (valid).
    """
    docs = table(spark, sf_dir, "documents")
    d = as_messages(docs, F.to_json(F.struct(
        F.lit(1).alias("schema_version"),
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("id"),
        F.col("text"), F.col("source"), F.col("doc_id").cast("string").alias("source_id"),
        F.lit(None).cast("string").alias("produced_at")), {"ignoreNullFields": "false"}),
        "documents", F.col("doc_id"), key=F.concat(F.lit("doc-"), F.col("doc_id").cast("string")))
    conv = table(spark, sf_dir, "conversations")
    c = as_messages(conv, F.to_json(F.struct(
        F.col("turn").alias("schema_version"),
        F.concat(F.lit("conv-"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
        .alias("id"),
        F.col("text"), F.col("role").alias("source"))),
        "conversations", F.col("conv_id") * 1000 + F.col("turn"))
    lab = table(spark, sf_dir, "labels")
    lb = as_messages(lab, F.to_json(F.struct(F.col("quality").alias("schema_version"),
                                             F.col("doc_id").alias("id"))),
                     "labels", F.col("doc_id"))
    ev = table(spark, sf_dir, "events")
    e = as_messages(ev, F.col("props"), "events", F.col("event_id"), timestamp=utc_ts("ts"))
    pg = table(spark, sf_dir, "pages")
    p = as_messages(pg, F.col("html"), "pages", F.col("page_id"))
    pt = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    named = F.concat(F.lit('"id":"part-'), key.cast("string"), F.lit('","text":"part '), key.cast("string"), F.lit('"}'))
    valid = F.concat(F.lit('{"schema_version":1,'), named)
    odd = F.when(key % 4 == 0, F.concat(valid, F.lit(" junk"))) \
        .when(key % 4 == 1, F.concat(F.lit('{"schema_version":9,"schema_version":1,'), named)) \
        .when(key % 4 == 2, F.concat(valid, F.lit(" "), valid)).otherwise(F.concat(valid, F.lit("\n ")))
    o = as_messages(pt, odd, "parts", key)
    return d.unionByName(c).unionByName(lb).unionByName(e).unionByName(p).unionByName(o)
