"""Fixed StructTypes for every record that crosses a stream or file boundary."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must equal the reference's for identical results:
# the label domain and its order, the message contract version, the topic
# names, and the label names of the four-class source dataset (by id).
LABELS = ["negative", "neutral", "positive"]
SCHEMA_VERSION = 1
RAW_TOPIC = "reviews.raw"
PREDICTIONS_TOPIC = "reviews.predictions"
DLQ_TOPIC = "reviews.dlq"
ALERTS_TOPIC = "alerts.negative_spike"
SOURCE_LABELS = {0: "neutral", 1: "objective", 2: "positive", 3: "negative"}

STR, INT, LONG, DBL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
TS, BOOL, BIN = T.TimestampType(), T.BooleanType(), T.BinaryType()


def _s(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SOURCE = _s(("topic", STR), ("partition", INT), ("offset", LONG))

# Kafka-shaped message frame (what readStream.format("kafka") yields).
MESSAGE = _s(("key", BIN), ("value", BIN), ("topic", STR), ("partition", INT),
             ("offset", LONG), ("timestamp", TS))

INCOMING = _s(("text", STR), ("source", STR), ("source_id", STR))

RAW = _s(("schema_version", INT), ("id", STR), ("text", STR), ("source", STR),
         ("source_id", STR), ("produced_at", TS))

SCORES = T.MapType(STR, DBL)

PREDICTION = _s(("schema_version", INT), ("id", STR), ("label", STR), ("confidence", DBL),
                ("scores", SCORES), ("model_version", STR), ("inference_ms", DBL),
                ("predicted_at", TS))

DLQ = _s(("schema_version", INT), ("stage", STR), ("error", STR), ("original_payload", STR),
         ("source", SOURCE), ("failed_at", TS))

JOINED = _s(("schema_version", INT), ("id", STR), ("text", STR), ("source", STR),
            ("source_id", STR), ("label", STR), ("confidence", DBL), ("scores", SCORES),
            ("model_version", STR), ("produced_at", TS), ("predicted_at", TS),
            ("joined_at", TS), ("end_to_end_ms", DBL))

# The JSONL sink as read back by the dashboard / evaluation (timestamps are
# ISO strings in the file and parsed after the read).
JOINED_JSON = _s(("schema_version", INT), ("id", STR), ("text", STR), ("source", STR),
                 ("source_id", STR), ("label", STR), ("confidence", DBL), ("scores", SCORES),
                 ("model_version", STR), ("produced_at", STR), ("predicted_at", STR),
                 ("joined_at", STR), ("end_to_end_ms", DBL))

ALERT = _s(("schema_version", INT), ("alert_id", STR), ("type", STR), ("status", STR),
           ("window_start", STR), ("window_end", STR), ("window_seconds", DBL),
           ("total", LONG), ("negative", LONG), ("negative_share", DBL),
           ("threshold", DBL), ("min_count", LONG), ("emitted_at", STR))

GOLD = _s(("id", STR), ("text", STR), ("label", STR))

SOURCE_DATASET = _s(("tweet", STR), ("label", INT))

BUCKET_COUNTS = _s(("bucket", TS), ("label", STR), ("count", LONG), ("total", LONG),
                   ("negative_share", DBL))

ALERT_INTERVALS = _s(("start", TS), ("end", TS), ("peak_share", DBL), ("threshold", DBL),
                     ("window_seconds", DBL))

MODEL_MANIFEST = _s(("name", STR), ("size", LONG), ("mtime", DBL))
