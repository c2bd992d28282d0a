"""The driver's Parquet tables and how they stand in for the domain records.

Mapping (our choice, documented in README):

- ``events`` → predictions: ``event_id`` → ``seq``/``id``, ``ts`` →
  ``predicted_at``, ``event_type`` → label (error, click → negative; view →
  neutral; signup, purchase → positive; anything else passes through as
  an unknown label), ``value`` → ``end_to_end_ms``, ``'v' || user_id % 3`` →
  ``model_version``.
- ``orders`` → raw reviews (``o_orderkey`` → id, ``o_orderdate`` →
  ``produced_at``); ``lineitem`` → prediction deliveries for that id
  (``l_shipdate`` → ``predicted_at``; every line after the first is a
  redelivery).
- ``labels`` → gold labels (toxic → negative, quality → positive, else
  neutral); ``documents`` → texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.functions.time import utc_ts

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Fixed values of our event-type → label mapping.
EVENT_LABELS = {"error": "negative", "click": "negative", "view": "neutral",
                "signup": "positive", "purchase": "positive"}
# Fixed values of our lineitem return flag → predicted label mapping.
RETURNFLAG_LABELS = {"R": "negative", "N": "neutral", "A": "positive"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, as scanned. How the scan is split is left to
    ``spark.sql.files.maxPartitionBytes`` and ``minPartitionNum``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _map_col(col: str, mapping: dict[str, str], passthrough: bool = True):
    expr = None
    for k, v in mapping.items():
        expr = (F.when(F.col(col) == F.lit(k), F.lit(v)) if expr is None
                else expr.when(F.col(col) == F.lit(k), F.lit(v)))
    return expr.otherwise(F.col(col) if passthrough else F.lit(None).cast("string"))


def event_label():
    return _map_col("event_type", EVENT_LABELS)


def predictions_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("seq"),
        F.col("event_id").cast("string").alias("id"),
        utc_ts("ts").alias("predicted_at"),
        event_label().alias("label"),
        F.col("value").alias("end_to_end_ms"),
        F.concat(F.lit("v"), (F.col("user_id") % 3).cast("string")).alias("model_version"),
    )


def gold_from_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels")
    label = F.when(F.col("toxic") == 1, F.lit("negative")) \
        .when(F.col("quality") == 1, F.lit("positive")).otherwise(F.lit("neutral"))
    return lab.select(F.col("doc_id").cast("string").alias("id"), label.alias("label"))


def raw_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw reviews: one per order (``o_orderdate`` is the produce time)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderpriority").alias("text"),
        F.lit("orders").alias("source"),
        F.col("o_custkey").cast("string").alias("source_id"),
        utc_ts("o_orderdate").alias("produced_at"),
        F.col("o_orderkey").alias("offset"),
    )


def predictions_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction deliveries: every line of an order is a delivery of that
    order's prediction; the earliest ship date (then line number, part,
    supplier: line numbers repeat in this table) wins."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("id"),
        _map_col("l_returnflag", RETURNFLAG_LABELS, passthrough=False).alias("label"),
        F.round(1 - F.col("l_discount"), 4).alias("confidence"),
        F.concat(F.lit("m-"), F.col("l_linestatus")).alias("model_version"),
        utc_ts("l_shipdate").alias("predicted_at"),
        F.col("l_linenumber").cast("long").alias("offset"),
        F.col("l_partkey").alias("_tie_part"),
        F.col("l_suppkey").alias("_tie_supp"),
    )


def gold_from_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold labels of the joined orders, one per customer: by account
    balance (below 0 negative, above 5000 positive, else neutral)."""
    c = table(spark, sf_dir, "customer")
    label = F.when(F.col("c_acctbal") < 0, "negative").when(F.col("c_acctbal") > 5000, "positive").otherwise("neutral")
    return c.select(F.col("c_custkey").cast("string").alias("id"), label.alias("label"))
