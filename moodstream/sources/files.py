"""File sources and sinks: the joined-results JSONL, gold CSVs, the alert
feed, dataset splits and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.functions.text import is_blank
from moodstream.functions.time import parse_iso
from moodstream.operators.datasets import negative_slice
from moodstream.schemas import ALERT, GOLD, JOINED_JSON


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def load_joined(spark: SparkSession, path: str, dedupe: bool = True) -> DataFrame:
    """Joined results written as JSON lines. Torn/corrupt lines are dropped,
    a missing path gives an empty frame, timestamps are parsed, and rows are
    deduplicated by id keeping the earliest ``joined_at`` (the sink is
    at-least-once: a duplicate is a later re-join of the same id)."""
    if not _exists(spark, path):
        df = spark.createDataFrame([], JOINED_JSON)
    else:
        df = spark.read.schema(JOINED_JSON).option("mode", "DROPMALFORMED").json(path)
    df = df.select(*[parse_iso(c).alias(c) if c in ("produced_at", "predicted_at", "joined_at")
                     else F.col(c) for c in df.columns])
    return dedupe_first(df, "id", ["joined_at"]) if dedupe else df


def dedupe_first(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """First row per key by ``order_cols`` (null key counts as one value).
    ``min_by`` aggregates partially before the shuffle, so a hot key never
    gathers its rows in one task."""
    # nulls sort last: (is_null, value) per ordering column
    order = F.struct(*[F.struct(F.col(c).isNull(), F.col(c)) for c in order_cols])
    cols = [c for c in df.columns]
    firsts = df.groupBy(F.col(key).alias("_k")).agg(F.min_by(F.struct(*cols), order).alias("_r"))
    return firsts.select("_r.*")


def _read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Quotes inside a field are doubled; a field may hold line breaks, so a
    file is one split (CSV with quoted line breaks cannot be cut safely:
    bring large inputs as several files)."""
    return spark.read.schema(GOLD).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def load_gold(spark: SparkSession, path: str) -> DataFrame:
    """Gold CSV ``id,text,label``; for a repeated id the last row wins."""
    df = _read_csv(spark, path).withColumn("_row", F.monotonically_increasing_id())
    return df.groupBy("id").agg(F.max_by("label", "_row").alias("label"))


def load_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Replay CSV: only ``id`` and ``text`` are read; blank texts skipped."""
    df = _read_csv(spark, path)
    return df.select("id", "text").where(F.col("text").isNotNull() & ~is_blank("text"))


def load_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Alert feed stored as JSON lines; unparsable lines are skipped."""
    if not _exists(spark, path):
        return spark.createDataFrame([], ALERT)
    return spark.read.schema(ALERT).option("mode", "DROPMALFORMED").json(path) \
        .where(F.col("status").isNotNull())


def _write_csv(df: DataFrame, path: str, fmt: str, *by: str) -> None:
    w = df.write.mode("overwrite").partitionBy(*by) if by else df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    else:
        w.format(fmt).save(path)


def write_splits(df: DataFrame, out_dir: str, fmt: str = "csv") -> None:
    """The data set: one folder per split under ``splits`` (``split=train``
    ...), the test split as ``replay`` and its negative rows as ``spike``."""
    _write_csv(df, f"{out_dir}/splits", fmt, "split")
    test = df.where(F.col("split") == F.lit("test")).drop("split")
    _write_csv(test, f"{out_dir}/replay", fmt)
    _write_csv(negative_slice(test), f"{out_dir}/spike", fmt)


def write_report(report: DataFrame, lines: DataFrame, path: str) -> None:
    """A one-row report as a JSON document (``report``) and its ordered
    lines as Markdown (``markdown``)."""
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/report")
    lines.orderBy("line_no").select("line").coalesce(1).write.mode("overwrite").text(f"{path}/markdown")
