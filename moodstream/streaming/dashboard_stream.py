"""Live refresh of the dashboard tables from a stream of joined rows.

Each micro-batch is added to the stored rows (one folder per batch id, so a
repeated batch replaces itself) and the tables are written anew from all of
them, as version ``batch_id``. Readers take the newest version, which is
complete, while the next one is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from moodstream.operators import dashboard
from moodstream.session import stream_checkpoint
from moodstream.sources.files import dedupe_first


def dashboard_tables(rows: DataFrame, freq_seconds: int = 30, span: str = "All") -> dict[str, DataFrame]:
    """The tables of one refresh: KPIs, bucket counts and latest reviews of
    the chosen time range, rows deduplicated by id."""
    seen = dashboard.time_range(dedupe_first(rows, "id", ["joined_at"]), span)
    return {"kpis": dashboard.kpis(seen), "bucket_counts": dashboard.bucket_counts(seen, freq_seconds),
            "latest": dashboard.latest(seen)}


def start_dashboard_refresh(joined: DataFrame, out_dir: str, freq_seconds: int = 30, span: str = "All",
                            query_name: str = "dashboard", trigger: dict | None = None):
    spark = joined.sparkSession

    def run(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(f"{out_dir}/rows/batch_id={batch_id}")
        rows = spark.read.parquet(f"{out_dir}/rows").where(f"batch_id <= {batch_id}").drop("batch_id")
        for name, table in dashboard_tables(rows, freq_seconds, span).items():
            table.write.mode("overwrite").parquet(f"{out_dir}/{name}/version={batch_id}")

    w = joined.writeStream.queryName(query_name).foreachBatch(run) \
        .option("checkpointLocation", stream_checkpoint(spark, query_name))
    return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def newest(joined_out_dir: str, table: str, spark) -> DataFrame:
    """The newest complete version of a table (files of an unfinished write
    carry no ``_SUCCESS`` and sit under a temporary name)."""
    df = spark.read.parquet(f"{joined_out_dir}/{table}")
    return df.where(df["version"] == df.agg({"version": "max"}).scalar()).drop("version")
