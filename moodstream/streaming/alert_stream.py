"""Spike alerts on a live prediction stream, in order of arrival.

Each micro-batch runs the batch operators (``alerts.arrival_spikes``) over
the events kept from before and its own, so the work is spread over the
cluster and no state sits in one group. Kept are the events that are still
inside the window, as a table; what else carries over is one flag (firing or
not). The state of a batch is written as version ``batch_id`` of a folder, and
a batch that runs again starts from the version before and replaces its own:
state, alerts and input offsets stay in step. Versions before the last one
are not read any more and can be deleted.

Late events count from their arrival while they are inside the window; the
window's right edge is the latest time seen and never moves back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.functions.time import epoch_micros, from_micros
from moodstream.operators.alerts import SpikeParams, arrival_spikes, build_alerts
from moodstream.session import stream_checkpoint
from moodstream.streaming.commits import commit_batch, is_committed, read_committed, retain, vacuum

ORDER = ["_gen", "_from", "_at"]
KEPT = "t_us long, negative boolean, place long"


def as_events(batch: DataFrame, ts_col: str = "predicted_at", label_col: str = "label",
              partition_col: str = "partition", offset_col: str = "offset") -> DataFrame:
    """Prediction rows in the shape of the state: time, flag and place."""
    return batch.select(
        F.lit(1).alias("_gen"), F.coalesce(F.col(partition_col).cast("long"), F.lit(0).cast("long")).alias("_from"),
        F.col(offset_col).cast("long").alias("_at"), epoch_micros(ts_col).alias("t_us"),
        F.coalesce(F.col(label_col) == F.lit("negative"), F.lit(False)).alias("negative")).where(F.col("t_us").isNotNull())


def advance(kept: DataFrame, firing: bool, batch: DataFrame, params: SpikeParams,
            num_partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """One batch: (transitions of its events, events that stay inside).
    ``kept``: rows of the state, ``batch``: rows of ``as_events``."""
    before = kept.select(F.lit(0).alias("_gen"), F.lit(0).cast("long").alias("_from"), F.col("place").alias("_at"), "t_us", "negative")
    both = before.unionByName(batch)
    named = both.select(*ORDER, from_micros("t_us").alias("predicted_at"), F.when(F.col("negative"), "negative").alias("label"))
    spikes = arrival_spikes(named, params, ORDER, rows=F.col("_gen") == 1, firing=firing, num_partitions=num_partitions)
    edge = both.agg(F.max("t_us").alias("t")).scalar()
    stay = both.where(F.col("t_us") > edge - F.lit(params.window_us))
    # In order of time: each is inside when it is replayed. The number only has to be unique and rising with time.
    stay = stay.repartitionByRange("t_us", *ORDER).sortWithinPartitions("t_us", *ORDER)
    return spikes, stay.select("t_us", "negative", F.monotonically_increasing_id().alias("place"))


def read_state(spark: SparkSession, state_dir: str, batch_id: int, committed: bool = False) -> tuple[DataFrame, bool]:
    if batch_id == 0:
        return spark.createDataFrame([], KEPT), False
    if committed:
        kept, flag = (read_committed(spark, state_dir, t, batch_id - 1, batch_id - 1) for t in ("kept", "firing"))
        return kept, flag.first()["firing"]
    flag = spark.read.parquet(f"{state_dir}/firing/version={batch_id - 1}").first()
    return spark.read.schema(KEPT).parquet(f"{state_dir}/kept/version={batch_id - 1}"), flag["firing"]


def start_alert_stream(stream: DataFrame, params: SpikeParams, state_dir: str | None = None, alerts_dir: str | None = None,
                       query_name: str = "alerts", trigger: dict | None = None, commits: str | None = None, **columns):
    """Starts the stream: alert payloads as JSON lines in
    ``alerts_dir/batch_id=…``. ``columns``: names for ``as_events``. With
    ``commits``, a folder, alerts and both parts of the state go there in one
    commit a batch (tables ``alerts``, ``kept``, ``firing``); of the states the
    last two stay."""
    spark = stream.sparkSession

    def run(batch: DataFrame, batch_id: int):
        if commits and is_committed(spark, commits, batch_id):
            return
        kept, firing = read_state(spark, commits or state_dir, batch_id, bool(commits))
        held = as_events(batch, **columns).persist()
        spikes, stay = advance(kept, firing, held, params)
        spikes = spikes.persist()
        raised = build_alerts(spikes, params, keep=("arrival",)).drop("arrival")
        last = spikes.agg(F.max_by("status", "arrival").alias("s")).select(
            F.coalesce(F.col("s") == "firing", F.lit(firing)).alias("firing"))
        if commits:
            commit_batch(commits, batch_id, {"alerts": (raised, "json"), "kept": (stay, "parquet"), "firing": (last, "parquet")})
            for t in ("kept", "firing"):
                retain(spark, commits, t, 2)
            vacuum(spark, commits)
        else:
            raised.write.mode("overwrite").json(f"{alerts_dir}/batch_id={batch_id}")
            stay.write.mode("overwrite").parquet(f"{state_dir}/kept/version={batch_id}")
            last.write.mode("overwrite").parquet(f"{state_dir}/firing/version={batch_id}")
        spikes.unpersist()
        held.unpersist()

    w = stream.writeStream.queryName(query_name).foreachBatch(run) \
        .option("checkpointLocation", stream_checkpoint(spark, query_name))
    return w.trigger(**(trigger or {"availableNow": True})).start()
