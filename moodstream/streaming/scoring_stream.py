"""The scoring stream: raw messages → validated → cleaned → scored →
predictions, with every per-message failure routed to the DLQ.

Each micro-batch is persisted once and written to two sinks from one
``foreachBatch``. Writes go to ``.../batch_id=<id>`` folders with
overwrite, so a retried batch replaces its own output (idempotent), and
the query checkpoint lives in the shared checkpoint folder.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodstream.operators import contracts
from moodstream.session import stream_checkpoint
from moodstream.streaming.commits import commit_batch, is_committed

Scorer = Callable[[DataFrame], DataFrame]


def score_batch(batch: DataFrame, scorer: Scorer, model_version: str) -> tuple[DataFrame, DataFrame]:
    """(predictions, DLQ) for one batch of raw messages. ``scorer`` takes
    ``id, text, value, topic, partition, offset`` and returns those columns
    but the text plus ``label, confidence, scores, error, inference_ms``
    (``error`` set on rows it could not score, e.g. ``scoring.score_texts``).
    Texts reach the scorer as they came: cleaning is a stage of the model, so
    that training and serving clean alike and once."""
    parsed = contracts.parse_raw(batch)
    good, bad = contracts.split_valid(parsed)
    scored = scorer(good.select("id", "text", "value", "topic", "partition", "offset"))
    ok = scored.where(F.col("error").isNull()).withColumn("model_version", F.lit(model_version))
    preds = contracts.prediction_payload(ok)
    poison = scored.where(F.col("error").isNotNull())
    dlq = contracts.to_dlq(bad).unionByName(contracts.to_dlq(poison, error_prefix=""))
    return preds, dlq


def start_scoring_stream(messages: DataFrame, scorer_for_batch: Callable[[], tuple[Scorer, str] | None],
                         predictions_dir: str | None = None, dlq_dir: str | None = None, query_name: str = "scoring",
                         trigger: dict | None = None, poll_seconds: float = 1.0, commits: str | None = None):
    """Starts the stream. ``scorer_for_batch`` is called at the start of each
    micro-batch (the place for a model refresh) and returns the scorer and
    the model version, or None while there is no model: the batch then waits
    and asks again every ``poll_seconds``, its input uncommitted. With
    ``commits``, a folder, both tables go there in one commit a batch
    (``commits.read_committed``, tables ``predictions`` and ``dlq``) with their
    counts (``commits.stream_counters``), and the two other folders stay unused."""
    spark = messages.sparkSession

    def run(batch: DataFrame, batch_id: int):
        if commits and is_committed(spark, commits, batch_id):
            return
        while (served := scorer_for_batch()) is None:
            time.sleep(poll_seconds)
        scorer, version = served
        b = batch.persist(StorageLevel.MEMORY_AND_DISK)
        preds, dlq = score_batch(b, scorer, version)
        if commits:
            commit_batch(commits, batch_id, {"predictions": (preds, "parquet"), "dlq": (dlq, "parquet")})
        else:
            preds.write.mode("overwrite").parquet(f"{predictions_dir}/batch_id={batch_id}")
            dlq.write.mode("overwrite").parquet(f"{dlq_dir}/batch_id={batch_id}")
        b.unpersist()

    w = messages.writeStream.queryName(query_name).foreachBatch(run) \
        .option("checkpointLocation", stream_checkpoint(spark, query_name))
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()
