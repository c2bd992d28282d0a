"""The event-time stream join against the batch join over the same halves."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from moodstream.operators import join_chains
from moodstream.streaming import join_ordered
from moodstream.streaming.commits import read_committed, stream_counters
from moodstream.streaming.join_timers import ROCKSDB, start_timer_join
from test_join_chains import DEDUPE, T0, TTL, halves_of

SCHEMA = "id string, payload string, topic string, partition int, offset long, at timestamp"
TOPICS = {"raw": "reviews.raw", "prediction": "reviews.predictions"}
END = [("end", "raw", 100_000, 0)]  # moves the watermark past everything before


@pytest.fixture()
def rocksdb(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def row(name, side, t, offset):
    at = None if t is None else T0 + dt.timedelta(seconds=t)
    return (name, str(offset), TOPICS[side], 0, offset, at)


def write(spark, path, batches):
    """One file a batch, in this order."""
    for rows in batches:
        spark.createDataFrame([row(*r) for r in rows], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def outcomes(rows):
    return sorted([(r["id"], r["outcome"], r["at_us"], r["raw_payload"], r["prediction_payload"]) for r in rows if r["outcome"] != "duplicate"], key=str)


def batch_outcomes(spark, rows):
    df = spark.createDataFrame([(i, s, None if t is None else T0 + dt.timedelta(seconds=t), o) for i, s, t, o in rows], "id string, side string, at timestamp, offset long")
    epochs = join_chains.join_chains(df, TTL, DEDUPE)
    counts = {r["outcome"]: r["n"] for r in join_chains.chain_outcomes(df, epochs).collect()}
    joined = F.col("outcome") == "joined"
    text = lambda side: F.when(joined | (F.col("side") == side), F.col(f"{side}_offset").cast("string")).alias(f"{side}_payload")
    told = epochs.select("id", "outcome", F.unix_micros("ended_at").alias("at_us"), text("raw"), text("prediction"))
    return outcomes(told.collect()), counts


def test_any_order_of_files_and_batches(spark, tmp_dir, rocksdb):
    """Everything shuffled over the batches, with one id that has most rows."""
    rows = halves_of(3, n=250) + [("twice", "raw", 50, 2000), ("twice", "raw", 50, 2000), ("x", "raw", None, 2001), (None, "raw", 5, 2002)]
    random.Random(4).shuffle(rows)
    write(spark, f"{tmp_dir}/in", [rows[:90], rows[90:100], rows[100:], END])
    src = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in")
    q = join_ordered.join_in_order(src, TTL, 1000, DEDUPE).writeStream.format("memory").queryName("ordered_any").outputMode("append") \
        .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = spark.table("ordered_any").collect()
    want, counts = batch_outcomes(spark, [r for r in rows if r[0] is not None])
    assert outcomes(got) == want and min(counts.values()) >= 20
    assert sum(r["outcome"] == "duplicate" for r in got) == counts["duplicates"]


def test_outcomes_come_as_the_watermark_passes(spark, tmp_dir, rocksdb):
    """Halves up to 30 s late over many batches into the committed sinks; the
    query ends in the middle and starts again from its checkpoint."""
    rnd = random.Random(8)
    rows = sorted(halves_of(6, n=250), key=lambda r: r[2] + rnd.random() * 30)
    cuts = [0, 40, 80, 81, 150, 220, len(rows)]
    batches = [rows[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    path, commits = f"{tmp_dir}/in", f"{tmp_dir}/commits"

    def run():
        src = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
        start_timer_join(join_ordered.join_in_order(src, TTL, 31, DEDUPE), commits, "ordered_late", {"availableNow": True}).awaitTermination(300)
        pairs, lost = read_committed(spark, commits, "joined"), read_committed(spark, commits, "dlq")
        return sorted((r["id"], r["raw_payload"], r["prediction_payload"]) for r in pairs.collect()), lost.collect()

    write(spark, path, batches[:4])
    early, _ = run()
    write(spark, path, [*batches[4:], END])
    pairs, lost = run()
    want, counts = batch_outcomes(spark, rows)
    assert pairs == sorted((w[0], w[3], w[4]) for w in want if w[1] == "joined")
    assert early and set(early) < set(pairs)  # what the watermark had passed, and right the first time
    assert sorted(r["original_payload"] for r in lost) == sorted(w[3] or w[4] for w in want if w[1] == "expired")
    assert {r["error"] for r in lost} == {f"join_ttl_expired: no {s} for id within {float(TTL)}s" for s in ("raw", "prediction")}
    counted = stream_counters(spark, commits, sent=("joined",)).first()
    assert (counted["sent"], counted["failed"]) == (counts["joined"], counts["expired"])


def test_it_asks_for_its_state_store(spark):
    with pytest.raises(RuntimeError):
        join_ordered.join_in_order(spark.createDataFrame([], SCHEMA), TTL, 10)
