"""The dashboard kept by changes against a full recompute after every batch."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from moodstream.operators import dashboard
from moodstream.sources.files import dedupe_first
from moodstream.streaming import dashboard_state as state
from moodstream.streaming.join_timers import ROCKSDB

T0 = dt.datetime(2026, 3, 1, 22)
SCHEMA = "id string, label string, text string, confidence double, predicted_at timestamp, joined_at timestamp, end_to_end_ms double, model_version string"


def batches_of(seed, n_batches=7):
    rnd, out = random.Random(seed), []
    for b in range(n_batches):
        rows = []
        for k in range(rnd.choice([3, 25, 60])):
            # Ids come back in later batches, often with an earlier joined_at: they withdraw the row that counted.
            i = rnd.choice([f"i{rnd.randrange(60)}", f"n{b}-{k}", "hot"])
            rows.append((i, rnd.choice(["negative", "neutral", "positive", "positive", "odd", None]), f"text {b} {k}", rnd.random(),
                         None if rnd.random() < 0.05 else T0 + dt.timedelta(seconds=rnd.randrange(3 * 3600)),
                         None if rnd.random() < 0.05 else T0 + dt.timedelta(microseconds=rnd.randrange(10**9) + (n_batches - b) * 10**8), rnd.choice([None, 1.5, 2.0, 7.25, rnd.random()]),
                         f"m{b // 3}"))
        out.append(rows)
    out[2].append((None, "neutral", "no id", 0.1, T0, T0, 3.0, "m0"))
    return out


def same(a, b):
    def told(df):
        return sorted(([round(v, 9) if isinstance(v, float) else v for v in r] for r in df.collect()), key=str)

    assert sorted(a.columns) == sorted(b.columns)
    assert told(a.select(*sorted(a.columns))) == told(b.select(*sorted(a.columns)))


def test_every_version_equals_a_full_recompute(spark, tmp_dir):
    given, folder = batches_of(3), f"{tmp_dir}/state"
    for rows in given:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in")
        state.start_incremental_dashboard(stream, folder, query_name="state_t", trigger={"availableNow": True}).awaitTermination(600)
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    last = state.newest_version(spark, folder)
    assert last >= len(given) - 1
    withdrawn = 0
    for v in range(len(given)):
        seen = dedupe_first(spark.createDataFrame([r for rows in given[: v + 1] for r in rows], SCHEMA), "id", ["joined_at"])
        made = state.tables(spark, folder, 30, version=v, n_latest=9)
        same(made["kpis"], dashboard.kpis(seen))
        if v in (1, 4, 6):
            same(made["bucket_counts"], dashboard.bucket_counts(seen, 30))
        same(made["latest"], dashboard.latest(seen, 9))
        withdrawn = max(withdrawn, sum(len(r) for r in given[: v + 1]) - seen.count())
    assert withdrawn > 30
    # What is not named by the last two versions goes, and the newest still reads.
    before = state.tables(spark, folder)["kpis"].collect()
    gone = state.prune(spark, folder)
    assert "ledger/0-0" in gone and state.prune(spark, folder) == []
    assert state.tables(spark, folder)["kpis"].collect() == before


def test_a_batch_costs_what_it_holds_and_a_failed_one_is_replaced(spark, tmp_dir):
    one = spark.createDataFrame([(f"x{i}", "neutral", "t", 0.5, 10_000_000 * i, 0, 1.0, "m", 1) for i in range(3)], state.CHANGES)
    torn = spark.createDataFrame([("y", "negative", "t", 0.5, 0, 0, 1.0, "m", 1)], state.CHANGES)
    state.apply_changes(one, tmp_dir, 0)
    # A batch that stops before its version is written is not seen, and runs again.
    state.apply_changes(torn, f"{tmp_dir}/torn", 0)
    torn.groupBy("label").count().write.parquet(f"{tmp_dir}/ledger/0-1")
    assert state.newest_version(spark, tmp_dir) == 0 and state.tables(spark, tmp_dir)["kpis"].first()["total"] == 3
    state.apply_changes(one.withColumn("id", F.concat(F.lit("z"), "id")), tmp_dir, 1)
    state.apply_changes(one.withColumn("change", F.lit(-1)), tmp_dir, 2)
    got = state.tables(spark, tmp_dir)
    assert got["kpis"].first()["total"] == 3 and sorted(r["text"] for r in got["latest"].collect()) == ["t"] * 3
    assert [state.segments(n) for n in (0, 1, 2, 6, 7)] == [[], [(0, 0)], [(0, 1)], [(0, 3), (4, 5)], [(0, 3), (4, 5), (6, 6)]]
    # Every row is written again at most log2 times.
    assert sum(hi - lo + 1 for n in range(1, 65) for lo, hi in state.segments(n)[-1:]) <= 64 * 7
    with pytest.raises(ValueError):
        state.tables(spark, tmp_dir, 15)


def test_state_of_ids_asks_for_its_store(spark):
    with pytest.raises(RuntimeError):
        state.changes(spark.createDataFrame([], SCHEMA))
