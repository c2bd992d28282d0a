import datetime as dt
import json
import os

from pyspark.sql import functions as F

from moodstream.operators import contracts
from moodstream.operators.alerts import SpikeParams
from moodstream.operators import scoring
from moodstream.operators.scoring import score_texts
from moodstream.schemas import JOINED, MESSAGE
from moodstream.sources.messages import read_message_files
from moodstream.streaming import alert_stream, join_stream, scoring_stream
from fakes import make_backend

T0 = dt.datetime(2026, 1, 1)


def write_batches(spark, path, batches):
    """Each batch becomes one Parquet file of message rows (one micro-batch)."""
    off = 0
    for k, values in enumerate(batches):
        rows = []
        for v in values:
            rows.append((None, v.encode() if isinstance(v, str) else v, "t", 0, off, None))
            off += 1
        spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").parquet(path)
    return path


def pred_msg(i, t, label):
    return json.dumps({"schema_version": 1, "id": f"r{i}", "label": label,
                       "predicted_at": (T0 + dt.timedelta(seconds=t)).isoformat() + "+00:00"})


def run_to_end(df, name, checkpoint):
    q = df.writeStream.format("memory").queryName(name).outputMode("append") \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination(300)
    return q


def test_alert_stream_is_brute_force_over_batches(spark, tmp_dir):
    """Late events, batches that end while firing, a batch of bad rows only."""
    from test_alerts import brute, stream_of

    ev = stream_of(21, late=0.15, n=150)
    msgs = [pred_msg(i, t, lab) for i, (t, lab) in enumerate(ev)]
    path = write_batches(spark, f"{tmp_dir}/in", [msgs[:70], ["garbage", "{}"], msgs[70:95] + ["[1]"], msgs[95:]])
    stream = contracts.parse_predictions(read_message_files(spark, path, stream=True, max_files_per_trigger=1))
    params = SpikeParams(25, 0.55, 0.4, 8)
    alert_stream.start_alert_stream(stream, params, f"{tmp_dir}/state", f"{tmp_dir}/alerts", query_name="alerts_t").awaitTermination(300)
    got = [(r["status"], r["window_start"]) for r in spark.read.json(f"{tmp_dir}/alerts").orderBy("batch_id", "window_end", "status").collect()]
    want = [(s, (T0 + dt.timedelta(seconds=a)).isoformat() + "+00:00") for s, _, a in brute(ev, 25, params)]
    assert sorted(got) == sorted(want) and len(want) >= 2
    newest = spark.read.parquet(f"{tmp_dir}/state/kept").where("version = 3")
    edge = max(t for t, _ in ev)
    assert newest.count() == sum(t > edge - 25 for t, _ in ev)


def test_dashboard_refresh_writes_a_version_per_batch(spark, tmp_dir):
    from moodstream.streaming import dashboard_stream

    schema = "id string, label string, text string, confidence double, predicted_at timestamp, joined_at timestamp, end_to_end_ms double, model_version string"
    for k in range(2):
        rows = [(f"i{n}", "negative", "t", 0.5, T0 + dt.timedelta(seconds=10 * n), T0, 5.0, f"m{k}") for n in range(2 * k, 2 * k + 3)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in")
    dashboard_stream.start_dashboard_refresh(stream, f"{tmp_dir}/out", trigger={"availableNow": True}).awaitTermination(300)
    assert dashboard_stream.newest(f"{tmp_dir}/out", "kpis", spark).first()["total"] == 5  # i2 came twice
    assert dashboard_stream.newest(f"{tmp_dir}/out", "bucket_counts", spark).count() == 6
    assert sorted(r["version"] for r in spark.read.parquet(f"{tmp_dir}/out/kpis").collect()) == [0, 1]


def test_join_stream_pairs_and_expires(spark, tmp_dir):
    def raw(i, t):
        return (f"id{i}", "txt", "astd", str(i), T0 + dt.timedelta(seconds=t))

    def pred(i, t):
        return (f"id{i}", "negative", 0.9, "m", T0 + dt.timedelta(seconds=t))

    rs = "id string, text string, source string, source_id string, produced_at timestamp"
    ps = "id string, label string, confidence double, model_version string, predicted_at timestamp"
    os.makedirs(f"{tmp_dir}/r"), os.makedirs(f"{tmp_dir}/p")
    spark.createDataFrame([raw(1, 0), raw(2, 1), raw(1, 2)], rs).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/r")
    spark.createDataFrame([pred(1, 3), pred(3, 4)], ps).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/p")
    # later traffic moves the watermark past the TTL of id2/id3
    spark.createDataFrame([raw(9, 500)], rs).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/r")
    spark.createDataFrame([pred(9, 501)], ps).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/p")
    r = spark.readStream.schema(rs).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/r")
    p = spark.readStream.schema(ps).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/p")
    j = join_stream.join_streams(r, p, ttl_seconds=60, delay_seconds=10)
    q = j.writeStream.format("memory").queryName("joins_s").outputMode("append") \
        .option("checkpointLocation", f"{tmp_dir}/ck").trigger(processingTime="1 second").start()
    for _ in range(4):
        q.processAllAvailable()
        # an empty trigger lets the advanced watermark evict state
    q.stop()
    out = spark.table("joins_s")
    joined = sorted(x["id"] for x in join_stream.joined_rows(out).collect())
    expired = sorted(x["id"] for x in join_stream.expired_rows(out, 60).collect())
    assert joined == ["id1", "id9"]          # id1 raw redelivered: joined once
    assert expired == ["id2", "id3"]
    lost = {x["id"]: x for x in join_stream.expired_rows(out, 60).collect()}
    assert json.loads(lost["id2"]["original_payload"]) == {
        "schema_version": 1, "id": "id2", "text": "txt", "source": "astd", "source_id": "2", "produced_at": "2026-01-01T00:00:01+00:00"}
    assert json.loads(lost["id3"]["original_payload"])["confidence"] == 0.9 and lost["id3"]["failed_at"]
    assert lost["id3"]["source"]["topic"] == "reviews.predictions"
    assert set(join_stream.joined_rows(out).columns) == {f.name for f in JOINED.fields}


def test_join_stream_sinks_and_strict_ttl(spark, tmp_dir):
    rs = "id string, text string, source string, source_id string, produced_at timestamp, topic string, partition int, offset long"
    ps = "id string, label string, confidence double, scores map<string,double>, model_version string, predicted_at timestamp"
    at = lambda s: T0 + dt.timedelta(seconds=s)
    raws = [("a", "x", None, None, at(0), "raw", 1, 7), ("b", "y", None, None, at(0), "raw", 1, 8), ("z", "y", None, None, at(9000), "raw", 1, 9)]
    preds = [("a", "neutral", 0.5, {"neutral": 0.5}, "m", at(2.25)), ("b", "neutral", 0.5, None, "m", at(2.5)), ("z", "neutral", 0.5, None, "m", at(9000))]
    spark.createDataFrame(raws[:2], rs).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/r")
    spark.createDataFrame(raws[2:], rs).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/r")
    spark.createDataFrame(preds[:2], ps).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/p")
    spark.createDataFrame(preds[2:], ps).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/p")
    r = spark.readStream.schema(rs).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/r")
    p = spark.readStream.schema(ps).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/p")
    j = join_stream.join_streams(r, p, ttl_seconds=2.5)
    join_stream.start_join_stream(j, 2.5, f"{tmp_dir}/joined", f"{tmp_dir}/dlq", query_name="join_t").awaitTermination(300)
    rows = {x["id"]: x for x in spark.read.json(f"{tmp_dir}/joined").collect()}
    assert set(rows) == {"a", "z"} and rows["a"]["end_to_end_ms"] == 2250.0 and rows["a"]["scores"]["neutral"] == 0.5
    lost = spark.read.parquet(f"{tmp_dir}/dlq").collect()
    assert sorted(x["error"] for x in lost) == [f"join_ttl_expired: no {s} for id within 2.5s" for s in ("prediction", "raw")]
    assert {tuple(x["source"]) for x in lost} == {("raw", 1, 8), ("reviews.predictions", None, None)}
    assert join_stream.dedupe_period(2.5) == 600 and join_stream.dedupe_period(300) == 1500


def test_scoring_stream_isolates_poison(spark, tmp_dir):
    def raw(i, text):
        return json.dumps({"schema_version": 1, "id": f"r{i}", "text": text})

    path = write_batches(spark, f"{tmp_dir}/in", [[raw(1, "ok one"), raw(2, "poison"), raw(3, "ok three"),
                                                   "{not json"]])
    stream = read_message_files(spark, path, stream=True)
    q = scoring_stream.start_scoring_stream(
        stream, lambda: ((lambda df: score_texts(df, make_backend)), "fake@1"),
        f"{tmp_dir}/pred", f"{tmp_dir}/dlq", query_name="scoring_t")
    q.awaitTermination(300)
    preds = spark.read.parquet(f"{tmp_dir}/pred").collect()
    assert sorted(r["id"] for r in preds) == ["r1", "r3"]
    assert preds[0]["label"] == "positive" and preds[0]["confidence"] == 0.7
    assert preds[0]["model_version"] == "fake@1"
    dlq = spark.read.parquet(f"{tmp_dir}/dlq").collect()
    errs = sorted(r["error"] for r in dlq)
    assert errs == ["RuntimeError: boom", "ValueError: not valid UTF-8 JSON"]


def test_score_texts_batch(spark):
    df = spark.createDataFrame([("a", "fine"), ("b", "poison"), ("c", None)], "id string, text string")
    out = {r["id"]: r for r in score_texts(df, make_backend, version="fake@1").collect()}
    assert out["c"]["label"] is None and out["c"]["error"] == "ValueError: no text"
    assert out["a"]["label"] == "positive" and out["a"]["scores"]["positive"] == 0.7
    assert out["b"]["label"] is None and out["b"]["error"] == "RuntimeError: boom"
    assert F is not None


def test_backends_are_kept_by_version():
    built = []

    def factory(name):
        return lambda: built.append(name) or name

    assert [scoring._backend(factory(n), v) for n, v in (("a", "1"), ("b", "1"), ("c", "2"), ("d", "1"), ("e", None), ("f", None))] == ["a", "a", "c", "d", "e", "f"]
    assert built == ["a", "c", "d", "e", "f"]
    scoring._HELD.clear()


class FakeModel:
    def __init__(self, labels):
        self.labels = labels


def test_model_folder_is_followed(spark, tmp_dir):
    folder, loads = f"{tmp_dir}/models/senti", []

    def put(name, text, mtime):
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)
        os.utime(f"{folder}/{name}", (mtime, mtime))

    def load(path):
        loads.append(path)
        with open(f"{path}/weights") as f:
            text = f.read()
        if text == "broken":
            raise OSError(text)
        return FakeModel(text.split(","))

    step = lambda slot, now: scoring.next_slot(slot, spark, folder, load, now=now, every=5, settle=2)
    slot = step(scoring.Slot(), 1000.0)
    assert not slot.ready and loads == []                       # no folder yet
    put("weights", "negative,neutral,positive", 1003.0)
    slot = step(slot, 1004.0)
    assert not slot.ready and loads == []                       # looked a moment ago
    slot = step(slot, 1004.99 + 0.02)
    assert slot.ready and slot.version == "senti@1003" and len(loads) == 1
    slot = step(slot, 1020.0)
    assert len(loads) == 1                                      # nothing new
    put("weights", "broken", 1029.0)
    slot = step(slot, 1030.0)
    assert len(loads) == 1                                      # still being written
    slot = step(slot, 1036.0)
    assert len(loads) == 2 and slot.version == "senti@1003" and slot.ready
    slot = step(slot, 1042.0)
    assert len(loads) == 2                                      # not tried again
    put("weights", "good,bad", 1043.0)
    slot = step(slot, 1050.0)
    assert len(loads) == 3 and slot.version == "senti@1003"     # other labels
    put("weights", "positive,negative,neutral", 1052.0)
    os.makedirs(f"{folder}/training_meta")
    put("training_meta/part-0.txt", '{"model_version": "senti-v7", "labels": []}', 1053.0)
    slot = step(slot, 1060.0)
    assert slot.version == "senti-v7" and slot.model.labels[0] == "positive"


def test_scoring_waits_for_a_model(spark, tmp_dir):
    path = write_batches(spark, f"{tmp_dir}/in", [[json.dumps({"schema_version": 1, "id": "w", "text": "hello"})]])
    asked = []

    def scorer():
        asked.append(1)
        return None if len(asked) < 3 else ((lambda df: score_texts(df, make_backend)), "late@1")

    q = scoring_stream.start_scoring_stream(read_message_files(spark, path, stream=True), scorer, f"{tmp_dir}/p", f"{tmp_dir}/d", query_name="wait_t", poll_seconds=0.1)
    q.awaitTermination(300)
    assert len(asked) == 3 and spark.read.parquet(f"{tmp_dir}/p").first()["model_version"] == "late@1"


def test_timers_ask_for_their_state_store(spark):
    import pytest

    from moodstream.streaming import join_timers

    df = spark.createDataFrame([], "id string, payload string, topic string, partition int, offset long")
    with pytest.raises(RuntimeError):
        join_timers.join_with_timers(df)


def test_processing_time_join_expires_on_quiet_stream(spark, tmp_dir):
    import time

    from moodstream.streaming import join_timers

    rows = [("a", '{"id": "a", "text": "x"}', "reviews.raw", 0, 1),
            ("a", '{"id": "a", "label": "negative"}', "reviews.predictions", 0, 1),
            ("a", '{"id": "a", "text": "x"}', "reviews.raw", 0, 2),          # redelivered after join
            ("b", '{"id": "b", "text": "y"}', "reviews.raw", 0, 3),          # no prediction
            ("c", '{"id": "c", "label": "neutral"}', "reviews.predictions", 0, 4),  # no raw
            ("d", '{"id": "d", "text": "z"}', "reviews.raw", 0, 5),
            ("d", '{"id": "d", "text": "z"}', "reviews.raw", 0, 6)]          # pending duplicate
    schema = "id string, payload string, topic string, partition int, offset long"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_dir}/in")
    src = spark.readStream.schema(schema).parquet(f"{tmp_dir}/in")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", join_timers.ROCKSDB)
    out = join_timers.join_with_timers(src, ttl_seconds=2, dedupe_seconds=60)
    q = out.writeStream.format("memory").queryName("tws_join").outputMode("append") \
        .option("checkpointLocation", f"{tmp_dir}/ck").trigger(processingTime="1 second").start()
    try:
        # no processAllAvailable(): it never returns while timers are pending
        deadline = time.time() + 120
        while time.time() < deadline:
            time.sleep(2)
            assert q.exception() is None
            if spark.table("tws_join").where("outcome = 'expired'").count() >= 3:
                break
    finally:
        q.stop()
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    res = sorted((r["outcome"], r["id"]) for r in spark.table("tws_join").collect())
    assert res == [("duplicate", "a"), ("duplicate", "d"), ("expired", "b"), ("expired", "c"),
                   ("expired", "d"), ("joined", "a")]
    err = {r["id"]: r["error"] for r in spark.table("tws_join").where("outcome = 'expired'").collect()}
    assert err["b"] == "join_ttl_expired: no prediction for id within 2.0s"
    assert err["c"] == "join_ttl_expired: no raw for id within 2.0s"
