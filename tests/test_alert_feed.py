import json

from moodstream.operators.alerts import alert_status
from moodstream.schemas import ALERTS_TOPIC, MESSAGE
from moodstream.sources.messages import read_message_files
from moodstream.streaming import alert_feed
from moodstream.streaming.commits import stream_counters


def alert(k, status):
    return json.dumps({"schema_version": 1, "alert_id": f"a{k}", "status": status, "window_end": f"2026-01-01T00:00:{k:02d}+00:00", "threshold": 0.5 + k / 100, "more": 1})


def put(spark, path, first, values):
    rows = [(None, v if isinstance(v, bytes) else v.encode(), ALERTS_TOPIC, 0, first + k, None) for k, v in enumerate(values)]
    spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").parquet(path)


def test_feed_skips_bad_messages_and_keeps_what_it_has(spark, tmp_dir):
    path, commits = f"{tmp_dir}/in", f"{tmp_dir}/feed"
    assert alert_feed.snapshot(spark, commits).count() == 0

    def run():
        stream = read_message_files(spark, path, stream=True, max_files_per_trigger=1)
        q = alert_feed.start_alert_feed(stream, commits, "feed_t", {"availableNow": True})
        try:
            q.awaitTermination(300)
        except Exception:
            pass
        return q

    put(spark, path, 0, [alert(1, "firing"), "{torn", b"\xff\xfe", alert(2, "resolved")])
    put(spark, path, 4, ["[1]", alert(3, "firing"), "{}"])
    q = run()
    assert alert_feed.last_error(q) is None
    held = alert_feed.snapshot(spark, commits)
    assert [(r["offset"], r["alert_id"], r["status"]) for r in held.orderBy("offset").collect()] == [(0, "a1", "firing"), (3, "a2", "resolved"), (5, "a3", "firing"), (6, None, None)]
    status = alert_status(held.where("status IS NOT NULL"), tie_cols=("offset",)).first()
    assert (status["fired"], round(status["last_threshold"], 2)) == (2, 0.53)
    counts = stream_counters(spark, commits, sent=("alerts",), failed=("skipped",)).first()
    assert (counts["sent"], counts["failed"]) == (4, 3)

    with open(f"{path}/part-broken.parquet", "wb") as f:  # the source fails
        f.write(b"not parquet")
    q = run()
    assert "part-broken" in alert_feed.last_error(q) or "parquet" in alert_feed.last_error(q).lower()
    assert alert_feed.snapshot(spark, commits).count() == 4
