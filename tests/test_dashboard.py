import datetime as dt
import json

from moodstream.operators import dashboard
from moodstream.plans.calendar import span_buckets
from moodstream.sources.files import load_joined

T0 = dt.datetime(2025, 5, 17, 8)


def preds(spark, rows):
    return spark.createDataFrame(
        [(f"p{i}", lab, T0 + dt.timedelta(seconds=s), lat, f"v{i % 2}") for i, (s, lab, lat) in enumerate(rows)],
        "id string, label string, predicted_at timestamp, end_to_end_ms double, model_version string")


def test_buckets_are_filled_with_zeros(spark):
    df = preds(spark, [(4, "positive", None), (11, "negative", None), (19, "negative", None), (12, "positive", None), (13, "neutral", None), (77, "neutral", None)])
    out = dashboard.bucket_counts(df, 20).collect()
    wide = {}
    for r in out:
        wide.setdefault(int((r["bucket"] - T0).total_seconds()), {})[r["label"]] = r["count"]
    assert wide == {0: {"negative": 2, "neutral": 1, "positive": 2}, 20: {"negative": 0, "neutral": 0, "positive": 0},
                    40: {"negative": 0, "neutral": 0, "positive": 0}, 60: {"negative": 0, "neutral": 1, "positive": 0}}
    assert {r["negative_share"] for r in out if r["bucket"] == T0} == {0.4}
    assert dashboard.bucket_counts(df.limit(0), 20).count() == 0
    sorted_rows = dashboard.sort_counts(dashboard.bucket_counts(df, 20)).collect()
    assert [(r["bucket"], r["label"]) for r in sorted_rows] == sorted((r["bucket"], r["label"]) for r in out)


def test_kpis(spark):
    k = dashboard.kpis(preds(spark, [(i, "negative" if i % 4 == 0 else "positive", float(7 * i)) for i in range(8)])).first()
    assert (k["total"], k["negative_share"], k["neutral_share"], k["positive_share"]) == (8, 0.25, 0.0, 0.75)
    assert k["p50_latency_ms"] == 24.5 and abs(k["p95_latency_ms"] - 46.55) < 1e-9
    assert k["model_versions"] == ["v0", "v1"]
    none = dashboard.kpis(preds(spark, [(0, "neutral", None)])).first()
    assert none["p50_latency_ms"] is None and none["total"] == 1 and none["neutral_share"] == 1.0


def test_label_shares_count_rows_with_a_label(spark):
    rows = [(i, lab, None) for i, lab in enumerate(["negative"] * 3 + ["neutral"] * 5 + ["odd", None, None])]
    got = {r["label"]: (r["count"], round(r["share"], 4)) for r in dashboard.label_shares(preds(spark, rows)).collect()}
    assert got == {"negative": (3, 0.3333), "neutral": (5, 0.5556), "odd": (1, 0.1111)}


def test_latest_and_ranges(spark):
    df = preds(spark, [(i * 45, "neutral", None) for i in range(100)])
    assert [r["id"] for r in dashboard.latest(df, 2, columns=["id"]).collect()] == ["p99", "p98"]
    assert dashboard.last_minutes(df, 3).count() == 5  # 180 s back, both ends
    assert [dashboard.time_range(df, c).count() for c in ("All", "5 min", "30 min", "2 h")] == [100, 7, 41, 100]
    times = [r["predicted_at"] for r in dashboard.sort_by_time(df.orderBy("id")).collect()]
    assert times == sorted(times)


def test_joined_lines_are_deduplicated_and_torn_ones_dropped(spark, tmp_dir):
    path = f"{tmp_dir}/rows.jsonl"
    made = lambda i, s: json.dumps({"id": i, "label": "neutral", "joined_at": f"2025-05-17T08:00:{s:02d}+00:00", "confidence": 0.5})
    with open(path, "w") as f:
        f.write("\n".join([made("k1", 30), made("k2", 9), made("k1", 4), made("k3", 1)[:25]]))
    assert sorted((r["id"], r["joined_at"].second) for r in load_joined(spark, path).collect()) == [("k1", 4), ("k2", 9)]
    assert load_joined(spark, path, dedupe=False).count() == 3
    assert load_joined(spark, f"{tmp_dir}/absent.jsonl").count() == 0


def test_overlay_closes_an_open_interval_at_the_last_bucket(spark):
    df = preds(spark, [(s, "negative", None) for s in range(0, 150, 6)])
    iv = spark.createDataFrame([(T0 + dt.timedelta(seconds=31), T0 + dt.timedelta(seconds=75), 0.8), (T0 + dt.timedelta(seconds=105), None, 0.6)],
                               "start timestamp, `end` timestamp, peak_share double")
    out = {int((r["bucket"] - T0).total_seconds()): r for r in dashboard.share_overlay(dashboard.bucket_counts(df, 15), iv, 15).collect()}
    assert {s: r["peak_share"] for s, r in out.items()} == {0: None, 15: None, 30: None, 45: 0.8, 60: 0.8, 75: 0.8, 90: None, 105: 0.6, 120: 0.6, 135: 0.6}
    assert out[135]["alert_end"] == T0 + dt.timedelta(seconds=135)


def test_overlay_of_keyed_and_overlapping_intervals(spark):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    counts = spark.createDataFrame([(k, at(s), "negative", 0.5, 2) for k, last in (("a", 60), (None, 30)) for s in range(0, last + 1, 15)],
                                   "k string, bucket timestamp, label string, negative_share double, total long")
    iv = spark.createDataFrame([("a", at(10), at(30), 0.1), ("a", at(20), None, 0.2), (None, at(15), None, 0.3), ("gone", at(0), None, 0.4)],
                               "k string, start timestamp, end timestamp, peak_share double")
    got = [(r["k"], int((r["bucket"] - T0).total_seconds()), r["peak_share"], r["alert_end"]) for r in dashboard.share_overlay(counts, iv, keys=["k"]).collect()]
    want = [("a", 0, None, None), ("a", 15, 0.1, at(30)), ("a", 30, 0.1, at(30))] + [("a", s, 0.2, at(60)) for s in (30, 45, 60)]
    assert sorted(got, key=str) == sorted(want + [(None, 0, None, None), (None, 15, 0.3, at(30)), (None, 30, 0.3, at(30))], key=str)


def test_a_long_span_is_made_in_many_tasks(spark):
    spans = spark.createDataFrame([(5, 10_003, "a"), (7, 9, "b")], "lo long, hi long, k string")
    df = span_buckets(spans, "lo", "hi", 10, chunk=50)
    assert sorted(r["bucket_us"] for r in df.where("k = 'a'").collect()) == list(range(10, 10_001, 10))
    assert df.where("k = 'b'").count() == 0
    sizes = spark.createDataFrame([(0, 10**6, "a")], "lo long, hi long, k string")
    parts = span_buckets(sizes, "lo", "hi", 10, chunk=1000).rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
    assert sum(parts) == 100_001 and max(parts) < 80_000


def test_alert_table_and_label_order(spark):
    a = spark.createDataFrame([("firing", "2025-05-17T08:10:00+00:00", 9, 12, 0.75, 0.6, 1), ("resolved", "2025-05-17T08:25:00+00:00", 2, 10, 0.2, 0.6, 2)],
                              "status string, window_end string, negative long, total long, negative_share double, threshold double, other int")
    t = dashboard.alert_table(a)
    assert t.columns == dashboard.ALERT_COLUMNS and [r["status"] for r in t.collect()] == ["resolved", "firing"]
    labs = spark.createDataFrame([("neutral",), ("positive",), ("none",)], "label string")
    assert [r[0] for r in labs.select(dashboard.label_ordinal()).collect()] == [1, 2, None]
