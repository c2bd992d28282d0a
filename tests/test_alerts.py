import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from moodstream.operators import alerts
from moodstream.operators.alerts import SpikeParams

T0 = dt.datetime(2025, 3, 9)
NEG, POS = "negative", "positive"


def frame(spark, events):
    """events: (seconds, label) in order of arrival; seq = position."""
    rows = [(i, T0 + dt.timedelta(seconds=s), lab) for i, (s, lab) in enumerate(events)]
    return spark.createDataFrame(rows, "seq long, predicted_at timestamp, label string")


def brute(events, w, params=None):
    """Per event, all that arrived before it; transitions with params."""
    out, firing = [], False
    for i, (_, _) in enumerate(events):
        edge = max(t for t, _ in events[: i + 1])
        inside = [(t, lab) for t, lab in events[: i + 1] if t > edge - w]
        neg = sum(lab == NEG for _, lab in inside)
        rec = {"seq": i, "total": len(inside), "negative": neg, "end": edge, "start": min((t for t, _ in inside), default=edge)}
        if params is None:
            out.append(rec)
        elif len(inside) >= params.min_count:
            share = neg / len(inside)
            if share >= params.threshold if not firing else share < params.rearm_below:
                firing = not firing
                out.append(("firing" if firing else "resolved", i, rec["start"]))
    return out


def stream_of(seed, late=0.0, n=500):
    rnd, t, ev = random.Random(seed), 0, []
    for k in range(n):
        t += rnd.choice([0, 0, 1, 2, 4, 9])
        at = t - rnd.choice([3, 17, 60]) if rnd.random() < late else t
        ev.append((at, NEG if rnd.random() < (0.75 if k // 90 % 2 else 0.25) else POS))
    return ev + [(t, NEG)] * 90 + [(t + 1, POS)] * 90


def test_window_is_open_on_the_left(spark):
    df = frame(spark, [(3, NEG), (13, POS), (20, NEG), (23, POS)])
    r = {x["seq"]: x for x in alerts.sliding_share(df, 10).collect()}
    assert [(r[i]["total"], r[i]["negative"]) for i in range(4)] == [(1, 1), (1, 0), (2, 1), (2, 1)]
    assert r[1]["window_start"] == T0 + dt.timedelta(seconds=13)
    assert r[3]["negative_share"] == 0.5 and r[3]["window_end"] == T0 + dt.timedelta(seconds=23)


def test_parameters_are_checked():
    for bad in ({"threshold": 0.2, "rearm_below": 0.6}, {"threshold": 1.2}, {"threshold": 0.5, "rearm_below": -0.1}):
        with pytest.raises(ValueError):
            SpikeParams(30, **bad)
    with pytest.raises(ValueError):
        SpikeParams(0)
    assert SpikeParams(30, threshold=0.75).rearm_below == 0.6


@pytest.mark.parametrize("seed", [11, 12])
def test_batch_detection_is_brute_force(spark, seed):
    ev = stream_of(seed)
    df, w = frame(spark, ev), 25
    got = {r["seq"]: r for r in alerts.sliding_share(df, w, num_partitions=5).collect()}
    for rec in brute(ev, w):
        g = got[rec["seq"]]
        assert (g["total"], g["negative"]) == (rec["total"], rec["negative"])
        assert g["window_start"] == T0 + dt.timedelta(seconds=rec["start"])
    p = SpikeParams(w, 0.55, 0.4, 8)
    want = [(s, i) for s, i, _ in brute(ev, w, p)]
    spikes = alerts.detect_spikes(df, p, block_rows=32, num_partitions=5).orderBy("seq").collect()
    assert [(r["status"], r["seq"]) for r in spikes] == want and len(want) >= 4
    assert [s for s, _ in want[:2]] == ["firing", "resolved"]


def test_too_few_events_change_nothing(spark):
    assert alerts.detect_spikes(frame(spark, [(i, NEG) for i in range(6)]), SpikeParams(90, 0.5, min_count=7)).count() == 0
    assert alerts.detect_spikes(frame(spark, [(i, NEG) for i in range(7)]), SpikeParams(90, 0.5, min_count=7)).count() == 1


@pytest.mark.parametrize("seed", [3, 4])
def test_late_events_count_from_their_arrival(spark, seed):
    ev = stream_of(seed, late=0.2, n=300)
    df, w = frame(spark, ev), 25
    got = {r["seq"]: r for r in alerts.arrival_share(df, w, ["seq"], num_partitions=4).collect()}
    for rec in brute(ev, w):
        g = got[rec["seq"]]
        assert (g["total"], g["negative"], g["window_end"]) == (rec["total"], rec["negative"], T0 + dt.timedelta(seconds=rec["end"]))
    p = SpikeParams(w, 0.55, 0.4, 8)
    spikes = alerts.arrival_spikes(df, p, ["seq"], block_rows=32, num_partitions=4).orderBy("seq").collect()
    want = brute(ev, w, p)
    assert [(r["status"], r["seq"], r["window_start"]) for r in spikes] == [(s, i, T0 + dt.timedelta(seconds=a)) for s, i, a in want]
    assert len(want) >= 2


def test_late_event_outside_the_window_is_dropped(spark):
    r = {x["seq"]: x for x in alerts.arrival_share(frame(spark, [(50, POS), (44, NEG), (39, NEG), (58, POS)]), 10, ["seq"]).collect()}
    assert [(r[i]["total"], r[i]["negative"]) for i in range(4)] == [(1, 0), (2, 1), (2, 1), (2, 0)]


def test_alert_payload(spark):
    p = SpikeParams(45, 0.6, min_count=3)
    a = alerts.build_alerts(alerts.detect_spikes(frame(spark, [(1, NEG), (2, POS), (4, NEG)]), p), p).first()
    assert (a["window_start"], a["window_end"]) == ("2025-03-09T00:00:01+00:00", "2025-03-09T00:00:04+00:00")
    assert (a["total"], a["negative"], a["negative_share"], a["status"], a["type"]) == (3, 2, 0.6667, "firing", "negative_spike")
    assert (a["window_seconds"], a["threshold"], a["min_count"]) == (45.0, 0.6, 3) and len(a["alert_id"]) == 36 and a["emitted_at"]


def feed(spark, rows):
    return spark.createDataFrame([(s, f"2025-03-09T{m // 60:02d}:{m % 60:02d}:00+00:00", x, q) for s, m, x, q in rows],
                                 "status string, window_end string, negative_share double, seq long") \
        .withColumn("threshold", 0.01 * F.col("seq")).withColumn("window_seconds", F.lit(90.0))


def test_intervals_pair_firing_with_the_next_resolved(spark):
    df = feed(spark, [("resolved", 2, 0.1, 1), ("firing", 5, 0.7, 2), ("firing", 6, 0.8, 3), ("resolved", 9, 0.2, 4), ("resolved", 10, 0.1, 5), ("firing", 31, 0.9, 6)])
    out = alerts.alert_intervals(df).orderBy("start").collect()
    assert [(r["start"].minute, r["end"] and r["end"].minute, r["peak_share"]) for r in out] == [(5, 9, 0.7), (31, None, 0.9)]
    status = alerts.alert_status(df).first()
    assert (status["fired"], status["last_threshold"]) == (3, pytest.approx(0.06))


def test_alerts_of_one_instant_keep_their_order(spark):
    both = feed(spark, [("firing", 5, 0.7, 1), ("resolved", 5, 0.2, 4)])
    (r,) = alerts.alert_intervals(both).collect()
    assert r["start"] == r["end"]
    turned = feed(spark, [("firing", 4, 0.7, 0), ("resolved", 5, 0.2, 1), ("firing", 5, 0.6, 4)])
    assert [r["end"] is None for r in alerts.alert_intervals(turned).orderBy("start", F.col("end").isNull()).collect()] == [False, True]


def test_intervals_per_key(spark):
    df = feed(spark, [("firing", 1, 0.7, 1), ("firing", 2, 0.7, 2), ("resolved", 3, 0.7, 3), ("resolved", 8, 0.1, 4)]).withColumn("k", F.col("seq") % 2)
    out = alerts.alert_intervals(df, ["k"]).orderBy("k").collect()
    assert [(r["k"], r["start"].minute, r["end"].minute) for r in out] == [(0, 2, 8), (1, 1, 3)]
    assert alerts.alert_intervals(df.limit(0)).count() == 0 and alerts.alert_status(df.limit(0)).first()["fired"] == 0


def test_no_window_over_all_rows(spark):
    """Windows without a partition key run over one row per range partition only."""
    df = frame(spark, stream_of(5))
    for out in (alerts.detect_spikes(df, SpikeParams(25, 0.5)), alerts.alert_intervals(feed(spark, [("firing", 1, 0.5, 1)]))):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        for line in plan.split("\n"):
            if "Window [" in line and "[], [" in line:
                assert "_pid" in line


def keyed_streams(n=150):
    """A hot key with most of the events, some small ones, one null key, one of a single event."""
    out = []
    for key, seed, size in (("hot", 31, 4 * n), ("a", 32, n), ("b", 33, n // 2), (None, 34, n)):
        out += [(key, k, e) for k, e in enumerate(stream_of(seed, late=0.2, n=size))]
    return out + [("z", 0, (5, NEG))]


def keyed_frame(spark, rows):
    data = [(k, i * 1000 + j, T0 + dt.timedelta(seconds=s), lab) for j, (k, i, (s, lab)) in enumerate(rows)]
    return spark.createDataFrame(data, "k string, seq long, predicted_at timestamp, label string").repartition(3), {d[1]: r for d, r in zip(data, rows, strict=True)}


@pytest.mark.parametrize("parts", [1, 9])
def test_each_key_is_a_stream_of_its_own(spark, parts):
    rows = keyed_streams()
    df, by_seq = keyed_frame(spark, rows)
    w, p = 25, SpikeParams(25, 0.55, 0.4, 8)
    want, spikes, ordered, ordered_spikes = {}, set(), {}, set()
    for key in {r[0] for r in rows}:
        of = [(seq, r[2]) for seq, r in sorted(by_seq.items()) if r[0] == key]
        for made, raised, own in ((want, spikes, of), (ordered, ordered_spikes, sorted(of, key=lambda x: (x[1][0], x[0])))):
            events = [e for _, e in own]
            made.update({(key, own[r["seq"]][0]): (r["total"], r["negative"], r["start"], r["end"]) for r in brute(events, w)})
            raised |= {(key, s, own[i][0], a) for s, i, a in brute(events, w, p)}
    seconds = lambda t: int((t - T0).total_seconds())
    got = {(r["k"], r["seq"]): (r["total"], r["negative"], seconds(r["window_end"])) for r in alerts.arrival_share(df, w, ["seq"], num_partitions=parts, keys=["k"]).collect()}
    assert got == {k: (v[0], v[1], v[3]) for k, v in want.items()}
    late = alerts.arrival_spikes(df, p, ["seq"], block_rows=32, num_partitions=parts, keys=["k"]).collect()
    assert {(r["k"], r["status"], r["seq"], seconds(r["window_start"])) for r in late} == spikes and len(late) == len(spikes) > 6
    got = {(r["k"], r["seq"]): (r["total"], r["negative"], seconds(r["window_start"]), seconds(r["window_end"]))
           for r in alerts.sliding_share(df, w, num_partitions=parts, keys=["k"]).collect()}
    assert got == ordered
    found = alerts.detect_spikes(df, p, block_rows=32, num_partitions=parts, keys=["k"]).collect()
    assert {(r["k"], r["status"], r["seq"], seconds(r["window_start"])) for r in found} == ordered_spikes and found[0].asDict().keys() >= {"k", "seq"}


def test_first_time_after_crosses_partitions(spark):
    import random as rnd_

    from moodstream.plans.ordered import first_time_after

    rnd = rnd_.Random(8)
    events = [(k, t, rnd.randrange(1, 4000)) for k in ("a", "b", None) for t in rnd.sample(range(5000), 400)] + [("c", 10, 5)]
    asks = [(rnd.choice(["a", "b", None, "c", "d"]), rnd.randrange(-5, 5000), 100_000 * i + rnd.randrange(1, 300)) for i in range(300)]
    made = first_time_after(spark.createDataFrame(events, "k string, _t long, _a long"),
                            spark.createDataFrame([(k, t, a) for k, t, a in asks], "k string, _t long, _a long").withColumn("_a", F.col("_a") % 100_000 + F.lit(0)).dropDuplicates(["k", "_a"]),
                            ["k"], num_partitions=13)
    got = {(r["k"], r["_a"]): r["_found"] for r in made.collect()}
    first = {}
    for k, t, a in asks:
        first.setdefault((k, a % 100_000), []).append(t)
    for (k, a), ts in first.items():
        options = {min((t for key, t, b in events if key == k and t > cut and b <= a), default=None) for cut in ts}
        assert got.get((k, a)) in options
    assert len(got) > 50


def test_no_window_by_key(spark):
    df, _ = keyed_frame(spark, keyed_streams(30))
    plan = alerts.sliding_share(df, 25, keys=["k"])._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.split("\n"):
        assert "Window [" not in line or "_pid" in line or "_seg" in line
