import datetime as dt

from moodstream.operators import joining

T0 = dt.datetime(2026, 1, 1)


def sides(spark, raws, preds):
    r = spark.createDataFrame(
        [(i, "t-" + i, "astd", "s" + i, T0 + dt.timedelta(seconds=t), o) for i, t, o in raws],
        "id string, text string, source string, source_id string, produced_at timestamp, offset long")
    p = spark.createDataFrame(
        [(i, "negative", 0.9, "m@1", T0 + dt.timedelta(seconds=t), o) for i, t, o in preds],
        "id string, label string, confidence double, model_version string, predicted_at timestamp, offset long")
    return r, p


def outcomes(pairs):
    return {r["outcome"]: r["n"] for r in joining.outcome_counts(pairs).collect()}


def test_pair_in_either_order(spark):
    r, p = sides(spark, [("id-1", 5, 0)], [("id-1", 0, 0)])
    j = joining.build_joined(joining.join_reviews(r, p, 60)).collect()
    assert len(j) == 1 and j[0]["text"] == "t-id-1" and j[0]["label"] == "negative"
    assert j[0]["joined_at"] == T0 + dt.timedelta(seconds=5)


def test_other_id_stays_unmatched(spark):
    r, p = sides(spark, [("id-1", 0, 0), ("id-2", 1, 1)], [("id-2", 2, 0)])
    pairs = joining.join_reviews(r, p, 60)
    assert [x["id"] for x in joining.build_joined(pairs).collect()] == ["id-2"]
    assert outcomes(pairs) == {"joined": 1, "duplicates": 0, "expired": 1}


def test_redelivery_is_duplicate(spark):
    r, p = sides(spark, [("a", 0, 0), ("a", 3, 5)], [("a", 1, 0), ("a", 2, 1)])
    pairs = joining.join_reviews(r, p, 60)
    assert outcomes(pairs) == {"joined": 1, "duplicates": 2, "expired": 0}
    assert joining.build_joined(pairs).count() == 1


def test_ttl_boundary(spark):
    r, p = sides(spark, [("a", 0, 0), ("b", 0, 1)], [("a", 59, 0), ("b", 60, 1)])
    pairs = joining.join_reviews(r, p, 60)
    assert [x["id"] for x in joining.build_joined(pairs).collect()] == ["a"]
    d = joining.expired(pairs, 60).orderBy("error").collect()
    assert [x["error"] for x in d] == ["join_ttl_expired: no prediction for id within 60.0s",
                                       "join_ttl_expired: no raw for id within 60.0s"]
    assert d[0]["stage"] == "consumer_join" and '"id":"b"' in d[0]["original_payload"]


def test_first_arrival_wins(spark):
    r, p = sides(spark, [("a", 0, 0)], [("a", 7, 3), ("a", 5, 9)])
    j = joining.build_joined(joining.join_reviews(r, p, 60)).first()
    assert j["predicted_at"] == T0 + dt.timedelta(seconds=5)


def test_latency(spark):
    r = spark.createDataFrame([("a", "x", None, None, dt.datetime(2026, 1, 1), 0)],
                              "id string, text string, source string, source_id string, "
                              "produced_at timestamp, offset long")
    p = spark.createDataFrame([("a", "neutral", 0.5, "m", dt.datetime(2026, 1, 1, 0, 0, 0, 350000), 0)],
                              "id string, label string, confidence double, model_version string, "
                              "predicted_at timestamp, offset long")
    j = joining.build_joined(joining.join_reviews(r, p, 60)).first()
    assert j["end_to_end_ms"] == 350.0 and j["source"] is None
