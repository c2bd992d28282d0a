import json
import re

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from moodstream.operators import contracts

GOOD = {"schema_version": 1, "id": "r-1", "text": "طعم القهوة رائع", "source": "shop", "produced_at": "2025-06-30T21:15:00+03:00"}


def msgs(spark, values):
    rows = [(v if isinstance(v, bytes) else v.encode("utf-8"), "reviews.raw", 3, 100 + i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "value binary, topic string, partition int, offset long")


def errors(spark, values, fn=contracts.parse_raw):
    return [r["error"] for r in fn(msgs(spark, values)).orderBy("offset").collect()]


def without(key):
    return {k: v for k, v in GOOD.items() if k != key}


def test_fields_of_a_good_message(spark):
    r = contracts.parse_raw(msgs(spark, [json.dumps(GOOD, ensure_ascii=False)])).first()
    assert (r["error"], r["id"], r["text"], r["source"], r["source_id"]) == (None, "r-1", GOOD["text"], "shop", None)
    assert r["produced_at"].isoformat() == "2025-06-30T18:15:00"


NOT_JSON, NOT_OBJECT = "not valid UTF-8 JSON", "payload is not a JSON object"


@pytest.mark.parametrize(("value", "error"), [
    (b'{"schema_version": 1, "id": "r-\xc3"}', NOT_JSON),
    ('{"schema_version": 1, "id"', NOT_JSON),
    ("", NOT_JSON),
    ("17", NOT_OBJECT),
    ('[{"id": "r-1"}]', NOT_OBJECT),
    (json.dumps(GOOD | {"schema_version": 2}), "unsupported schema_version 2"),
    (json.dumps(GOOD | {"schema_version": "one"}), "unsupported schema_version 'one'"),
    (json.dumps(GOOD | {"schema_version": True}), "unsupported schema_version True"),
    (json.dumps(without("schema_version")), "unsupported schema_version None"),
    (json.dumps(GOOD | {"id": ""}), "missing id"),
    (json.dumps(GOOD | {"id": 12}), "missing id"),
    (json.dumps(without("id")), "missing id"),
    (json.dumps(GOOD | {"text": " 　\t"}), "missing text"),
    (json.dumps(GOOD | {"text": ["a"]}), "missing text"),
])
def test_first_failing_check_of_the_raw_contract(spark, value, error):
    assert errors(spark, [value]) == [error]


def test_a_message_is_one_whole_value(spark):
    one = json.dumps(GOOD)
    assert errors(spark, [f"{one} junk", f"{one}{one}", f"{one},{one}", f"{one}]", f'{one}],"x":[1', f" {one}\n"]) == [NOT_JSON] * 5 + [None]


def test_a_repeated_key_keeps_its_last_value(spark):
    twice = '{"schema_version": 4, "id": "old", "schema_version": 1, "id": "new", "text": "ok"}'
    r = contracts.parse_raw(msgs(spark, [twice])).first()
    assert (r["error"], r["id"]) == (None, "new")


def test_join_contract_checks_the_id_first(spark):
    vals = ['{"id": ', "null", '{"schema_version": 5}', '{"schema_version": 5, "id": "k"}', '{"schema_version": 1, "id": "k"}']
    assert errors(spark, vals, contracts.parse_keyed) == [
        NOT_JSON, "payload is not an object with an id", "payload is not an object with an id", "unsupported schema_version 5", None]


def test_each_payload_is_parsed_once(spark):
    _, bad = contracts.split_valid(contracts.parse_raw(msgs(spark, [json.dumps(GOOD)])))
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    plan = contracts.to_dlq(bad)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("parse_?json", plan, re.IGNORECASE)) == 1


def test_rejected_rows_keep_their_coordinates(spark):
    good, bad = contracts.split_valid(contracts.parse_raw(msgs(spark, [json.dumps(GOOD | {"id": "x"}), "<html>", json.dumps(GOOD | {"id": "y"})])))
    assert sorted(r["id"] for r in good.collect()) == ["x", "y"]
    (d,) = contracts.to_dlq(bad).collect()
    assert d["source"].asDict() == {"topic": "reviews.raw", "partition": 3, "offset": 101}
    assert (d["error"], d["stage"], d["original_payload"]) == (f"ValueError: {NOT_JSON}", "consumer_prediction", "<html>")


def test_bytes_that_are_not_text_are_replaced_in_the_dlq(spark):
    bad = contracts.parse_raw(msgs(spark, [b"abc \x80\x81"]))
    assert contracts.to_dlq(bad).first()["original_payload"].startswith("abc �")


def test_prediction_payload_rounding(spark):
    df = spark.createDataFrame([("k", "neutral", 0.123456, {"neutral": 0.123456, "positive": 0.876543}, "m@2", 3.14159)],
                               "id string, label string, confidence double, scores map<string,double>, model_version string, inference_ms double")
    r = contracts.prediction_payload(df).first()
    assert (r["confidence"], r["scores"], r["inference_ms"]) == (0.1235, {"neutral": 0.1235, "positive": 0.8765}, 3.14)


def test_ingest_stamps_accepted_requests(spark):
    rows = [("fine", "shop", "7"), ("also fine", None, None), ("", None, None), (None, None, None), ("y" * 5001, None, None),
            ("z" * 5000, None, None), (" ", None, None), ("a", "s" * 65, None), ("a", None, "i" * 129)]
    checked = contracts.validate_incoming(spark.createDataFrame(rows, "text string, source string, source_id string"))
    assert [r["rejected_reason"] for r in checked.collect()] == [
        None, None, "text: too short", "text: missing", "text: too long", None, None, "source: too long", "source_id: too long"]
    raw = contracts.build_raw(checked).collect()
    assert sorted(len(r["text"]) for r in raw) == [1, 4, 9, 5000]
    assert len({r["id"] for r in raw}) == 4 and all(len(r["id"]) == 36 and r["produced_at"] and r["schema_version"] == 1 for r in raw)
    sent = contracts.to_json_value(contracts.build_raw(checked), topic="reviews.raw").collect()
    for r in sent:
        assert json.loads(r["value"])["id"] == r["key"].decode() and r["topic"] == "reviews.raw"


def test_json_value_keeps_nulls_and_takes_the_topic_of_each_row(spark):
    df = spark.createDataFrame([("a", None, "t1"), ("b", "s", "t2")], "id string, source string, to string")
    out = {r["topic"]: json.loads(r["value"]) for r in contracts.to_json_value(df, topic="to").collect()}
    assert out == {"t1": {"id": "a", "source": None}, "t2": {"id": "b", "source": "s"}}
    assert contracts.to_json_value(df).columns == ["key", "value"]


def test_alert_input_skips_and_counts_bad_predictions(spark):
    fine = {"schema_version": 1, "id": "p", "label": "negative", "predicted_at": "2025-07-01T10:00:00+00:00"}
    vals = [fine, fine | {"id": None}, {k: v for k, v in fine.items() if k != "id"}, fine | {"predicted_at": "soon"}, fine | {"label": None}]
    seen = Observation("alert_input")
    out = contracts.parse_predictions(msgs(spark, [json.dumps(v) for v in vals] + ["no"]), observation=seen)
    assert [r["id"] for r in out.select("id", "label", F.col("predicted_at")).collect()] == ["p"]
    assert seen.get == {"seen": 6, "skipped": 5}
