import datetime as dt

import pytest

from moodstream.operators import evaluation
from moodstream.plans.ordered import exact_percentiles


def pairs(spark, rows):
    return spark.createDataFrame(rows, "gold_label string, label string")


LABELS = ["negative", "neutral", "positive"]
# gold, predicted, how often
CELLS = [("negative", "negative", 5), ("negative", "positive", 2), ("neutral", "neutral", 3), ("neutral", "negative", 1), ("positive", "positive", 4), ("positive", "neutral", 3)]


def confusion(spark):
    return evaluation.confusion_matrix(pairs(spark, [(g, p) for g, p, n in CELLS for _ in range(n)]))


def test_metrics_of_a_confusion_table(spark):
    cm = confusion(spark)
    assert {(r["gold"], r["pred"]): r["n"] for r in cm.collect()} == {(g, p): 0 for g in LABELS for p in LABELS} | {(g, p): n for g, p, n in CELLS}
    s = evaluation.summary(cm).first()
    f1 = {"negative": 10 / 13, "neutral": 6 / 10, "positive": 8 / 13}
    assert (s["n"], s["accuracy"]) == (18, round(12 / 18, 4)) and abs(s["macro_f1"] - sum(f1.values()) / 3) < 1e-4
    assert {r["label"]: r["f1"] for r in evaluation.class_metrics(cm).collect()} == {k: round(v, 4) for k, v in f1.items()}
    rep = {r["label"]: r for r in evaluation.classification_report(cm).collect()}
    assert [rep[k]["support"] for k in (*LABELS, "macro avg", "weighted avg")] == [7, 4, 7, 18, 18]
    assert rep["macro avg"]["precision"] == pytest.approx((5 / 6 + 3 / 6 + 4 / 6) / 3)
    assert rep["weighted avg"]["recall"] == pytest.approx(12 / 18)
    want = sum(f1[k] * n for k, n in (("negative", 7), ("neutral", 4), ("positive", 7))) / 18
    assert evaluation.weighted_f1(cm).first()[0] == round(want, 4)


def test_a_class_that_is_never_predicted_scores_zero(spark):
    cm = evaluation.confusion_matrix(pairs(spark, [("positive", "neutral"), ("neutral", "neutral")]))
    assert {r["label"]: r["f1"] for r in evaluation.class_metrics(cm).collect()}["positive"] == 0.0
    empty = evaluation.summary(evaluation.confusion_matrix(pairs(spark, []))).first()
    assert (empty["n"], empty["accuracy"], empty["macro_f1"]) == (0, 0.0, 0.0)


def test_label_outside_domain_fails(spark):
    with pytest.raises(Exception):
        evaluation.confusion_matrix(pairs(spark, [("angry", "neutral")])).collect()


@pytest.mark.parametrize("values,q,want", [(list(range(1, 12)), 0.95, 10.5), ([4, 4, 4, 4, 9], 0.8, 5.0), ([], 0.5, None), ([3], 0.99, 3.0),
                                           ([6] * 60 + [8] * 20 + [1] * 20, 0.2, 5.0)])
def test_percentile(spark, values, q, want):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = exact_percentiles(df, "v", [q], num_partitions=3).first()["value"]
    assert got == pytest.approx(want) if want is not None else got is None


def test_a_value_that_most_rows_share_is_one_row_when_sorted(spark, monkeypatch):
    from moodstream.plans import ordered

    sizes, real = [], ordered.range_partitioned

    def spy(df, *a, **k):
        out = real(df, *a, **k)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(ordered, "range_partitioned", spy)
    df = spark.range(1000).selectExpr("CAST(IF(id % 3 < 2, 7, id) AS DOUBLE) AS v")
    assert exact_percentiles(df, "v", [0.5, 0.9]).count() == 2
    assert sizes == [334]


def test_rates(spark):
    start, ms = dt.datetime(2025, 7, 4, 9), lambda n: dt.timedelta(milliseconds=n)
    rows = [(start + ms(2000 * k), start + ms(2000 * k + 300), start + ms(2000 * k + 750), 750.0) for k in range(6)]
    df = spark.createDataFrame(rows, "produced_at timestamp, predicted_at timestamp, joined_at timestamp, end_to_end_ms double")
    p = evaluation.performance(df).first()
    assert (p["offered_rate_per_sec"], p["throughput_per_sec"]) == (round(6 / 10, 2), round(6 / 10.75, 2))
    assert (p["produce_to_predict_p95"], p["produce_to_join_p50"]) == (300.0, 750.0)


def test_coverage(spark):
    gold = spark.createDataFrame([(f"g{k}", LABELS[k % 3]) for k in range(5)], "id string, label string")
    joined = spark.createDataFrame([(f"u{k}", source, label, "m") for k, (source, label) in enumerate(
        [("g0", "negative"), ("g4", "neutral"), ("g2", "negative"), ("other", "neutral")])], "id string, source_id string, label string, model_version string")
    matched = evaluation.match_gold(joined, gold)
    c = evaluation.coverage(joined, gold, matched).first()
    assert (c["expected"], c["joined"], c["matched"], c["missing"]) == (5, 4, 3, 2)
    assert evaluation.summary(evaluation.confusion_matrix(matched)).first()["accuracy"] == round(2 / 3, 4)


def test_a_repeated_gold_id_counts_once(spark):
    gold = spark.createDataFrame([("1", "negative", 0), ("1", "positive", 5), ("1", "neutral", 3)], "id string, label string, line int")
    joined = spark.createDataFrame([("1", "positive")], "source_id string, label string")
    (r,) = evaluation.match_gold(joined, gold, order_col="line").collect()
    assert r["gold_label"] == "positive"
    assert evaluation.match_gold(joined, gold).count() == 1


def test_report_and_its_lines(spark, tmp_dir):
    from moodstream.sources.files import write_report

    t0 = dt.datetime(2025, 2, 3)
    rows = [(str(i), LABELS[i % 3], "m-2" if i % 2 else "m-1", "run", t0 + dt.timedelta(seconds=2 * i), t0 + dt.timedelta(seconds=2 * i, milliseconds=250),
             t0 + dt.timedelta(seconds=2 * i + 1), 1000.0) for i in range(9)] + [("99", "neutral", "m-9", "run", t0, t0, t0, 1.0), ("1", "neutral", "", "other", t0, t0, t0, 1.0)]
    joined = spark.createDataFrame(rows, "source_id string, label string, model_version string, source string, produced_at timestamp, "
                                         "predicted_at timestamp, joined_at timestamp, end_to_end_ms double")
    gold = spark.createDataFrame([(str(i), LABELS[i % 3 if i != 4 else 0]) for i in range(12)], "id string, label string")
    report = evaluation.evaluation_report(joined, gold, source="run").cache()
    r = report.first()
    assert (r["expected"], r["joined"], r["matched"], r["missing"], r["model_versions"]) == (12, 10, 9, 3, ["m-1", "m-2"])
    assert (r["n"], r["accuracy"], r["confusion"]) == (9, round(8 / 9, 4), [[3, 1, 0], [0, 2, 0], [0, 0, 3]])
    assert [c["support"] for c in r["per_class"]] == [4, 2, 3] and (r["messages"], r["wall_seconds"]) == (9, 17.0)
    lines = [x["line"] for x in evaluation.report_lines(report).orderBy("line_no").collect()]
    assert lines[0] == "Matched 9 / 12 dataset rows (3 missing) · model: m-1, m-2" and lines[1:4] == ["", "| Metric | Value |", "|---|---|"]
    assert lines[4] == "| Accuracy | 0.8889 |" and lines[6].startswith("| F1 negative (n=4) | 0.857")
    assert lines[9:] == ["| Offered rate | 0.56 msg/s |", "| Throughput (end to end) | 0.53 msg/s |", "| Produce→predict p50 / p95 | 250.0 / 250.0 ms |",
                         "| Produce→join p50 / p95 / p99 | 1000.0 / 1000.0 / 1000.0 ms |"]
    write_report(report, evaluation.report_lines(report), f"{tmp_dir}/out")
    assert spark.read.json(f"{tmp_dir}/out/report").first()["matched"] == 9
    assert [x["value"] for x in spark.read.text(f"{tmp_dir}/out/markdown").collect()] == lines


def test_auc_of_many_rows_does_not_overflow(spark):
    df = spark.createDataFrame([(0.1, 0), (0.9, 1)], "score double, y int")
    big = evaluation.roc_auc
    from pyspark.sql import functions as F

    from moodstream.plans import ordered

    g = spark.createDataFrame([(0.1, 0, 4 * 10**9), (0.5, 10**9, 10**9), (0.9, 4 * 10**9, 0)], "_s double, _pos long, _neg long")
    assert big(df, "score", "y").first()["auc"] == 1.0
    s = ordered.ordered_suffix_scan(g, ["_s"], ["_neg"])
    assert evaluation.auc_of(s).select(F.round("auc", 6)).first()[0] == pytest.approx(1 - 0.5 / 25)


def test_source_tag(spark):
    gold = spark.createDataFrame([("g1", "positive"), ("g2", "neutral")], "id string, label string")
    joined = spark.createDataFrame([("g1", "positive", "run-b"), ("g2", "negative", "run-b"), ("g2", "neutral", "run-a"), ("g1", "neutral", None)],
                                   "source_id string, label string, source string")
    accuracy = lambda tag: evaluation.summary(evaluation.confusion_matrix(evaluation.match_gold(joined, gold, source=tag))).first()["accuracy"]
    assert (accuracy("run-b"), accuracy("run-a")) == (0.5, 1.0)


def test_roc_auc_against_brute_force(spark):
    import random

    rnd = random.Random(3)
    rows = [(float(rnd.randint(0, 30)), int(rnd.random() < 0.4)) for _ in range(300)]
    df = spark.createDataFrame(rows, "score double, y int")
    auc = evaluation.roc_auc(df, "score", "y", num_partitions=4).first()["auc"]
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y != 1]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc == pytest.approx(want)
    pts = evaluation.roc_points(df, "score", "y", num_partitions=4).orderBy("fpr", "tpr").collect()
    area = sum((b["fpr"] - a["fpr"]) * (a["tpr"] + b["tpr"]) / 2 for a, b in zip(pts, pts[1:]))
    assert area == pytest.approx(want)


def test_binary_metrics(spark):
    df = spark.createDataFrame([(0.9, 1), (0.2, 0), (0.6, 0), (0.4, 1)], "p double, y int")
    r = evaluation.binary_metrics(df, "p", "y").first()
    assert r["accuracy"] == 0.5 and r["f1"] == pytest.approx(0.5)
