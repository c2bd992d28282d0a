import datetime as dt

from pyspark.sql import functions as F

from moodstream import catalog
from moodstream.operators import datasets, training


def source(spark, rows):
    return spark.createDataFrame([(t, lab, i) for i, (t, lab) in enumerate(rows)], "tweet string, label int, _row long")


def test_fold_and_dedupe(spark):
    rows = [("محايد", 0), ("خبر", 1), ("رائع", 2), ("سيء", 3), ("رائع", 2), ("  ", 0)]
    out = datasets.map_labels(source(spark, rows)).orderBy("_row").collect()
    assert [(r["text"], r["label"]) for r in out] == [("محايد", "neutral"), ("خبر", "neutral"),
                                                      ("رائع", "positive"), ("سيء", "negative")]


def test_drop_objective(spark):
    rows = [("محايد", 0), ("خبر", 1), ("رائع", 2), ("سيء", 3)]
    out = datasets.map_labels(source(spark, rows), objective="drop").collect()
    assert "خبر" not in {r["text"] for r in out} and len(out) == 3


def _labelled(spark, counts):
    rows, i = [], 0
    for lab, n in counts.items():
        for _ in range(n):
            rows.append((f"astd-{i}", f"t{i}", lab))
            i += 1
    return spark.createDataFrame(rows, "id string, text string, label string")


def test_split_300(spark):
    df = _labelled(spark, {"neutral": 200, "negative": 60, "positive": 40})
    s = datasets.stratified_split(df, seed=42)
    sizes = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert sizes == {"train": 210, "val": 30, "test": 60}
    assert s.where((F.col("split") == "test") & (F.col("label") == "positive")).count() == 8
    assert s.select("id").distinct().count() == 300


def test_subsample_50_of_100(spark):
    df = _labelled(spark, {"neutral": 70, "negative": 20, "positive": 10})
    out = {r["label"]: r["count"] for r in datasets.stratified_sample(df, 0.5).groupBy("label").count().collect()}
    assert out == {"neutral": 35, "negative": 10, "positive": 5}


def test_class_weights(spark):
    df = _labelled(spark, {"neutral": 6, "negative": 3})
    w = {r["label"]: r["weight"] for r in datasets.class_weights(df).collect()}
    assert w == {"neutral": 9 / 18, "negative": 9 / 9, "positive": 9 / 3}


def test_ids_sequential(spark):
    df = spark.createDataFrame([(f"x{i}", i * 3) for i in range(50)], "text string, _row long")
    out = datasets.with_ids(df, "_row").collect()
    assert sorted(int(r["id"].split("-")[1]) for r in out) == list(range(50))
    assert {r["id"]: r["_row"] for r in out}["astd-10"] == 30


def test_replay_schedule(spark):
    df = spark.createDataFrame([(i,) for i in range(5)], "_row long")
    out = datasets.replay_schedule(df, "_row", 10, F.lit("2026-01-01 00:00:00")).orderBy("_row").collect()
    base = dt.datetime(2026, 1, 1)
    assert [(r["due_at"] - base).total_seconds() for r in out] == [0.0, 0.1, 0.2, 0.3, 0.4]


def test_replay_first_n(spark):
    df = spark.createDataFrame([(i,) for i in range(20, 0, -1)], "_row long")
    start = F.lit("2026-01-01 00:00:00")
    out = datasets.replay_schedule(df, "_row", 0, start, max_messages=3).collect()
    assert sorted(r["_row"] for r in out) == [1, 2, 3]
    assert datasets.replay_schedule(df, "_row", 0, start, max_messages=0).count() == 20


def test_splits_disjoint(spark):
    df = spark.createDataFrame([(f"astd-{i}", ["negative", "neutral", "positive"][i % 3]) for i in range(90)],
                               "id string, label string")
    s = datasets.stratified_split(df, seed=7)
    parts = {k: s.where(F.col("split") == k).select("id") for k in ("train", "val", "test")}
    assert parts["train"].intersect(parts["val"]).count() == 0
    assert parts["train"].intersect(parts["test"]).count() == 0
    assert parts["val"].intersect(parts["test"]).count() == 0
    assert sum(p.count() for p in parts.values()) == 90


def counted(spark):
    """(a function that passes texts on, the number of texts it has seen)."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def passed(text):
        seen.add(1)
        return text

    return passed.asNondeterministic(), seen


def test_binary_training_reads_its_texts_once(spark):
    passed, seen = counted(spark)
    rows = spark.createDataFrame([(f"word{k % 7} text{k}", k % 2) for k in range(60)], "text string, label int")
    model = training.train_binary(rows.select(passed("text").alias("text"), "label"), num_features=64, max_iter=5)
    assert seen.value == 60
    assert training.predict_binary(model, rows).where("prob BETWEEN 0 AND 1").count() == 60


def test_split_maps_its_texts_once(spark, monkeypatch):
    passed, seen = counted(spark)
    rows = [(f"word{k % 80 % 3} text{k % 80} ", [0, 2, 3][k % 80 % 3], k) for k in range(90)]  # ten texts come twice
    source = spark.createDataFrame(rows, "tweet string, label int, _row long").select(passed("tweet").alias("tweet"), "label", "_row")
    monkeypatch.setattr(catalog, "source_dataset", lambda *_: source)
    res, test = catalog._trained(spark, "")
    assert seen.value == 90
    plain = spark.createDataFrame(rows, source.schema)
    want = datasets.stratified_split(datasets.with_ids(datasets.map_labels(plain), "_row"), seed=catalog.SPLIT_SEED)
    in_test = want.where("split = 'test'").select("id", "text", "label").collect()
    assert sorted(test.collect()) == sorted(in_test) and len(in_test) == len({r["text"] for r in in_test}) == 16
    assert res.train_size == want.where("split = 'train'").count() == 56


def test_scoring_works_each_text_out_once(spark):
    rows = spark.createDataFrame([(f"word{k % 3} text{k}", ["negative", "neutral", "positive"][k % 3]) for k in range(60)], "text string, gold_label string")
    model = training.train_classifier(rows.withColumnRenamed("gold_label", "label"), rows.withColumnRenamed("gold_label", "label"), [0.1], num_features=64, max_iter=5).model
    scored = training.predict(model, rows).where("label <> 'other' AND confidence > 0 AND scores['neutral'] < 2").groupBy("gold_label", "label").count()
    assert sum(r["count"] for r in scored.collect()) == 60
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(text#") == 1
