import json
import os

import pytest
from pyspark.sql import functions as F

from moodstream.functions import numeric
from moodstream.operators import datasets, training
from moodstream.sources import files

CSV = 'id,text,label\n1,"say ""hi"", then\nleave",neutral\n2,plain,positive\n1,again,negative\n3,"\u00a0",neutral\n'


def put(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_gold_keeps_the_last_row_of_an_id(spark, tmp_dir):
    rows = files.load_gold(spark, put(f"{tmp_dir}/g.csv", CSV)).collect()
    assert {r["id"]: r["label"] for r in rows} == {"1": "negative", "2": "positive", "3": "neutral"}


def test_reviews_unquote_and_skip_blank_texts(spark, tmp_dir):
    rows = files.load_reviews(spark, put(f"{tmp_dir}/r.csv", CSV)).collect()
    assert [tuple(r) for r in rows] == [("1", 'say "hi", then\nleave'), ("2", "plain"), ("1", "again")]


def test_alert_feed_skips_torn_lines(spark, tmp_dir):
    lines = [json.dumps({"status": "firing", "threshold": 0.5}), "{oops", json.dumps({"threshold": 0.1})]
    assert [r["status"] for r in files.load_alerts(spark, put(f"{tmp_dir}/a.jsonl", "\n".join(lines))).collect()] == ["firing"]
    assert files.load_alerts(spark, f"{tmp_dir}/none.jsonl").count() == 0


def test_data_set_files_round_trip(spark, tmp_dir):
    rows = [("a", 'x "q" y\nz', "negative", "train"), ("b", "back\\slash, comma", "negative", "test"), ("c", "t", "positive", "test"), ("d", "v", "neutral", "val")]
    files.write_splits(spark.createDataFrame(rows, "id string, text string, label string, split string"), f"{tmp_dir}/out")
    back = {r["id"]: r["text"] for r in files._read_csv(spark, f"{tmp_dir}/out/splits/split=train").collect()}
    assert back == {"a": 'x "q" y\nz'}
    assert sorted(os.listdir(f"{tmp_dir}/out/splits"))[-3:] == ["split=test", "split=train", "split=val"]
    assert sorted(r["id"] for r in files.load_reviews(spark, f"{tmp_dir}/out/replay").collect()) == ["b", "c"]
    assert [(r["id"], r["text"]) for r in files.load_reviews(spark, f"{tmp_dir}/out/spike").collect()] == [("b", "back\\slash, comma")]


def test_union_of_data_sets(spark):
    a, b = spark.createDataFrame([("x", 1)], "tweet string, label int"), spark.createDataFrame([(2, "y", 9)], "label int, tweet string, more int")
    assert sorted(map(tuple, datasets.union_datasets(a, b).select("_set", "tweet", "label", "more").collect())) == [(0, "x", 1, None), (1, "y", 2, 9)]


def test_softmax_and_label_index(spark):
    df = spark.createDataFrame([([1.0, 3.0, 2.0], "positive"), ([1000.0, 1000.0, 0.0], "angry")], "z array<double>, label string")
    one, two = df.select(numeric.softmax("z").alias("p"), training.label_index().alias("i")).collect()
    assert one["p"] == pytest.approx([0.0900306, 0.6652410, 0.2447285], abs=1e-6) and one["i"] == 2.0
    assert two["p"] == pytest.approx([0.5, 0.5, 0.0]) and two["i"] == -1.0
    assert [r[0] for r in df.select(numeric.argmax_index("z")).collect()] == [2, 1]


def test_checkpoints_go_with_their_frame(spark):
    import gc
    import time

    from moodstream.session import checkpoint_dir

    folder = checkpoint_dir(spark).removeprefix("file:")
    files_in = lambda: {os.path.join(d, n) for d, _, ns in os.walk(folder) for n in ns if n.startswith("part-")}
    before = files_in()
    df = spark.range(1000).withColumn("x", F.rand(1)).checkpoint()
    made = files_in() - before
    assert made and df.count() == 1000
    del df
    for _ in range(60):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        if not made & files_in():
            break
        time.sleep(0.5)
    assert not made & files_in()


def test_a_cluster_needs_a_named_folder(monkeypatch):
    from moodstream import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())


def test_training_saves_what_it_learnt(spark, tmp_dir):
    words = {"negative": "awful slow broken", "neutral": "table chair lamp", "positive": "lovely quick bright"}
    rows = [(f"{w} item{i % 4}", lab) for lab, ws in words.items() for i in range(8) for w in ws.split()]
    df = spark.createDataFrame(rows, "text string, label string")
    res = training.train_classifier(df, df, reg_params=(0.01, 0.01), clean_mode="tweet", num_features=1 << 10, max_iter=15, weighted=False).measure(df)
    assert res.test["accuracy"] == 1.0 and res.train_size == len(rows) and res.test["confusion_matrix"][1] == [0, 24, 0]
    assert len(res.history) == 2 and res.reg_param == 0.01
    meta = training.save_model(res, f"{tmp_dir}/m")
    assert meta["train_size"] == len(rows) and meta["hyperparameters"]["class_weights"] is False and meta["test"]["macro_f1"] == 1.0
    from moodstream.operators.scoring import model_version

    assert model_version(spark, f"{tmp_dir}/m") == meta["model_version"]
    two = df.where("label <> 'neutral'").select("text", (F.col("label") == "positive").cast("int").alias("label"))
    model = training.train_binary(two, class_weights={0: 1.0, 1: 5.0}, num_features=1 << 10, max_iter=15)
    got = training.predict_binary(model, two).collect()
    assert all((r["prob"] >= 0.5) == (r["label"] == 1) for r in got) and sum(r["label"] for r in got) == 24
    assert {r["weight"] for r in training.with_weights(df, weighted=False).collect()} == {1.0}
