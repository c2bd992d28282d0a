"""Language, quality and toxicity: held-out accuracy and odd cases."""

import math
import random

import numpy as np
import pytest
from conftest import SF_SMALL
from fixtures import held_out, no_documents, odd_documents, rows, rows_of_odd_documents
from pyspark.sql import functions as F

from moodstream.llm import common, langid, quality, toxicity
from moodstream.llm.ftrl import Ftrl

SF = SF_SMALL.replace("sf0.001", "sf0.01")


def _tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_language_of_held_out_documents(spark):
    docs, _ = _tables(spark)
    got = langid.predict(docs, langid.train(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    r = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert r[0] > 0.97 and r[1] >= 0 and r[2] <= 1


def test_language_of_odd_documents(spark):
    docs, data = odd_documents(spark), rows_of_odd_documents()
    model = langid.train(docs)
    assert model.langs == ("en", "fr")
    got = rows(langid.predict(docs, model))
    folds = held_out({r[0] for r in data}, 5, 0)
    letterless = {r[0] for r in data if not any(c.isalpha() for c in r[1] or "")}
    assert len(got) == len(data)
    for doc, held, lang, score in got:
        assert held == folds[doc] and 0 <= score <= 1
        assert (lang == "und") == (doc in letterless)
    nothing = langid.train(no_documents(spark))
    assert {r[2] for r in rows(langid.predict(docs, nothing))} == {"und"}
    assert langid.predict(no_documents(spark), model).count() == 0


def test_language_column_with_many_values_and_long_texts(spark):
    """Most of the language values are dirt; the frequent ones are learnt and predicted, without an error."""
    say = {"aa": "lorem ipsum dolor sit amet", "bb": "\u0444\u044b\u0432\u0430 \u043e\u043b\u0434\u0436"}
    rows = [(i, say[k], k) for i, k in enumerate(["aa", "bb"] * 40)] + [(1000 + i, "lorem ipsum", f"x{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, max_langs=2)
    assert model.langs == ("aa", "bb")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, model).collect()}
    assert len(got) == 380 and all(got[i] == k for i, k in enumerate(["aa", "bb"] * 40)) and got[1000] == "aa"

    # A language of long texts is thinned to its level, the other one is left whole.
    held = [(i / 100, "long", "\u4e00" * 5000) for i in range(100)] + [(i / 100, "short", "ab") for i in range(100)]
    chosen = spark.createDataFrame(held, "_u double, _lang string, _text string")
    kept = {r["_lang"]: r["count"] for r in langid._bounded(chosen, 100 * 48 + 50 * 120_000).groupBy("_lang").count().collect()}
    assert kept == {"long": 50, "short": 100}
    assert langid._bounded(chosen, 1 << 30).count() == 200


def test_gram_counts_do_not_depend_on_stretches(monkeypatch):
    text = "Grüße aus Köln, ça va? 漢字 " * 40
    whole = langid.gram_counts(text)
    monkeypatch.setattr(langid, "STRETCH", 17)
    cut = langid.gram_counts(text)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()
    assert whole[1].sum() == 3 * len(text) - 3


def test_letters_are_letters():
    assert [langid.has_letter(t) for t in ("½ ² Ⅷ 12_", "12 é", "漢", "", None)] == [False, True, True, False, False]


def test_temperature_has_the_least_loss():
    rng = np.random.default_rng(0)
    logits = rng.standard_normal((400, 3)) * 4
    y = np.array([rng.choice(3, p=p) for p in langid.softmax(logits / 2.5)])
    t = langid.fit_temperature(logits, y)
    loss = lambda s: -np.log(langid.softmax(logits / s)[np.arange(400), y]).mean()
    assert loss(t) <= min(loss(s) for s in np.linspace(0.5, 8, 200)) + 1e-6


def test_ftrl_step_by_the_formulas():
    alpha, beta, l1, l2 = 0.5, 1.0, 0.1, 0.01
    model, z, n, w = Ftrl(1, alpha, beta, l1, l2), 0.0, 0.0, 0.0
    for g in (0.3, -0.7, 0.2, 0.9):
        model.update(np.array([0]), np.array([w]), np.array([g]))
        z += g - (math.sqrt(n + g * g) - math.sqrt(n)) / alpha * w
        n += g * g
        w = 0.0 if abs(z) <= l1 else -(z - math.copysign(l1, z)) / ((beta + math.sqrt(n)) / alpha + l2)
        assert abs(model.weights()[0] - w) < 1e-12


def test_quality_of_held_out_documents(spark):
    docs, labels = _tables(spark)
    model = quality.train(docs, labels.select("doc_id", "quality"))
    got = quality.score(docs, model).join(labels, "doc_id").where("held_out")
    r = {q: a for q, a in rows(got.groupBy("quality").agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))))}
    assert r[1] > 0.97 and r[0] > 0.5
    kept = quality.accepted(docs, model)
    assert kept.schema == docs.schema
    assert {r[0] for r in rows(kept.select("doc_id"))} == {r[0] for r in rows(quality.score(docs, model).where("predicted = 1"))}


def test_quality_learns_the_same_in_any_order_and_past_an_oversized_text(spark):
    rnd = random.Random(3)
    kinds = {0: "buy cheap pills now click".split(), 1: "the river runs through quiet hills".split()}
    data = [(i, " ".join(rnd.choice(kinds[i % 2]) + str(rnd.randrange(9)) for _ in range(300))) for i in range(120)]
    huge = (120, "x y " * 100_000)  # more than the whole bound, and first or last to arrive
    labels = spark.createDataFrame([(i, i % 2) for i in range(121)], "doc_id long, quality int")
    models = []
    for rows_in in ([huge, *data], [*data, huge], [*reversed(data), huge]):
        docs = spark.createDataFrame(rows_in, "doc_id long, text string").coalesce(1)
        models.append(quality.train(docs, labels, sample_bytes=100_000))
    assert models[0] == models[1] == models[2]
    assert len(models[0].at) > 1  # no constant score
    sizes = quality.Sizes(models[0].good, models[0].bad)
    score = lambda t: np.interp(sizes.difference(t), models[0].at, models[0].score)
    assert min(score(t) for i, t in data if i % 2) > 0.5 > max(score(t) for i, t in data if not i % 2)


def test_a_repeated_id_is_learnt_from_once(spark):
    rnd = random.Random(4)
    kinds = {0: "buy cheap pills now idiot".split(), 1: "the river runs through quiet hills".split()}
    data = [(i, " ".join(rnd.choice(kinds[i % 2]) + str(rnd.randrange(9)) for _ in range(80)), "en") for i in range(120)]
    again = data + [data[8]] * 200 + [(8, "another text, smaller", "en")] * 40
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(120)], "doc_id long, quality int, toxic int")
    once, often = (spark.createDataFrame(d, "doc_id long, text string, lang string") for d in (data, again))
    assert quality.train(once, labels) == quality.train(often, labels)
    a, b = toxicity.train(once, labels), toxicity.train(often, labels)
    assert (a.features == b.features).all() and (a.weights == b.weights).all() and (a.slope, a.offset) == (b.slope, b.offset)
    known = often.selectExpr("doc_id AS _id", "lang AS _lang", "text AS _text")
    assert sorted(rows(langid._sample(known, {"en": 1.0}, 3).select("_id", "_text", "_lang"))) == sorted(data)


def test_level_fills_the_bound_and_pieces_are_spaced():
    for sizes, bound in (([5, 1, 100, 30], 40), ([0, 3], 100), ([7] * 9, 4), ([], 3)):
        best = max([n for n in range(1, max([1, *sizes]) + 1) if sum(min(s, n) for s in sizes) <= bound], default=1)
        assert common.level(sizes, bound) == best
    assert common.spaced(3, 5) == [0, 1, 2] and common.spaced(10, 4) == [0, 2, 5, 7] and common.spaced(0, 4) == []


def test_rising_curve_is_the_weighted_isotonic_fit():
    rng = np.random.default_rng(2)
    x, w = rng.standard_normal(60), rng.random(60) + 0.1
    y = (x + rng.standard_normal(60) > 0).astype(float)
    at, value = quality.rising_curve(x, y, w)
    assert at == sorted(at) and value == sorted(value)
    # Min-max formula of the isotonic fit at the first and the last point.
    o = np.argsort(x)
    mean = lambda i, j: np.average(y[o][i : j + 1], weights=w[o][i : j + 1])
    total = (y * w).sum() / w.sum()
    first = min(mean(0, j) for j in range(60))
    assert abs(value[0] - first) <= 0.1 * max(total, 1) / w.min() and value[-1] <= 1


def test_models_of_odd_documents_and_labels(spark):
    docs, data = odd_documents(spark), rows_of_odd_documents()
    labels = spark.createDataFrame(
        [(i, i % 2, int("idiot" in (r[1] or ""))) for i, r in enumerate(data) if i < 50] + [(None, 1, 1), (3, None, None), (3, 0, 0), (9999, 1, 1)],
        "doc_id long, quality int, toxic int")
    none = spark.createDataFrame([], labels.schema)
    one = labels.where("quality = 1").withColumn("toxic", F.lit(1))
    for module, column, modulus, value in ((quality, "quality", 5, 0), (toxicity, "toxic", 4, 2)):
        folds = held_out({r[0] for r in data}, modulus, value)
        for some in (labels, none, one):
            model = module.train(docs, some, label_col=column)
            got = rows(module.score(docs, model))
            assert len(got) == len(data)
            for doc, held, score, predicted in got:
                assert held == folds[doc] and 0 <= score <= 1 and predicted == int(score >= 0.3)
        assert module.score(no_documents(spark), model).count() == 0
        assert module.score(docs, module.train(no_documents(spark), labels, label_col=column)).count() == len(data)


def test_toxicity_of_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF.replace('sf0.01', 'sf0.1')}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score(docs, toxicity.train(docs, labels)).where("held_out").join(labels, "doc_id")
    share = dict(rows(got.groupBy("toxic").agg(F.avg("predicted"))))
    assert share[1] > 0.85 and share[0] < 0.02, share  # 3,000 labelled documents to learn from


def _few_labels(spark):
    """Texts made of the table's, some with one of six words in; 300 labels."""
    docs, _ = _tables(spark)
    bad = F.array(*[F.lit(w) for w in ("idiot", "moron", "clown", "scum", "loser", "trash")])
    made = docs.select("doc_id", F.when(F.col("doc_id") % 4 == 1, F.concat("text", F.lit(" "), bad[F.expr("cast(doc_id div 12 as int)") % 6], F.lit("!"))).otherwise(F.col("text")).alias("text"))
    labels = made.select("doc_id", (F.col("doc_id") % 4 == 1).cast("int").alias("toxic")).where("doc_id % 3 < 2")
    clean = made.where(~F.lower("text").rlike("idiot|moron|clown|scum|loser|trash|pathetic|worthless|stupid|disgusting") | (F.col("doc_id") % 4 == 1))
    got = toxicity.score(clean, toxicity.train(clean, labels)).where("held_out")
    r = dict(rows(got.groupBy((F.col("doc_id") % 4 == 1).alias("toxic")).agg(F.avg("predicted"))))
    return r


def test_toxicity_found_from_few_labelled_documents(spark):
    assert _few_labels(spark)[True] > 0.9


@pytest.mark.xfail(strict=True, reason="8.2 % are false (README)")
def test_toxicity_false_from_few_labelled_documents(spark):
    assert _few_labels(spark)[False] < 0.05


def test_toxicity_features_do_not_depend_on_stretches(monkeypatch):
    text = "You are an idiot , truly AN idiot\nof the first order " * 5
    make = toxicity.Features()
    whole = make.of(text)
    monkeypatch.setattr(toxicity, "STRETCH", 13)
    assert (make.of(text) == whole).all() and (toxicity.Features().of(None) == []).all()
