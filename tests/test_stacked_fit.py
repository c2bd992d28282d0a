"""Several candidates fitted in one pass each round: against fits one by one and against Spark's estimator."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from moodstream.operators import stacked_fit

REGS = (0.05, 0.3, 0.01)
SCHEMA = "label_id double, weight double"


def rows_of(seed, n=240, d=12):
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        y = rnd.randrange(3)
        at = sorted(rnd.sample(range(d - 2), rnd.randrange(0, 6)) + ([d - 2] if rnd.random() < 0.3 + 0.2 * y else []))
        x = {i: rnd.random() * (2 if i % 3 == y else 1) for i in at}
        vector = Vectors.dense([x.get(i, 0.0) for i in range(d)]) if k % 7 == 0 else Vectors.sparse(d, x)
        rows.append((vector, float(y), 1.0 + (y == 2) * 0.5))
    return rows


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(rows_of(1), ["_features", "label_id", "weight"]).repartition(5).cache()


def objective(rows, fit):
    x, y, w = np.array([r[0].toArray() for r in rows]), np.array([int(r[1]) for r in rows]), np.array([r[2] for r in rows])
    m = x @ fit.coefficients.T + fit.intercepts
    mean = (w @ x) / w.sum()
    std = np.sqrt((w @ (x - mean) ** 2) / (w.sum() - (w @ w) / w.sum()))
    loss = np.log(np.exp(m).sum(axis=1)) - m[np.arange(len(y)), y]
    return (w @ loss) / w.sum() + fit.reg_param / 2 * ((fit.coefficients * std) ** 2).sum()


def test_together_as_one_by_one_and_as_sparks_own(spark, data):
    rows = rows_of(1)
    fits = stacked_fit.fit_all(data, REGS, 3, max_iter=200, tol=1e-12)
    for fit, reg in zip(fits, REGS, strict=True):
        alone = stacked_fit.fit_all(data, [reg], 3, max_iter=200, tol=1e-12)[0]
        assert np.abs(alone.coefficients - fit.coefficients).max() < 1e-6 and np.abs(alone.intercepts - fit.intercepts).max() < 1e-6
        own = LogisticRegression(featuresCol="_features", labelCol="label_id", weightCol="weight", regParam=reg, maxIter=500, tol=1e-12, family="multinomial").fit(data)
        assert np.abs(own.coefficientMatrix.toArray() - fit.coefficients).max() < 1e-4
        assert np.abs(own.interceptVector.toArray() - fit.intercepts).max() < 1e-4
        assert abs(fit.loss - objective(rows, fit)) < 1e-9 and fit.reg_param == reg
        assert not fit.coefficients[:, 11].any()  # a feature that no row has


def test_jobs_do_not_grow_with_the_candidates(spark, data):
    def jobs(regs, group):
        spark.sparkContext.setJobGroup(group, group)
        stacked_fit.fit_all(data, regs, 3, max_iter=10)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    one = max(jobs([r], f"one{r}") for r in REGS)
    assert jobs(list(REGS) * 3, "nine") <= one


def test_answers_of_all_candidates_are_those_of_the_models(spark, data):
    fits = stacked_fit.fit_all(data, REGS, 3, max_iter=15)
    got = {(r["candidate"], r["gold"], r["pred"]): r["n"] for r in stacked_fit.confusion_counts(data, fits, "_features", "label_id").collect()}
    assert len(got) == 27
    for c, fit in enumerate(fits):
        model = stacked_fit.as_model(fit, LogisticRegression(featuresCol="_features", labelCol="label_id"))
        want = {(int(r["label_id"]), int(r["prediction"])): r["n"] for r in model.transform(data).groupBy("label_id", "prediction").agg(F.count("*").alias("n")).collect()}
        assert {k[1:]: n for k, n in got.items() if k[0] == c and n} == want


def test_sums_between_tasks_and_driver_change_nothing(data, monkeypatch):
    near = stacked_fit.fit_all(data, REGS, 3, max_iter=5)
    monkeypatch.setattr(stacked_fit, "DIRECT", 0)
    far = stacked_fit.fit_all(data, REGS, 3, max_iter=5)
    for a, b in zip(near, far, strict=True):
        assert np.abs(a.coefficients - b.coefficients).max() < 1e-9 and a.iterations == b.iterations


def test_missing_class_empty_rows_and_no_rows(spark):
    two = spark.createDataFrame([(Vectors.sparse(3, {0: 1.0}), 0.0, 1.0), (Vectors.sparse(3, {}), 2.0, 1.0), (Vectors.sparse(3, {}), 2.0, 1.0)], ["_features", "label_id", "weight"]).cache()
    fit = stacked_fit.fit_all(two, [0.1], 3)[0]
    at = np.array([[1, 0, 0], [0, 0, 0]]) @ fit.coefficients.T + fit.intercepts
    assert list(at.argmax(axis=1)) == [0, 2] and np.isfinite(at).all()
    with pytest.raises(ValueError):
        stacked_fit.fit_all(two.where("weight > 5"), [0.1], 3)
