"""Training a 3-class sentiment classifier as a Spark ML pipeline.

The neural model of the original stack is re-aimed as
``clean text → tokenize → hashing TF → IDF → class-weighted logistic
regression``. Cleaning is a pipeline stage, so training and serving apply
exactly the same text function. Candidates are compared on validation
macro-F1; the earliest candidate wins ties.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.functions.numeric import label_scores
from moodstream.functions.text import clean_text, normalize_arabic
from moodstream.operators import datasets, evaluation, stacked_fit
from moodstream.schemas import LABELS


class TextCleaner(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage applying the shared cleaning (``tweet`` chain or the
    ``arabic`` normaliser) as native column expressions."""

    mode = Param(Params._dummy(), "mode", "tweet or arabic", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCol="text", outputCol="clean", mode="arabic"):
        super().__init__()
        self._setDefault(mode="arabic")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        fn = clean_text if self.getOrDefault(self.mode) == "tweet" else normalize_arabic
        return df.withColumn(self.getOutputCol(), fn(F.col(self.getInputCol())))


def label_index(col: str = "label"):
    """Fixed label order → 0-based index (not StringIndexer's frequency order)."""
    return (F.array_position(F.array(*[F.lit(x) for x in LABELS]), F.col(col)) - 1).cast("double")


def feature_pipeline(num_features: int = 1 << 16, text_col: str = "text", clean_mode: str = "arabic") -> Pipeline:
    return Pipeline(stages=[
        TextCleaner(inputCol=text_col, outputCol="_clean", mode=clean_mode),
        RegexTokenizer(inputCol="_clean", outputCol="_tokens", pattern=r"(?U)\W+", toLowercase=True),
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="_features"),
    ])


def classifier(reg_param: float, max_iter: int = 30) -> LogisticRegression:
    return LogisticRegression(featuresCol="_features", labelCol="label_id", weightCol="weight",
                              regParam=reg_param, maxIter=max_iter, family="multinomial")


def build_pipeline(reg_param: float, num_features: int = 1 << 16, text_col: str = "text",
                   clean_mode: str = "arabic", max_iter: int = 30) -> Pipeline:
    stages = feature_pipeline(num_features, text_col, clean_mode).getStages()
    return Pipeline(stages=[*stages, classifier(reg_param, max_iter)])


def with_weights(df: DataFrame, label_col: str = "label", weighted: bool = True) -> DataFrame:
    """Adds ``label_id`` and the inverse-frequency ``weight``, or 1 for all
    when not ``weighted`` (the weights table has one row per label of the
    fixed domain, so broadcasting it is bounded)."""
    if not weighted:
        return df.withColumn("weight", F.lit(1.0)).withColumn("label_id", label_index(label_col))
    w = datasets.class_weights(df, label_col)
    return df.join(F.broadcast(w.withColumnRenamed("label", label_col)), label_col) \
        .withColumn("label_id", label_index(label_col))


def once(value) -> Column:
    """``value`` as the only row of a generator: whatever reads it, and filters on
    what is made of it, does not work it out again from the text."""
    return F.explode(F.array(value))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds ``label, confidence, scores`` (argmax of the probability vector;
    ties go to the first label in the fixed order)."""
    scored = model.transform(df.drop("label") if "label" in df.columns else df)
    drop = [c for c in scored.columns if c.startswith("_") or c in ("rawPrediction", "probability", "prediction")]
    kept = [c for c in scored.columns if c not in drop]
    return scored.select(*kept, once(vector_to_array("probability")).alias("_p")).withColumn("_s", label_scores(F.col("_p"), LABELS)).select(
        *kept,
        F.col("_s.label").alias("label"), F.col("_s.confidence").alias("confidence"),
        F.col("_s.scores").alias("scores"))


def metrics_for(model: PipelineModel, df: DataFrame, label_col: str = "label") -> tuple[DataFrame, DataFrame]:
    """(class metrics, summary) of a model on a labelled split."""
    pred = predict(model, df.withColumnRenamed(label_col, "gold_label"))
    return metrics_of(pred)


def metrics_of(pred: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(class metrics, summary) of ``gold_label`` vs ``label`` rows; the
    tiny confusion table is built once and shared by both."""
    cm = evaluation.confusion_matrix(pred).cache()
    return evaluation.class_metrics(cm), evaluation.summary(cm)


@dataclass
class TrainResult:
    model: PipelineModel
    reg_param: float
    history: list = field(default_factory=list)
    train_seconds: float = 0.0
    train_size: int = 0
    weighted: bool = True
    test: dict = field(default_factory=dict)

    def measure(self, test: DataFrame, label_col: str = "label") -> TrainResult:
        """Adds the metrics on a test split to the metadata."""
        pred = predict(self.model, test.withColumnRenamed(label_col, "gold_label"))
        cm = evaluation.confusion_matrix(pred).cache()
        row = evaluation.summary(cm).first()
        per = {r["label"]: {k: r[k] for k in ("precision", "recall", "f1", "support")} for r in evaluation.classification_report(cm).collect()}
        cells = {(r["gold"], r["pred"]): r["n"] for r in cm.collect()}
        self.test = {"accuracy": row["accuracy"], "macro_f1": row["macro_f1"], "per_class": per,
                     "confusion_matrix": [[cells[g, p] for p in LABELS] for g in LABELS]}
        return self

    def metadata(self, name: str = "sentiment-lr") -> dict:
        stamp = time.strftime("%Y%m%d-%H%M%S", time.gmtime())
        return {"model_version": f"{name}@{stamp}", "base_model": "hashing-tf-idf-logreg",
                "labels": LABELS, "trained_at": stamp, "train_seconds": round(self.train_seconds),
                "device": "spark", "hyperparameters": {"regParam": self.reg_param, "class_weights": self.weighted},
                "train_size": self.train_size, "history": self.history, "test": self.test}


def known_label(col: str):
    """``label_index`` that stops the job on a label outside the domain."""
    outside = F.concat(F.lit("label outside "), F.lit(",".join(LABELS)), F.lit(": "), F.coalesce(F.col(col), F.lit("null")))
    return F.coalesce(label_index(col), F.raise_error(outside).cast("double"))


def validation_scores(rows: DataFrame, fits: list[stacked_fit.Fit]) -> list:
    """``accuracy`` and ``macro_f1`` of every fit on rows of ``_features`` and
    ``_gold``, out of one pass over them."""
    name = lambda c: F.element_at(F.array(*[F.lit(x) for x in LABELS]), F.col(c) + 1)
    counts = stacked_fit.confusion_counts(rows, fits, "_features", "_gold").collect()  # nine rows a fit
    cells = rows.sparkSession.createDataFrame([tuple(r) for r in counts], "candidate int, gold int, pred int, n long")
    cells = cells.select("candidate", name("gold").alias("gold"), name("pred").alias("pred"), "n")
    each = [evaluation.summary(cells.where(F.col("candidate") == k)).withColumn("candidate", F.lit(k)) for k in range(len(fits))]
    return sorted(reduce(DataFrame.unionByName, each).collect(), key=lambda r: r["candidate"])


def train_classifier(train: DataFrame, val: DataFrame, reg_params=(0.0, 0.01, 0.1),
                     label_col: str = "label", text_col: str = "text", clean_mode: str = "arabic",
                     num_features: int = 1 << 16, max_iter: int = 30, weighted: bool = True) -> TrainResult:
    """Cleans, tokenizes and hashes the training texts once (cached term
    frequencies feed both the IDF fit and the features), then fits the logistic
    regressions of all ``reg_params`` together (``stacked_fit``: one pass over
    the features answers all of them) and keeps the best on validation
    macro-F1 (strictly greater, so the earliest wins ties). What reaches the
    driver are sums of gradients and confusion counts."""
    t0 = time.time()
    tr = with_weights(train, label_col, weighted)
    stages = feature_pipeline(num_features, text_col, clean_mode).getStages()
    pre = Pipeline(stages=stages[:3]).fit(tr)                 # stateless transformers
    tf = pre.transform(tr).select("_tf", "label_id", "weight").cache()
    idf = stages[3].fit(tf)
    feats = PipelineModel(stages=[*pre.stages, idf])
    ftr = idf.transform(tf).select("_features", "label_id", "weight").cache()
    size = ftr.count()
    tf.unpersist()
    fval = feats.transform(val.withColumnRenamed(label_col, "gold_label")) \
        .select("_features", known_label("gold_label").alias("_gold")).cache()
    fits = stacked_fit.fit_all(ftr, reg_params, len(LABELS), max_iter=max_iter)
    told = validation_scores(fval, fits)
    history = [{"regParam": rp, "val_macro_f1": r["macro_f1"], "val_accuracy": r["accuracy"]} for rp, r in zip(reg_params, told, strict=True)]
    scores = [h["val_macro_f1"] for h in history]
    best = scores.index(max(scores))
    model = PipelineModel(stages=[*feats.stages, stacked_fit.as_model(fits[best], classifier(reg_params[best], max_iter))])
    ftr.unpersist()
    fval.unpersist()
    return TrainResult(model, reg_params[best], history, time.time() - t0, size, weighted)


def save_model(result: TrainResult, path: str, name: str = "sentiment-lr") -> dict:
    """Saves the pipeline and its metadata (``training_meta`` JSON) to a
    versioned path; the metadata's ``model_version`` names the model."""
    meta = result.metadata(name)
    result.model.write().overwrite().save(path)
    SparkSession.getActiveSession().createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
        .write.mode("overwrite").text(f"{path.rstrip('/')}/training_meta")
    return meta


def train_binary(train: DataFrame, label_col: str = "label", text_col: str = "text", class_weights: dict[int, float] | None = None,
                 reg_param: float = 0.01, clean_mode: str = "tweet", num_features: int = 1 << 16, max_iter: int = 30) -> PipelineModel:
    """A two-class model (labels 0 and 1): clean → tokenize → hashing TF →
    IDF → logistic regression, one sigmoid output. ``class_weights``: weight
    of each class, 1 where not given. Texts are cleaned, tokenized and hashed
    once: the IDF fit and the passes of the regression read the held term
    frequencies."""
    weight = F.lit(1.0)
    for k, w in (class_weights or {}).items():
        weight = F.when(F.col(label_col) == k, F.lit(float(w))).otherwise(weight)
    rows = train.select(text_col, F.col(label_col).cast("double").alias("label_id"), weight.alias("weight"))
    lr = LogisticRegression(featuresCol="_features", labelCol="label_id", weightCol="weight", regParam=reg_param,
                            maxIter=max_iter, family="binomial")
    stages = feature_pipeline(num_features, text_col, clean_mode).getStages()
    pre = Pipeline(stages=stages[:3]).fit(rows)               # stateless transformers
    tf = pre.transform(rows).select("_tf", "label_id", "weight").cache()
    idf = stages[3].fit(tf)
    model = PipelineModel(stages=[*pre.stages, idf, lr.fit(idf.transform(tf))])
    tf.unpersist()
    # A two-class model's training summary holds the session, which does not serialise once the
    # session has observed metrics; scoring has no use for it.
    model.stages[-1]._java_obj.setSummary(rows.sparkSession.sparkContext._jvm.scala.Option.empty())
    return model


def predict_binary(model: PipelineModel, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Adds ``prob`` (of class 1) and ``label`` (1 if ``prob`` reaches the
    threshold)."""
    rows = df.drop("label") if "label" in df.columns else df
    prob = F.get(vector_to_array("probability"), F.lit(1))
    scored = model.transform(rows).select(*rows.columns, once(prob).alias("prob"))
    return scored.withColumn("label", (F.col("prob") >= threshold).cast("int"))
