"""Toxicity: FTRL-proximal logistic regression over hashed word features.

Features of a text, hashed into ``2**bits`` buckets: its words (runs of word
characters, lower-cased), the words cut to their first ``stem`` letters, pairs
of neighbours, and skip-grams (pairs with one word between). A feature is there
or not, however often. Per-coordinate rates let rare words move quickly;
the L1 penalty leaves a few thousand weights, which is what is broadcast.

Learning takes about ``per_class`` labelled documents of each class (documented
bound, chosen by a hash of the id over all labels) in one task, which weights
them so that both classes have the shares that all labels have; ``passes``
passes in a seeded order. A last step fits slope and offset of the log-odds on
the documents that were kept back (one in five).

Scoring reads every whole text in stretches of ``STRETCH`` characters cut at
white space (the two words before a cut are carried over, so no pair is
lost), in one map pass without a shuffle.

Defined cases: null and empty texts have no features, so their score comes
from the offset alone; a null label is no label; if labels of one document
differ the largest counts; with labels of one class only, or none, every score
is the share of label 1 (0 without labels); rows with a null id are scored and
never learnt from; repeated rows are scored each and learnt from once, an id with
several texts by the largest of them; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodstream.llm.common import fold, hash_sample, one_per_id, prepare, unit_hash
from moodstream.llm.ftrl import Ftrl

THRESHOLD = 0.3
# The held-out fold: crc32 of the id modulo 4 is 2.
MODULUS, HELD_OUT = 4, 2
BITS, STEM, STRETCH, REMEMBER = 20, 4, 1 << 20, 400_000
# Odd numbers that set the kinds of features apart.
NEXT, SKIP, CUT = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_words = re.compile(r"\w+").findall


@dataclass(frozen=True)
class Model:
    """Weights of the features that have one; calibrated log-odds are
    ``slope * (sum of weights) + offset``."""

    features: np.ndarray
    weights: np.ndarray
    slope: float
    offset: float


class Features:
    def __init__(self, bits: int = BITS):
        self.shift = np.uint64(64 - bits)
        self.known: dict[str, tuple[int, int]] = {}

    def _hash(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        known, digest = self.known, xxhash.xxh64_intdigest
        if len(known) > REMEMBER:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = digest(w.encode("utf-8", "surrogatepass")), digest(w[:STEM].encode("utf-8", "surrogatepass"))
        pairs = [known[w] for w in words]
        return np.array([p[0] for p in pairs], np.uint64), np.array([p[1] for p in pairs], np.uint64)

    def stretches(self, text: str | None) -> Iterator[np.ndarray]:
        """Buckets (repeats included) of each stretch of the text."""
        text, at, before = (text or "").lower(), 0, np.empty(0, np.uint64)
        while at < len(text):
            end = at + STRETCH
            while end < len(text) and not text[end].isspace():
                end += 1
            whole, stem = self._hash(_words(text[at:end]))
            h = np.concatenate([before, whole])
            out = [whole * CUT, stem * SKIP + CUT]
            with np.errstate(over="ignore"):
                for gap, factor in ((1, NEXT), (2, SKIP)):
                    first = max(0, len(before) - gap)
                    out.append((h[first:-gap] * factor + h[first + gap :]) * NEXT)
            yield (np.concatenate(out) * NEXT) >> self.shift
            before, at = h[-2:], end

    def of(self, text: str | None) -> np.ndarray:
        parts = [np.unique(s) for s in self.stretches(text)]
        return np.unique(np.concatenate(parts)).astype(np.int64) if parts else np.empty(0, np.int64)


def _fit_line(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of weighted log-odds by Newton's method, slightly
    drawn to slope 1 and offset 0."""
    theta, start = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    design = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        g = design.T @ (weight * (p - y)) + 0.1 * (theta - start)
        h = (design * (weight * p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        step = np.linalg.solve(h, g)
        theta = theta - step * min(1.0, 1.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(theta[0]), float(theta[1])


def _learn(share: float, passes: int, alpha: float, beta: float, l1: float, l2: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, rows = Features(), []
        for b in batches:
            for u, y, text in zip(*(b.column(c).to_pylist() for c in ("_u", "_y", "_text")), strict=True):
                rows.append((u, y, make.of(text).astype(np.int32)))
        rows.sort(key=lambda r: (r[0], r[1], len(r[2])))
        kept_back, learnt = rows[::5], [r for k, r in enumerate(rows) if k % 5]
        if len({r[1] for r in kept_back}) < 2 or len({r[1] for r in learnt}) < 2:
            return
        mean = np.mean([r[1] for r in rows])
        weight = {1: share / mean, 0: (1 - share) / (1 - mean)}
        model, bias = Ftrl(1 << BITS, alpha, beta, l1, l2), Ftrl(1, alpha, beta, 0.0, 0.0)
        order = np.random.default_rng(seed)
        for _ in range(passes):
            for k in order.permutation(len(learnt)):
                _, y, at = learnt[k]
                w, b0 = model.weights(at), bias.weights()
                p = 1 / (1 + np.exp(-np.clip(w.sum() + b0[0], -30, 30)))
                g = weight[y] * (p - y)
                model.update(at, w, np.full(len(at), g))
                bias.update(slice(None), b0, np.array([g]))
        w = model.weights()
        x = np.array([w[r[2]].sum() for r in kept_back])
        y = np.array([r[1] for r in kept_back], float)
        slope, offset = _fit_line(x, y, np.where(y == 1, weight[1], weight[0]))
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_pydict({"features": [at.tolist()], "weights": [w[at].tolist()], "slope": [slope], "intercept": [offset]})

    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          per_class: int = 4000, passes: int = 6, alpha: float = 1.0, beta: float = 1.0, l1: float = 3.0, l2: float = 1e-3,
          seed: int = 9) -> Model:
    prepare(docs.sparkSession)
    known = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(MODULUS, id_col) != HELD_OUT))
        .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_y"))
    )
    counts = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    share = counts.get(1, 0) / sum(counts.values()) if counts else 0.0
    if not counts.get(0) or not counts.get(1):
        return _constant(share)
    parts = [hash_sample(known.where(F.col("_y") == k), per_class, counts[k], "_id", seed=seed) for k in (0, 1)]
    # About 2 x per_class ids, whatever the number of labels: small enough for every task.
    sample = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(parts[0].unionByName(parts[1])), "_id")
    sample = one_per_id(sample, "_y", "_text")
    sample = sample.select(unit_hash("_id", seed=seed + 1).alias("_u"), "_y", "_text").repartition(1)
    schema = "features array<long>, weights array<double>, slope double, intercept double"
    fitted = sample.mapInArrow(_learn(share, passes, alpha, beta, l1, l2, seed), schema).collect()
    if not fitted:
        return _constant(share)
    m = fitted[0]
    return Model(np.array(m["features"], np.int64), np.array(m["weights"]), m["slope"], m["intercept"])


def _constant(share: float) -> Model:
    p = min(max(share, 1e-9), 1 - 1e-9)
    return Model(np.empty(0, np.int64), np.empty(0), 0.0, float(np.log(p / (1 - p))))


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, weights = Features(), np.zeros(1 << BITS)
        weights[model.features] = model.weights
        live = weights != 0

        def total(text: str | None) -> float:
            found = [s[live[s]] for s in make.stretches(text)]
            return weights[np.unique(np.concatenate(found)).astype(np.int64)].sum() if found else 0.0

        for b in batches:
            x = np.array([total(t) for t in b.column("_text").to_pylist()], float)
            score = 1 / (1 + np.exp(-np.clip(model.slope * x + model.offset, -700, 700)))
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(score)], names=["_id", "_score"])

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, held_out, score, predicted."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    scored = texts.mapInArrow(_scores(model), "_id long, _score double")
    return scored.select(F.col("_id").alias(id_col), F.coalesce(fold(MODULUS, "_id") == HELD_OUT, F.lit(False)).alias("held_out"),
                         F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"))
