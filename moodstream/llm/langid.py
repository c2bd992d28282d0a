"""Language of a text: sparse multinomial logistic regression on TF-IDF.

Features are the 1-, 2- and 3-grams of the lower-cased characters, hashed into
``2**bits`` buckets; a text's vector is count times inverse document frequency,
of length 1. Three steps:

1. Document frequencies over all documents that may be learnt from: each task
   sums one array of ``2**bits`` counts, one aggregate adds them up.
2. Weights by follow-the-regularised-leader with per-coordinate rates, an L1
   and an L2 penalty (elastic net), on about ``sample`` documents in equal
   parts per language (documented bound; chosen by a hash of the id over all
   documents), in one task, which holds at most about ``sample_bytes`` of
   features: a language whose long texts would take more than its part gives
   fewer of them, by a hash again. One in five is kept back; on these a single
   temperature is fitted that divides the scores of all languages.
3. Prediction over every whole text, in one map pass without a shuffle. The
   broadcast model has one number per bucket and at most one per bucket and
   language. Its size is bounded by ``max_langs``: of more language values (a
   dirty column) the ones with the most documents are learnt, of equal ones the
   first in order, and the rows of the others are predicted like any other.

Long texts are read in stretches of ``STRETCH`` characters whose n-grams at the
border are kept, so the counts are those of the whole text.

Defined cases: a null text or one without a letter is ``und`` with score 0, and
is not learnt from; a null language or id is not learnt from; equal scores go
to the language first in order; with no language to learn from everything is
``und``; repeated rows are predicted each and give the weights one example per
id (of several texts the largest); an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodstream.llm.common import fold, level, one_per_id, prepare, unit_hash
from moodstream.llm.ftrl import Ftrl

# The held-out fold: crc32 of the id modulo 5 is 0.
MODULUS, HELD_OUT = 5, 0
BITS, GRAMS, STRETCH = 16, 3, 1 << 20
MIX, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x100000001B3)
_letter = regex.compile(r"\p{L}").search


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    idf: np.ndarray
    features: np.ndarray  # buckets that have a weight
    weights: np.ndarray  # of each such bucket, by language
    bias: np.ndarray
    temperature: float


def has_letter(text: str | None) -> bool:
    return bool(text) and _letter(text) is not None


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the 1- to 3-grams of a text."""
    text, total = text.lower(), np.zeros(1 << BITS, np.int64)
    for at in range(0, len(text), STRETCH):
        # n-grams that begin in this stretch may end in the next one.
        codes = np.frombuffer(text[at : at + STRETCH + GRAMS - 1].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        begins, h = min(STRETCH, len(text) - at), None
        for n in range(GRAMS):
            h = codes + np.uint64(1) if h is None else h[: len(codes) - n] * STEP + codes[n:]
            total += np.bincount(((h[:begins] * MIX) >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS)
    at = np.flatnonzero(total)
    return at, total[at]


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, n = gram_counts(text)
    x = n * idf[at]
    return at, x / np.sqrt(x @ x)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(1 << BITS, np.int64), 0
    for b in batches:
        for text in b.column(0).to_pylist():
            if has_letter(text):
                df[gram_counts(text)[0]] += 1
                n += 1
    if n:
        at = np.flatnonzero(df)
        # Bucket -1 counts the documents.
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[at, -1]), pa.array(np.r_[df[at], n])], names=["bucket", "n"])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least log loss (golden section)."""
    def loss(t: float) -> float:
        return -np.log(np.maximum(softmax(logits / np.exp(t))[np.arange(len(y)), y], 1e-300)).mean()

    lo, hi, ratio = -4.0, 4.0, (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def _learn(langs: tuple[str, ...], idf_of, passes: int, alpha: float, beta: float, l1: float, l2: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, place, rows = idf_of.value, {k: i for i, k in enumerate(langs)}, []
        for b in batches:
            for u, lang, text in zip(*(b.column(c).to_pylist() for c in ("_u", "_lang", "_text")), strict=True):
                if has_letter(text):
                    at, x = vector(text, idf)
                    rows.append((u, place[lang], at.astype(np.int32), x.astype(np.float32)))
        rows.sort(key=lambda r: (r[0], r[1], len(r[2])))
        if not rows:
            return
        kept_back, learnt = rows[::5], [r for k, r in enumerate(rows) if k % 5] or rows
        model, bias = Ftrl((1 << BITS, len(langs)), alpha, beta, l1, l2), Ftrl(len(langs), alpha, beta, 0.0, 0.0)
        order = np.random.default_rng(seed)
        for _ in range(passes):
            for k in order.permutation(len(learnt)):
                _, y, at, x = learnt[k]
                w, b0 = model.weights(at), bias.weights()
                g = softmax(x @ w + b0)
                g[y] -= 1
                model.update(at, w, x[:, None] * g)
                bias.update(slice(None), b0, g)
        w, b0 = model.weights(), bias.weights()
        logits = np.array([x @ w[at] + b0 for _, _, at, x in kept_back])
        temperature = fit_temperature(logits, np.array([r[1] for r in kept_back]))
        at = np.flatnonzero((w != 0).any(axis=1))
        yield pa.RecordBatch.from_pydict({"features": [at.tolist()], "weights": [w[at].ravel().tolist()], "bias": [b0.tolist()], "temperature": [temperature]})

    return run


def _rate(rates: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(v) for pair in rates.items() for v in pair])[F.col("_lang")]


def _sample(known: DataFrame, rates: dict[str, float], seed: int) -> DataFrame:
    """One row (_id, _text, _lang) of each id whose hash falls below the rate of its language."""
    return one_per_id(known.where(unit_hash("_id", seed=seed) < _rate(rates)), "_text", "_lang")


def _bounded(chosen: DataFrame, sample_bytes: int) -> DataFrame:
    """``chosen`` (written out), thinned where a language's features would take more than a
    level that all together keep to ``sample_bytes``. A text of n characters has at
    most min(3 n, buckets) features of 8 bytes."""
    most = F.least(F.lit(GRAMS) * F.coalesce(F.length("_text"), F.lit(0)), F.lit(1 << BITS)).cast("long") * 8
    size = {r["_lang"]: r["n"] for r in chosen.groupBy("_lang").agg(F.sum(most).alias("n")).collect()}
    top = level(list(size.values()), sample_bytes)
    return chosen if max(size.values(), default=0) <= top else chosen.where(F.col("_u") < _rate({k: min(1.0, top / max(n, 1)) for k, n in size.items()}))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = 6000,
          passes: int = 4, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.2, l2: float = 1e-3, max_langs: int = 200,
          sample_bytes: int = 512 << 20, seed: int = 3) -> Model:
    spark = prepare(docs.sparkSession)
    known = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & (fold(MODULUS, id_col) != HELD_OUT))
    known = known.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"))

    summed = known.select("_text").mapInArrow(_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    df = np.zeros((1 << BITS) + 1)
    for r in summed:  # one row per bucket
        df[r["bucket"]] = r["n"]
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1

    per_lang = known.select("_lang", "_id").distinct().groupBy("_lang").agg(F.count("*").alias("n"))
    sizes = {r["_lang"]: r["n"] for r in per_lang.orderBy(F.desc("n"), "_lang").limit(max_langs).collect()}
    langs = tuple(sorted(sizes))
    none = Model((), idf, np.empty(0, np.int64), np.empty((0, 0)), np.empty(0), 1.0)
    if not langs:
        return none
    each = max(20, sample // len(langs))
    rates = {k: min(1.0, each / sizes[k]) for k in langs}
    # A language that is not learnt has no rate, and null is below nothing.
    chosen = _sample(known, rates, seed).select(unit_hash("_id", seed=seed + 1).alias("_u"), "_lang", "_text").checkpoint()
    chosen = _bounded(chosen, sample_bytes).repartition(1)
    learn = _learn(langs, spark.sparkContext.broadcast(idf), passes, alpha, beta, l1, l2, seed)
    fitted = chosen.mapInArrow(learn, "features array<long>, weights array<double>, bias array<double>, temperature double").collect()
    if not fitted:
        return none
    m = fitted[0]
    weights = np.array(m["weights"]).reshape(-1, len(langs))
    return Model(langs, idf, np.array(m["features"], np.int64), weights, np.array(m["bias"]), m["temperature"])


def _predict(model_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of.value
        dense = np.zeros((1 << BITS, len(model.langs)))
        if model.langs:
            dense[model.features] = model.weights

        def one(text: str | None) -> tuple[str, float]:
            if not model.langs or not has_letter(text):
                return "und", 0.0
            at, x = vector(text, model.idf)
            p = softmax((x @ dense[at] + model.bias) / model.temperature)
            best = int(p.argmax())
            return model.langs[best], float(p[best])

        for b in batches:
            out = [one(t) for t in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64())],
                names=["_id", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score."""
    spark = prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    out = texts.mapInArrow(_predict(spark.sparkContext.broadcast(model)), "_id long, lang_pred string, score double")
    return out.select(F.col("_id").alias(id_col), F.coalesce(fold(MODULUS, "_id") == HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score")
