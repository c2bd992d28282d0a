"""Quality by compression: two zstandard dictionaries, one calibrated score.

One dictionary is trained on good and one on bad labelled text. A text is cut
into pieces of ``piece`` bytes (all of it, the last piece shorter) and each
piece is compressed with either dictionary; the two sums of compressed sizes
give the normalised difference ``(bad - good) / bytes of the text``. A rising
curve, fitted by isotonic regression on labelled documents that the
dictionaries have not seen, turns the difference into the probability of label
1. (A logistic curve fits badly: good texts spread widely above a narrow border
with bad ones.) Pieces keep the weight of the dictionaries the same in short
and long texts and bound the memory.

Learning uses about ``per_class`` labelled documents of each class, chosen by
a hash of the id over all labels (documented bound). In hash order, two of
three documents of a class train its dictionary and the third fits the curve.
Every one of them takes part, whatever its length and whenever it arrives: the
fitting ones are compressed whole, where they are, and each training one sends
its pieces to the one learning task, all of them as long as they fit into
``sample_bytes``. If not, one number of pieces that no document may exceed is
set from all lengths beforehand; longer documents send that many, evenly
spaced, shorter ones still all (at least one piece each). The class weights of
the curve restore the shares that all labels have. Scoring reads every whole
text, in one map pass without a shuffle; the model is two dictionaries of at
most ``dict_bytes``.

Defined cases: null and empty texts have difference 0, so their score is the
curve's value there; a label of null is no label; if labels of one document
differ the largest counts; with labels of one class only, or none, every score
is the share of label 1 (0.5 without labels); rows with a null id are scored
and never learnt from; repeated rows are scored each and learnt from once, an id with
several texts by the largest of them; an empty table gives an
empty result; extra columns are ignored by ``score`` and carried by
``accepted``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodstream.llm.common import fold, hash_sample, level, one_per_id, prepare, spaced, unit_hash

THRESHOLD = 0.3
# The held-out fold: crc32 of the id modulo 5 is 0.
MODULUS, HELD_OUT = 5, 0
LEVEL, PIECE = 3, 2048


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    at: tuple[float, ...]  # differences, rising
    score: tuple[float, ...]  # probability of label 1 at each, linear between


class Sizes:
    """Compressed sizes of texts under two dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.both = [self._compressor(d) for d in (good, bad)]

    @staticmethod
    def _compressor(data: bytes) -> zstandard.ZstdCompressor:
        shared = zstandard.ZstdCompressionDict(data)
        shared.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=shared, write_content_size=False, write_dict_id=False, write_checksum=False)

    def difference(self, text: str | None) -> float:
        data = memoryview((text or "").encode("utf-8", "surrogatepass"))
        if not data:
            return 0.0
        good, bad = (sum(len(c.compress(data[at : at + PIECE])) for at in range(0, len(data), PIECE)) for c in self.both)
        return (bad - good) / len(data)


def rising_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[list[float], list[float]]:
    """Weighted isotonic regression by pooling neighbours: (places, values).
    Each pool's value is drawn a little to the overall mean."""
    mean, pools = float((y * weight).sum() / weight.sum()), []
    for k in np.lexsort((y, x)):
        pools.append([x[k] * weight[k], y[k] * weight[k], weight[k]])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return [float(p[0] / p[2]) for p in pools], [float((p[1] + 0.1 * mean) / (p[2] + 0.1)) for p in pools]


def _dictionary(pieces: list[bytes], size: int) -> bytes:
    total = sum(map(len, pieces))
    try:
        return zstandard.train_dictionary(min(size, max(256, total // 8)), pieces, k=256, d=8).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself serves as a raw dictionary
        return b"".join(pieces)[-size:] or b" "


def _pieces(training: frozenset[float], most: int):
    """The pieces of each training document, ``most`` evenly spaced ones of a longer one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for u, y, text in zip(*(b.column(c).to_pylist() for c in ("_u", "_y", "_text")), strict=True):
                if u in training:
                    data = (text or "").encode("utf-8", "surrogatepass")
                    pieces = [data[at * PIECE : (at + 1) * PIECE] for at in spaced(-(-len(data) // PIECE), most)]
                    yield pa.RecordBatch.from_pydict({"_u": [u], "_y": pa.array([y], pa.int32()), "pieces": pa.array([pieces], pa.list_(pa.binary()))})

    return run


def _dictionaries(dict_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("_u", "_y", "pieces")), strict=True))
        good, bad = (_dictionary([p for _, y, pieces in rows if y == k for p in pieces], dict_bytes) for k in (1, 0))
        yield pa.RecordBatch.from_pydict({"good": [good], "bad": [bad]})

    return run


def _differences(training: frozenset[float], good: bytes, bad: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(good, bad)
        for b in batches:
            rows = [r for r in zip(*(b.column(c).to_pylist() for c in ("_u", "_y", "_text")), strict=True) if r[0] not in training]
            yield pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows], pa.int32()), pa.array([sizes.difference(r[2]) for r in rows], pa.float64())],
                                             names=["_y", "x"])

    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          per_class: int = 3000, dict_bytes: int = 262144, sample_bytes: int = 64 << 20, seed: int = 6) -> Model:
    prepare(docs.sparkSession)
    known = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(MODULUS, id_col) != HELD_OUT))
        .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_y"))
    )
    counts = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    if not counts.get(0) or not counts.get(1):
        return _constant(share)
    parts = [hash_sample(known.where(F.col("_y") == k), per_class, counts[k], "_id", seed=seed) for k in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    # About 2 x per_class ids, whatever the number of labels: small enough for every task.
    sample = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")
    sample = one_per_id(sample, "_y", "_text")
    # Written out: read for the lengths, the dictionaries and the curve.
    sample = sample.select(unit_hash("_id", seed=seed + 1).alias("_u"), F.col("_y"), F.col("_text")).checkpoint()
    lengths = sorted(tuple(r) for r in sample.select("_u", "_y", F.coalesce(F.octet_length("_text"), F.lit(0))).collect())
    # Two of three documents of a class, in hash order, train its dictionary; the third fits the curve.
    turns = {k: [[r for i, r in enumerate(of) if i % 3 // 2 == j] for j in (0, 1)] for k in (0, 1) for of in [[r for r in lengths if r[1] == k]]}
    if not all(turns[k][j] for k in (0, 1) for j in (0, 1)):
        return _constant(share)
    training = frozenset(r[0] for k in (0, 1) for r in turns[k][0])
    most = level([-(-r[2] // PIECE) for k in (0, 1) for r in turns[k][0]], sample_bytes // PIECE)
    pieces = sample.mapInArrow(_pieces(training, most), "_u double, _y int, pieces array<binary>").repartition(1)
    trained = pieces.mapInArrow(_dictionaries(dict_bytes), "good binary, bad binary").first()
    good, bad = bytes(trained["good"]), bytes(trained["bad"])
    x, z = (np.array(v, float) for v in zip(*[(r["x"], r["_y"]) for r in sample.mapInArrow(_differences(training, good, bad), "_y int, x double").collect()], strict=True))
    weight = np.where(z == 1, share / z.mean(), (1 - share) / (1 - z.mean()))
    places, values = rising_curve(x, z, weight)
    return Model(good, bad, tuple(places), tuple(values))


def _constant(share: float) -> Model:
    return Model(b" ", b" ", (0.0,), (float(share),))


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(model.good, model.bad)
        for b in batches:
            x = np.array([sizes.difference(t) for t in b.column("_text").to_pylist()], float)
            score = np.interp(x, model.at, model.score)
            rest = [b.column(i) for i in range(b.num_columns) if b.schema.names[i] != "_text"]
            names = [n for n in b.schema.names if n != "_text"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(score)], names=[*names, "_score"])

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, held_out, score, predicted."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    scored = texts.mapInArrow(_scores(model), "_id long, _score double")
    return scored.select(F.col("_id").alias(id_col), F.coalesce(fold(MODULUS, "_id") == HELD_OUT, F.lit(False)).alias("held_out"),
                         F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows predicted good, with all columns; no join, no shuffle."""
    prepare(docs.sparkSession)
    row: Column = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    held = docs.select(row.alias("_row"), F.col(text_col).alias("_text"))
    kind = T.StructType([T.StructField("_row", held.schema["_row"].dataType), T.StructField("_score", T.DoubleType())])
    scored = held.mapInArrow(_scores(model), kind)
    return scored.where(F.col("_score") >= threshold).select("_row.*")
