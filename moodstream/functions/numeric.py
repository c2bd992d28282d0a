"""Numeric column helpers: safe division, softmax and argmax over arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_div(num, den, default: float = 0.0) -> Column:
    """``num / den``, or ``default`` when the denominator is 0 or null."""
    return F.coalesce(F.try_divide(_c(num).cast("double"), _c(den)), F.lit(default))


def softmax(logits) -> Column:
    """Softmax over an ARRAY<DOUBLE> with max-shift for stability."""
    arr = _c(logits)
    m = F.array_max(arr)
    ex = F.transform(arr, lambda x: F.exp(x - m))
    tot = F.aggregate(ex, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(ex, lambda x: x / tot)


def argmax_index(probs) -> Column:
    """1-based index of the largest value; ties go to the first one."""
    arr = _c(probs)
    return F.array_position(arr, F.array_max(arr)).cast("int")


def label_scores(probs, labels: list[str]) -> Column:
    """(label, confidence, scores map) struct from a probability array."""
    arr = _c(probs)
    names = F.array(*[F.lit(x) for x in labels])
    idx = argmax_index(arr)
    ok = arr.isNotNull() & (F.size(arr) == F.lit(len(labels)))
    return F.struct(
        F.when(ok, F.element_at(names, idx)).alias("label"),
        F.when(ok, F.element_at(arr, idx)).alias("confidence"),
        F.when(ok, F.map_from_arrays(names, arr)).alias("scores"),
    )
