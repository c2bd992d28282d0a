"""Points with the spans that cover them, by a sweep over range partitions.

A range join on ``lo <= point <= hi`` compares everything with everything of a
key, and expanding each span into the points of a grid costs its length even
where no point lies. Here points and span starts are ranged by (key, time). A
span that reaches beyond its partition is handed to the partitions after it up
to its end, which a table with one row per partition tells. Each partition is
then swept once in order of time with the spans that are open. The work is
that of the sort plus the rows that come out: a span only goes to partitions
that hold rows between its ends, and spans may overlap. A key that holds most
of the points, or of the spans, is cut into pieces like any other.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodstream.plans.ordered import PID, range_partitioned
from moodstream.plans.scalar import attach_row

# Rows that a task gives out at once.
OUT_ROWS = 50_000


def _changes(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    """Whether a row differs from the one before it in ``names`` (nulls are equal); the first row does."""
    out = np.zeros(len(batch), bool)
    out[:1] = True
    for c in names:
        col = batch.column(c)
        a, b = col.slice(0, max(len(col) - 1, 0)), col.slice(1)
        differ = pc.fill_null(pc.not_equal(a, b), False)
        out[1:] |= np.asarray(pc.or_(differ, pc.not_equal(pc.is_null(a), pc.is_null(b))), dtype=bool)
    return out


def _sweep(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[tuple[int, pa.Array]] = []  # end and row of the spans that are open
        last = None
        for b in batches:
            if not len(b):
                continue
            t, is_span = np.asarray(b.column("_t")), np.asarray(b.column("_k")) == 0
            changed = _changes(b, names)
            here = tuple(b.column(c)[0].as_py() for c in names)
            changed[0] = here != last
            last = tuple(b.column(c)[len(b) - 1].as_py() for c in names)
            points, spans, hi = b.column("_p"), b.column("_s"), b.column("_hi")
            # Stretches of points between which the open spans stay the same.
            cuts = np.flatnonzero(changed | is_span | np.r_[False, is_span[:-1]])
            at: list[np.ndarray] = []
            slots: list[np.ndarray] = []
            used: list[pa.Array] = []
            held = 0

            def flush():
                if not at:
                    return None
                rows, slot = np.concatenate(at), np.concatenate(slots)
                pool = pa.concat_arrays([*used, spans.slice(0, 0)])
                found = pool.take(pa.array(slot, mask=slot < 0)) if len(pool) else pa.nulls(len(slot), spans.type)
                at.clear(), slots.clear(), used.clear()
                return pa.RecordBatch.from_arrays([points.take(pa.array(rows)), found], names=["_p", "_s"])

            edges = np.unique(np.r_[0, cuts, len(b)])
            for lo, end in zip(edges[:-1], edges[1:], strict=True):
                if changed[lo]:
                    open_ = []
                if is_span[lo]:
                    open_.append((hi[int(lo)].as_py(), spans.slice(int(lo), 1)))
                    continue
                times, most = t[lo:end], 0
                open_ = [o for o in open_ if o[0] >= times[0]]
                for until, span in open_:
                    n = int(np.searchsorted(times, until, side="right"))
                    most = max(most, n)
                    for k in range(0, n, OUT_ROWS):
                        some = np.arange(lo + k, lo + min(n, k + OUT_ROWS))
                        at.append(some), slots.append(np.full(len(some), len(used))), used.append(span)
                        held += len(some)
                        if held >= OUT_ROWS:
                            yield flush()
                            held = 0
                alone = np.arange(lo + most, end)
                at.append(alone), slots.append(np.full(len(alone), -1))
                held += len(alone)
            if (rest := flush()) is not None:
                yield rest

    return run


def covering(points: DataFrame, spans: DataFrame, point_col: str, lo_col: str, hi_col: str, keys: Sequence[str] = (),
             num_partitions: int | None = None) -> DataFrame:
    """Left join of ``points`` with the ``spans`` of their ``keys`` (columns of both,
    nulls equal each other) that have ``lo <= point <= hi`` (long columns): the
    columns of both, those of the spans null where none covers a point. Spans
    without a bound, or whose end comes before their start, cover nothing;
    points without a time are covered by nothing. Repeated rows count each."""
    keys = list(keys)
    own = [f"_key{i}" for i in range(len(keys))]
    span_cols = [c for c in spans.columns if c not in keys]
    named = [F.col(k).alias(o) for k, o in zip(keys, own, strict=True)]
    nothing = lambda df, cols: F.lit(None).cast(T.StructType([df.schema[c] for c in cols]))
    # Sets rows of one time apart, so that a range border can fall between them.
    hashed = lambda df, cols: F.xxhash64(*[c for c in cols if isinstance(df.schema[c].dataType, T.AtomicType)])
    p_row, s_row = F.struct(*points.columns), F.struct(*span_cols)
    usable = spans.where(F.col(lo_col) <= F.col(hi_col))
    starts = usable.select(*named, F.col(lo_col).cast("long").alias("_t"), F.lit(0).alias("_k"), F.col(hi_col).cast("long").alias("_hi"),
                           hashed(spans, span_cols).alias("_h"), nothing(points, points.columns).alias("_p"), s_row.alias("_s"))
    timed = points.where(F.col(point_col).isNotNull())
    asks = timed.select(*named, F.col(point_col).cast("long").alias("_t"), F.lit(1).alias("_k"), F.lit(None).cast("long").alias("_hi"),
                        hashed(points, points.columns).alias("_h"), p_row.alias("_p"), nothing(spans, span_cols).alias("_s"))
    order = [*own, "_t", "_k"]
    ranged = range_partitioned(starts.unionByName(asks), [*order, "_h"], num_partitions)
    tasks = max(1, num_partitions or int(ranged.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    place = lambda t: F.struct(*[F.col(o) for o in own], F.col(t).alias("_t"))
    bounds = ranged.groupBy(PID).agg(F.min(place("_t")).alias("first"), F.max(place("_t")).alias("last")).checkpoint()
    listed = bounds.agg(F.array_sort(F.collect_list(F.struct(PID, "first"))).alias("_b"))  # one entry per partition
    # A span whose end lies in its own partition goes nowhere else.
    far = ranged.where("_k = 0").join(F.broadcast(bounds.select(PID, "last")), PID).where(place("_hi") >= F.col("last")).drop("last")
    beyond = F.filter("_b", lambda b: (b[PID] > F.col(PID)) & (b["first"] <= place("_hi")))
    far = attach_row(far, listed)
    carried = far.withColumn("_to", F.explode(F.transform(beyond, lambda b: b[PID]))).drop(PID, "_b").withColumnRenamed("_to", PID)
    both = ranged.unionByName(carried).repartitionById(tasks, F.col(PID)).sortWithinPartitions(PID, *order)
    shape = T.StructType([T.StructField("_p", ranged.schema["_p"].dataType), T.StructField("_s", ranged.schema["_s"].dataType)])
    swept = both.select(PID, *own, "_t", "_k", "_hi", "_p", "_s").mapInArrow(_sweep([PID, *own]), shape).select("_p.*", "_s.*")
    untimed = points.where(F.col(point_col).isNull()).select("*", *[F.lit(None).cast(spans.schema[c].dataType).alias(c) for c in span_cols])
    return swept.unionByName(untimed)
