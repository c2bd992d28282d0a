"""The TTL join with everything that one id can go through, in batch.

A half that arrives when its id has nothing pending and no fresh join starts an
*epoch* and waits. The first half of the other side that arrives less than
``ttl`` later joins it, and for ``dedupe`` from then on every half of the id is a
duplicate; without one the epoch expires after ``ttl``, and halves of the same
side that came meanwhile are duplicates. The next half at or after the end of
the epoch starts the next one. ``joining.join_reviews`` looks at the first halves
only; here a half that is delivered again after expiry or after the dedupe
period waits again, as in the stream (``streaming.join_timers``).

An id's epochs follow from each other, but what a half starts depends on that
half alone: if it starts an epoch, its partner and the end of the epoch are known
from the halves after it, and the next epoch starts at the first half at or after
the end.

1. Halves are ranged by (id, time, order) and sorted, in as many partitions as
   keep one near ``HALVES``. An id that lies inside a partition is walked there, in
   the same pass. Of a partition's first and last id, which may go on in others, that
   pass holds back the halves that can count: at one time the first of each side. If
   all that is held back is no more than ``HALVES``, one task walks it.
2. Otherwise an id that goes over several is a *span* of pieces, one a partition. What the
   later pieces hold first of each side comes from a table with one row per piece.
   Each piece tells, for each time at which one of its halves may start an epoch,
   the end with which the chain from there leaves the piece.
3. Ends are the nodes: the first half at or after an end, in the piece where it
   lies, gives the end with which the chain leaves that piece. Pointer doubling
   from a span's first half finds the ends that are reached (after k rounds all that
   are less than 2^k pieces away), at most one for each piece.
4. The halves held back are walked, a piece from the end that reaches it.

No task gets more than about ``HALVES`` of an id's halves. The epochs and the halves held
back, the pieces' ends and each round are written to the shared checkpoint folder; the
driver holds a few numbers per partition.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodstream.functions.time import epoch_micros, from_micros
from moodstream.operators.joining import PREDICTION, RAW
from moodstream.plans.ordered import PID, default_partitions
from moodstream.session import checkpoint_dir

# Halves that one task sorts and walks, about.
HALVES = 250_000
# Chains that are fewer are followed one by one, not in step.
FEW = 16


def _whole(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    held = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(held).combine_chunks() if held else None


def _flags(column: pa.ChunkedArray, value: str) -> np.ndarray:
    return pc.fill_null(pc.equal(column, value), False).to_numpy().astype(bool)


def _same(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Equal ids, nulls equal to each other."""
    same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
    return same.to_numpy(zero_copy_only=False).astype(bool)


def _epochs_from(rows: pa.Table, stop: np.ndarray, ahead: tuple, ttl_us: int, dedupe_us: int):
    """For each half, were it to start an epoch: the place of its partner (-1 for
    none) in ``when``, and the epoch's end. ``stop``: where its id ends. ``when``
    are the halves' times and those of the first raw and the first prediction
    ``ahead``, in later pieces of the last id."""
    t, raw, pred = rows["_t"].to_numpy(), _flags(rows["side"], RAW), _flags(rows["side"], PREDICTION)
    n = len(t)
    place = np.arange(n)
    first = lambda of: np.minimum.accumulate(np.where(of, place, n)[::-1])[::-1]
    found = np.where(raw, first(pred), first(raw))
    later = [n + k if half else -1 for k, half in enumerate(ahead)]
    found = np.where(found < stop, found, np.where(stop == n, np.where(raw, later[1], later[0]), -1))
    when = np.r_[t, [half[0] if half else 0 for half in ahead]].astype(np.int64)
    met = (found >= 0) & (when[found] - t < ttl_us)
    return np.where(met, found, -1), np.where(met, when[found] + dedupe_us, t + ttl_us), when


def _leaving(ahead: dict, lasts: dict, ttl_us: int, dedupe_us: int):
    """Rows of the pieces of a partition; for each time in a piece the number of
    epochs (``n``) of the chain that starts there and the end with which it leaves
    the piece (``exit``; ``on``: a later piece goes on from it). ``ask``: the end of
    the epoch that starts there, ``aim`` the piece that goes on from it (-1: the
    epoch ends in this piece, or nothing comes after)."""

    def run(batches):
        rows = _whole(batches)
        if rows is None:
            return
        pid, spans = rows[PID][0].as_py(), rows["_span"].to_numpy()
        for span in np.unique(spans):
            piece = rows.filter(pa.array(spans == span))
            n, t = piece.num_rows, piece["_t"].to_numpy()
            _, end, _ = _epochs_from(piece, np.full(n, n), ahead[pid, span], ttl_us, dedupe_us)
            to = np.maximum(np.searchsorted(t, end), np.arange(1, n + 1)).tolist()
            last, count = list(range(n)), [1] * n
            for i in range(n - 1, -1, -1):
                if to[i] < n:
                    last[i], count[i] = last[to[i]], count[to[i]] + 1
            pids, until = lasts[span]
            after = np.searchsorted(pids, pid, side="right")
            aims = after + np.searchsorted(until[after:], end)
            aims = np.where(aims < len(pids), pids[np.minimum(aims, len(pids) - 1)], -1)
            starts = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
            leaves = np.array(last)[starts]
            yield pa.RecordBatch.from_pydict({
                "_span": np.full(len(starts), span, np.int32), PID: np.full(len(starts), pid, np.int32), "_t": t[starts], "n": np.array(count)[starts],
                "exit": end[leaves], "on": aims[leaves] >= 0, "ask": end[starts], "aim": np.where(leaves == starts, aims[starts], -1).astype(np.int32)})

    return run


def _going_on(asks: pd.DataFrame, starts: pd.DataFrame) -> pd.DataFrame:
    """What becomes of the ends ``asks`` in the piece that goes on from them."""
    starts = starts.sort_values("_t")
    found = starts.iloc[np.searchsorted(starts["_t"].to_numpy(), asks["ask"].to_numpy())]
    return found[["_span", PID, "n", "exit", "on"]].assign(ask=asks["ask"].to_numpy())


def _bounds(ids: pa.Array) -> np.ndarray:
    """Where each id begins, and the number of rows."""
    n = len(ids)
    return np.r_[0, np.flatnonzero(~_same(ids.slice(1), ids.slice(0, n - 1))) + 1, n]


def _chained(t: np.ndarray, end: np.ndarray, bounds: np.ndarray, reached: int | None, begun: int) -> np.ndarray:
    """The number of the epoch that each half starts, 0 if it starts none. The
    first id has ``begun`` epochs before and goes on from ``reached`` (begun 0: from its
    first half; None: not at all), the others from their first halves."""
    n, lengths = len(t), np.diff(bounds)
    times, rank = np.unique(t, return_inverse=True)
    key, stop = np.repeat(np.arange(len(lengths)) * (len(times) + 1), lengths), np.repeat(bounds[1:], lengths)
    to = np.maximum(np.searchsorted(key + rank, key + np.searchsorted(times, end)), np.arange(1, n + 1))
    number, now, epoch = np.zeros(n, np.int64), bounds[:-1], 0
    if begun:
        place, now = bounds[1] if reached is None else np.searchsorted(t[:bounds[1]], reached), now[1:]
        while place < bounds[1]:
            begun += 1
            number[place], place = begun, to[place]
    while len(now) > FEW:
        epoch += 1
        number[now] = epoch
        now = now[to[now] < stop[now]]
        now = to[now]
    for place in now:
        last, k = stop[place], epoch
        while place < last:
            k += 1
            number[place], place = k, to[place]
    return number


def _told(rows: pa.Table, bounds: np.ndarray, nearest: tuple, entry: tuple, ttl_us: int, dedupe_us: int) -> pa.RecordBatch:
    """The epochs of sorted halves. ``nearest``: the first raw and the first prediction in
    later pieces of the last id; ``entry``: ``reached`` and ``begun`` of the first id."""
    partner, end, when = _epochs_from(rows, np.repeat(bounds[1:], np.diff(bounds)), nearest, ttl_us, dedupe_us)
    number = _chained(rows["_t"].to_numpy(), end, bounds, *entry)
    starts = np.flatnonzero(number)
    offset = rows["offset"].combine_chunks()
    offset = pa.concat_arrays([offset, pa.array([half[1] if half else None for half in nearest], offset.type)])
    at, met = pa.array(starts, pa.int64()), partner[starts]
    other, column = pa.array(met, mask=met < 0), lambda name: rows[name].combine_chunks().take(at)
    return pa.RecordBatch.from_pydict({
        PID: column(PID), "id": column("id"), "epoch": pa.array(number[starts]), "side": column("side"), "_t": column("_t"),
        "_pt": pa.array(when).take(other), "_end": pa.array(end[starts]), "offset": offset.take(at), "_po": offset.take(other)})


def _counting(rows: pa.Table) -> pa.Table:
    """Of one id's sorted halves at one time the first of each side: the first of all
    is the one that may start an epoch, the first of its side the one that may join."""
    t, raw, pred = rows["_t"].to_numpy(), _flags(rows["side"], RAW), _flags(rows["side"], PREDICTION)
    first = np.zeros(len(t), bool)
    for side in (raw, pred, ~(raw | pred)):
        at = np.flatnonzero(side)
        first[at[np.r_[True, t[at[1:]] != t[at[:-1]]][:len(at)]]] = True
    return rows.filter(pa.array(first))


def _inside(ttl_us: int, dedupe_us: int):
    """The epochs of the ids inside a partition, and (``epoch`` null) the halves of its
    first and its last id."""

    def run(batches):
        rows = _whole(batches)
        if rows is None:
            return
        bounds, n = _bounds(rows["id"].combine_chunks()), rows.num_rows
        inner = bounds[1:-1] if len(bounds) > 3 else bounds[:0]
        outer = [rows.slice(lo, hi - lo) for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)] if not len(inner) else [rows.slice(0, inner[0]), rows.slice(inner[-1])]
        # Where an epoch may end as it starts, the next one can start at the same time with any half.
        held = pa.concat_tables([_counting(x) if ttl_us > 0 and dedupe_us > 0 else x for x in outer])
        none = lambda kind: pa.nulls(held.num_rows, kind)
        yield pa.Table.from_pydict({
            PID: held[PID], "id": held["id"], "epoch": none(pa.int64()), "side": held["side"], "_t": held["_t"],
            "_pt": none(pa.int64()), "_end": none(pa.int64()), "offset": held["offset"], "_po": none(held["offset"].type)}).combine_chunks().to_batches()[0]
        if len(inner):
            yield _told(rows.slice(inner[0], inner[-1] - inner[0]), inner - inner[0], (None, None), (None, 0), ttl_us, dedupe_us)

    return run


def _walk(into: dict, ahead: dict, ttl_us: int, dedupe_us: int):
    """The epochs of the halves held back in a partition. ``into``: (end that reaches it or
    none, epochs before) of a piece whose id began in an earlier partition."""

    def run(batches):
        rows = _whole(batches)
        if rows is None:
            return
        pid = rows[PID][0].as_py()
        yield _told(rows, _bounds(rows["id"].combine_chunks()), ahead.get(pid, (None, None)), into.get(pid, (None, 0)), ttl_us, dedupe_us)

    return run


def _together(ttl_us: int, dedupe_us: int):
    """The epochs of all halves held back, in one task."""

    def run(batches):
        rows = _whole(batches)
        if rows is None:
            return
        rows = rows.take(pa.array(np.argsort(rows[PID].to_numpy(), kind="stable")))
        yield _told(rows, _bounds(rows["id"].combine_chunks()), (None, None), (None, 0), ttl_us, dedupe_us)

    return run


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last id of a partition (one row if they are the same), from the
    halves held back: what it holds first of each side, and its last time."""
    rows = _whole(batches)
    if rows is None:
        return
    bounds = _bounds(rows["id"].combine_chunks()).tolist()
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        out = {PID: rows[PID].slice(lo, 1), "id": rows["id"].slice(lo, 1), "last": rows["_t"].slice(hi - 1, 1)}
        for name, side in (("raw", RAW), ("pred", PREDICTION)):
            at = np.flatnonzero(_flags(rows["side"].slice(lo, hi - lo), side))[:1] + lo
            place = pa.array(at if len(at) else [None], pa.int64())
            out |= {f"{name}_t": rows["_t"].take(place), f"{name}_offset": rows["offset"].take(place)}
        yield pa.Table.from_pydict(out).combine_chunks().to_batches()[0]


def _pieces(held: DataFrame) -> list[tuple[int, int, bool, Row]]:
    """(partition, number of the span, whether its id began in an earlier partition, row
    of ``_edges``) of each piece of an id that lies in several partitions."""
    kinds = {f.name: f.dataType for f in held.schema}
    shape = T.StructType([T.StructField(PID, T.IntegerType()), T.StructField("id", kinds["id"]), T.StructField("last", T.LongType()),
                          *[f for name in ("raw", "pred") for f in (T.StructField(f"{name}_t", T.LongType()), T.StructField(f"{name}_offset", kinds["offset"]))]])
    pieces, before, span = [], None, -1
    for r in held.mapInArrow(_edges, shape).collect():  # two rows per partition at most, in order
        if before is not None and before["id"] == r["id"]:
            if not (pieces and pieces[-1][3] is before):
                span += 1
                pieces.append((before[PID], span, False, before))
            pieces.append((r[PID], span, True, r))
        before = r
    return pieces


def _entries(held: DataFrame, listed: list, ttl_us: int, dedupe_us: int) -> tuple[dict, dict]:
    """``into`` and ``ahead`` of ``_walk``: by partition, what reaches the piece that it
    begins with, and what comes after the piece that it ends with."""
    if not listed:
        return {}, {}
    shape = T.StructType([T.StructField("_p", T.IntegerType()), T.StructField("_span", T.IntegerType()), T.StructField("_i", held.schema["id"].dataType)])
    named = F.broadcast(held.sparkSession.createDataFrame([(p, s, r["id"]) for p, s, _, r in listed], shape))
    pieces = held.join(named, (F.col(PID) == F.col("_p")) & F.col("id").eqNullSafe(F.col("_i"))).select(PID, "_span", "side", "_t", "offset")

    ahead, lasts, near = {}, defaultdict(list), {}
    for p, span, _, r in reversed(listed):
        ahead[p, span] = near.get(span, (None, None))
        near[span] = tuple(old if r[f"{name}_t"] is None else (r[f"{name}_t"], r[f"{name}_offset"]) for name, old in zip(("raw", "pred"), ahead[p, span], strict=True))
        lasts[span].insert(0, (p, r["last"]))
    lasts = {s: (np.array([p for p, _ in x]), np.array([t for _, t in x])) for s, x in lasts.items()}

    firsts = pieces.mapInArrow(_leaving(ahead, lasts, ttl_us, dedupe_us), f"_span int, {PID} int, _t long, n long, exit long, on boolean, ask long, aim int").checkpoint()
    asks = firsts.where("aim >= 0").select("_span", "ask", F.col("aim").alias(PID)).distinct()
    edges = asks.groupBy("_span", PID).cogroup(firsts.select("_span", PID, "_t", "n", "exit", "on").groupBy("_span", PID)) \
        .applyInPandas(_going_on, f"_span int, {PID} int, n long, exit long, on boolean, ask long").checkpoint()
    node = lambda end: F.struct("_span", F.col(end).alias("end"))
    begins = named.groupBy("_span").agg(F.min("_p").alias(PID))
    roots = firsts.join(F.broadcast(begins), ["_span", PID]).groupBy("_span").agg(F.min_by(F.struct("n", "exit", "on"), "_t").alias("_f")).select("_span", "_f.*").checkpoint()
    pointers = edges.select(node("ask").alias("_r"), F.when(F.col("on"), node("exit")).alias("_to"))
    reached = reachable(roots.where("on").select(node("exit").alias("_r")), pointers)
    entered = edges.withColumn("_r", node("ask")).join(reached, "_r", "left_semi").select("_span", PID, "ask", "n").collect()  # at most one row per piece

    counted, ends = {r["_span"]: r["n"] for r in roots.select("_span", "n").collect()}, {(r[PID], r["_span"]): r for r in entered}
    into = {}
    for p, span, goes_on, _ in listed:
        if goes_on:
            r = ends.get((p, span))
            into[p] = (r and r["ask"], counted[span])
            counted[span] += r["n"] if r else 0
    # Of two pieces in a partition the later span is the one that goes on from it.
    return into, {p: ahead[p, span] for p, span, _, _ in listed}


def reachable(roots: DataFrame, pointers: DataFrame) -> DataFrame:
    """The nodes ``_r`` that pointers (``_r`` -> ``_to``, at most one per node,
    without cycles) reach from ``roots`` (``_r``), roots included."""
    jump = pointers.where("_to IS NOT NULL").select("_r", "_to").checkpoint()
    reached = roots.select("_r").distinct().checkpoint()
    while not jump.isEmpty():
        reached = reached.unionByName(reached.join(jump, "_r").select(F.col("_to").alias("_r"))).distinct().checkpoint()
        jump = jump.join(jump.select(F.col("_r").alias("_to"), F.col("_to").alias("_then")), "_to").select("_r", F.col("_then").alias("_to")).checkpoint()
    return reached


def join_chains(halves: DataFrame, ttl_seconds: float, dedupe_seconds: float, order_cols: tuple[str, ...] = ("offset",),
                num_partitions: int | None = None) -> DataFrame:
    """``halves``: ``id, side`` (``raw`` or ``prediction``), ``at`` (time of
    arrival; without one a half is not seen), ``offset`` and ``order_cols``, the order
    of arrival at one time. One row per epoch: ``id, epoch`` (from 1), ``side``
    and ``started_at`` of the half that waited, ``outcome`` (``joined``,
    ``expired``), ``ended_at`` (time of the join or of the expiry),
    ``raw_offset``, ``prediction_offset``."""
    ttl_us, dedupe_us = (int(round(s * 1_000_000)) for s in (ttl_seconds, dedupe_seconds))
    ties = [c for c in order_cols if c != "offset"]
    seen = halves.select("id", "side", epoch_micros("at").alias("_t"), "offset", *ties).where(F.col("_t").isNotNull())
    tasks = num_partitions or max(default_partitions(seen), -(-seen.count() // HALVES))
    checkpoint_dir(halves.sparkSession)
    order = ["id", "_t", *order_cols, "side"]
    ranged = seen.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("id", "side", "_t", "offset", F.spark_partition_id().alias(PID))
    kinds = {f.name: f.dataType for f in ranged.schema}
    shape = T.StructType([T.StructField(n, k) for n, k in ((PID, T.IntegerType()), ("id", kinds["id"]), ("epoch", T.LongType()), ("side", kinds["side"]), ("_t", T.LongType()),
                                                           ("_pt", T.LongType()), ("_end", T.LongType()), ("offset", kinds["offset"]), ("_po", kinds["offset"]))])
    walked = ranged.mapInArrow(_inside(ttl_us, dedupe_us), shape).checkpoint()
    held = walked.where("epoch IS NULL").select("id", "side", "_t", "offset", PID).checkpoint()
    if held.count() <= HALVES:
        outer = held.coalesce(1).mapInArrow(_together(ttl_us, dedupe_us), shape)
    else:
        outer = held.mapInArrow(_walk(*_entries(held, _pieces(held), ttl_us, dedupe_us), ttl_us, dedupe_us), shape)
    rows = walked.where("epoch IS NOT NULL").unionByName(outer).coalesce(tasks)
    joined, is_raw = F.col("_pt").isNotNull(), F.col("side") == RAW
    return rows.select(
        "id", "epoch", "side", from_micros("_t").alias("started_at"),
        F.when(joined, "joined").otherwise("expired").alias("outcome"), from_micros(F.coalesce("_pt", "_end")).alias("ended_at"),
        F.when(is_raw, F.col("offset")).otherwise(F.col("_po")).alias("raw_offset"),
        F.when(is_raw, F.col("_po")).otherwise(F.col("offset")).alias("prediction_offset"))


def chain_outcomes(halves: DataFrame, epochs: DataFrame) -> DataFrame:
    """``outcome, n``: epochs joined and expired, and the halves that were
    duplicates (all that neither started an epoch nor joined one)."""
    seen = halves.agg(F.count("at").alias("n")).select("n")
    told = epochs.agg(F.count_if(F.col("outcome") == "joined").alias("joined"), F.count_if(F.col("outcome") == "expired").alias("expired"))
    told = told.withColumn("seen", seen.scalar())
    return told.select(F.inline(F.array(
        F.struct(F.lit("joined").alias("outcome"), F.col("joined").alias("n")), F.struct(F.lit("expired").alias("outcome"), F.col("expired").alias("n")),
        F.struct(F.lit("duplicates").alias("outcome"), (F.col("seen") - 2 * F.col("joined") - F.col("expired")).alias("n")))))
