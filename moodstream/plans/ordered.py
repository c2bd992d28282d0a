"""Globally ordered computations without a single-task window.

An unpartitioned ``Window.orderBy(...)`` pulls every row into one task. The
helpers here instead

1. range-partition the rows on a *unique* sort key (Spark samples the key,
   so a hot value is split across partitions by the unique tie-breaker),
2. compute running values inside each sorted partition, and
3. add per-partition offsets from a table with one row per partition
   (its size is the partition count, so broadcasting it is bounded).

The range-partitioned rows are written once with a reliable
``checkpoint()`` (to the shared folder named by ``spark.checkpoint.dir``)
together with their partition id. Both consumers — the per-partition
totals and the per-row scan — read that one materialisation: two separate
range exchanges could sample different bounds and disagree on partition
ids, and the checkpoint also cuts the lineage, so a lost executor costs
a re-read, not a re-sort.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodstream.plans.scalar import attach_row

PID = "_pid"


def range_partitioned(df: DataFrame, order_cols: Sequence[str], num_partitions: int | None = None,
                      sort: bool = False, keep: Sequence[str] = ("*",)) -> DataFrame:
    """``df`` range-partitioned on ``order_cols`` with a ``_pid`` column,
    materialised by a reliable checkpoint (see module docstring). Only the
    columns ``keep`` are written."""
    from moodstream.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    p = num_partitions or default_partitions(df)
    ranged = df.repartitionByRange(p, *[F.col(c).asc() for c in order_cols])
    if sort:
        ranged = ranged.sortWithinPartitions(*[F.col(c).asc() for c in order_cols])
    return ranged.select(*keep, F.spark_partition_id().alias(PID)).checkpoint(eager=True)


def default_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _scan_partition(sum_cols: Sequence[str], fill_col: str | None):
    """Per-partition running sums (and forward fill) over rows that arrive
    in *descending* key order, so the sums are suffix sums and the fill
    carries the nearest non-null value at or after each row."""

    def run(batches):
        acc = {c: 0 for c in sum_cols}
        last = None
        for pdf in batches:
            if pdf.empty:
                for c in sum_cols:
                    pdf[f"_loc_{c}"] = pd.Series(dtype="int64")
                if fill_col:
                    pdf[f"_loc_next_{fill_col}"] = pd.Series(dtype="Int64")
                yield pdf
                continue
            for c in sum_cols:
                cs = np.cumsum(pdf[c].fillna(0).to_numpy(dtype=np.int64)) + acc[c]
                acc[c] = int(cs[-1])
                pdf[f"_loc_{c}"] = cs
            if fill_col:
                filled = pdf[fill_col].astype("Int64").ffill()
                if last is not None:
                    filled = filled.fillna(last)
                if filled.notna().iloc[-1]:
                    last = int(filled.iloc[-1])
                pdf[f"_loc_next_{fill_col}"] = filled
            yield pdf

    return run


def ordered_suffix_scan(df: DataFrame, order_cols: Sequence[str], sum_cols: Sequence[str],
                        fill_col: str | None = None,
                        num_partitions: int | None = None) -> DataFrame:
    """Adds, for every row, over the global ascending order of ``order_cols``
    (which must be unique per row):

    - ``suf_<c>``: sum of ``c`` over this row and all rows after it;
    - ``next_<fill_col>``: the ``fill_col`` value of the nearest row at or
      after this one where it is not null.

    ``df`` should be narrow (only the key, sum and fill columns): every row
    passes through one Arrow-batched Python pass.
    """
    ranged = range_partitioned(df, order_cols, num_partitions)

    aggs: list[Column] = [F.sum(F.coalesce(F.col(c), F.lit(0))).alias(f"_tot_{c}") for c in sum_cols]
    if fill_col:
        first = F.min(F.when(F.col(fill_col).isNotNull(),
                             F.struct(*[F.col(c) for c in order_cols], F.col(fill_col).alias("_v"))))
        aggs.append(first.getField("_v").alias("_first_fill"))
    totals = ranged.groupBy(PID).agg(*aggs)
    later = Window.orderBy(PID).rowsBetween(1, Window.unboundedFollowing)
    offsets = totals.select(
        PID,
        *[F.coalesce(F.sum(f"_tot_{c}").over(later), F.lit(0)).alias(f"_off_{c}") for c in sum_cols],
        *([F.first("_first_fill", ignorenulls=True).over(later).alias("_after_fill")] if fill_col else []),
    )

    out_fields = list(ranged.schema.fields) + [T.StructField(f"_loc_{c}", T.LongType()) for c in sum_cols]
    if fill_col:
        out_fields.append(T.StructField(f"_loc_next_{fill_col}", T.LongType()))
    local = ranged.sortWithinPartitions(*[F.col(c).desc() for c in order_cols]) \
        .mapInPandas(_scan_partition(list(sum_cols), fill_col), T.StructType(out_fields))

    joined = local.join(F.broadcast(offsets), PID)
    cols = [F.col(c) for c in df.columns]
    cols += [(F.col(f"_loc_{c}") + F.col(f"_off_{c}")).alias(f"suf_{c}") for c in sum_cols]
    if fill_col:
        cols.append(F.coalesce(F.col(f"_loc_next_{fill_col}"), F.col("_after_fill")).alias(f"next_{fill_col}"))
    return joined.select(*cols)


def global_rank(df: DataFrame, order_cols: Sequence[str], rank_col: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """1-based position of every row in the global order (ties in an
    arbitrary but fixed order). JVM only: the checkpointed partitions keep
    their index and sorted order, so ``monotonically_increasing_id`` over
    them gives the record number inside each partition (lower 33 bits)."""
    ranged = range_partitioned(df, order_cols, num_partitions, sort=True) \
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    counts = ranged.groupBy(PID).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(PID, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return ranged.join(F.broadcast(offsets), PID) \
        .select(*[F.col(c) for c in df.columns], (F.col("_off") + F.col("_pos") + 1).alias(rank_col))


def running_totals(df: DataFrame, order_cols: Sequence[str], sum_cols: Sequence[str] = (), max_cols: Sequence[str] = (),
                   num_partitions: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Adds, over the global ascending order of the (unique) ``order_cols``,
    ``pre_<c>``: the sum of ``c`` over this row and all before it, or the
    largest value for ``max_cols``. JVM only: a window inside each range
    partition plus the totals of the partitions before it.

    ``keys``: one order per key, which starts anew at each key's first row
    (``order_cols`` unique per key). Rows are ranged by (keys, order), so a key
    that holds most rows is cut into pieces like any other; a piece at the
    start of a partition takes over the totals of that key's pieces before
    it, from a table with two rows per partition."""
    keys, order_cols = list(keys), list(order_cols)
    ranged = range_partitioned(df, [*keys, *order_cols], num_partitions)
    made = {**{c: F.sum for c in sum_cols}, **{c: F.max for c in max_cols}}
    inside = Window.partitionBy(PID, *keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select("*", *[fn(c).over(inside).alias(f"_l_{c}") for c, fn in made.items()])
    if keys:
        offsets = _carried_in(ranged, keys, made)
        here = F.struct(*keys).eqNullSafe(F.col("_head"))
    else:
        totals = ranged.groupBy(PID).agg(*[fn(c).alias(f"_t_{c}") for c, fn in made.items()])
        before = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select(PID, *[fn(f"_t_{c}").over(before).alias(f"_b_{c}") for c, fn in made.items()])
        here = F.lit(True)
    joined = local.join(F.broadcast(offsets), PID)
    carry = {c: F.when(here, F.col(f"_b_{c}")) for c in made}
    out = [(F.coalesce(carry[c], F.lit(0)) + F.col(f"_l_{c}") if c in sum_cols
            else F.greatest(carry[c], F.col(f"_l_{c}"))).alias(f"pre_{c}") for c in made]
    return joined.select(*[F.col(c) for c in df.columns], *out)


def _carried_in(ranged: DataFrame, keys: list[str], made: dict) -> DataFrame:
    """Per partition its first key (``_head``) and, for each column, what the
    partitions before it hold of that key. Of the partitions before, a key can
    only be the last one."""
    pieces = ranged.groupBy(PID, F.struct(*keys).alias("_seg")).agg(*[fn(c).alias(f"_t_{c}") for c, fn in made.items()])
    ends = pieces.groupBy(PID).agg(F.min("_seg").alias("_head"), F.max("_seg").alias("_last"),
                                   F.max_by(F.struct(*[f"_t_{c}" for c in made]), "_seg").alias("_held"))
    asks = F.struct(F.col("_head").alias("_seg"), F.lit(0).alias("_turn"))
    gives = F.struct(F.col("_last").alias("_seg"), F.lit(1).alias("_turn"))
    turns = ends.select(PID, "_held", F.inline(F.array(asks, gives)))
    # Two rows per partition; one key's rows are at most all of them.
    before = Window.partitionBy("_seg").orderBy(PID, "_turn").rowsBetween(Window.unboundedPreceding, -1)
    given = {c: F.when(F.col("_turn") == 1, F.col(f"_held._t_{c}")) for c in made}
    carried = turns.select(PID, "_turn", F.col("_seg").alias("_head"), *[fn(given[c]).over(before).alias(f"_b_{c}") for c, fn in made.items()])
    return carried.where("_turn = 0").drop("_turn")


def _first_to_the_right(keys: Sequence[str]):
    """Rows of a partition in (keys, ``_t``, ``_k``, ``_a``) order; for each ask
    (``_k`` = 1) the time of the first row after it, of its key, with ``_k`` = 0
    and an ``_a`` not above its own. ``_more``: its key may go on in the next
    partition."""

    def run(batches):
        held = [b for b in batches if len(b)]
        if not held:
            return
        rows = pd.concat(held, ignore_index=True)
        apart = np.zeros(len(rows), bool)
        for k in keys:
            col = rows[k]
            apart |= (col.ne(col.shift()) & ~(col.isna() & col.shift().isna())).to_numpy(dtype=bool)
        seg = np.cumsum(apart)
        asks = np.flatnonzero(rows["_k"].to_numpy() == 1)
        found = pd.Series(pd.NA, index=rows.index, dtype="Int64")
        if len(asks):
            a, t, kind = rows["_a"].to_numpy(), rows["_t"].to_numpy(), rows["_k"].to_numpy()
            # From right to left: the rows that some ask further left may want, nearest last, with falling ``_a`` towards the first.
            stack_a: list[int] = []
            stack_t: list[int] = []
            for i in range(len(rows) - 1, asks[0] - 1, -1):
                if i + 1 < len(rows) and seg[i] != seg[i + 1]:
                    stack_a.clear(), stack_t.clear()
                if kind[i] == 0:
                    while stack_a and stack_a[-1] >= a[i]:
                        stack_a.pop(), stack_t.pop()
                    stack_a.append(int(a[i])), stack_t.append(int(t[i]))
                else:
                    n = bisect_right(stack_a, a[i])
                    if n:
                        found[i] = stack_t[n - 1]
        out = rows.loc[asks].copy()
        out["_found"] = found.loc[asks]
        out["_more"] = out["_found"].isna() & (seg[asks] == seg[-1])
        yield out

    return run


def _first_from_the_start(asks: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """The same for asks that come from partitions before: ``rows`` are those of the first key, by time."""
    rows = rows.sort_values("_t", kind="stable")
    least = np.minimum.accumulate(rows["_a"].to_numpy())
    at = np.searchsorted(-least, -asks["_a"].to_numpy())
    out = asks.copy()
    out["_found"] = rows["_t"].to_numpy()[np.minimum(at, max(len(rows) - 1, 0))]
    return out


def first_time_after(events: DataFrame, asks: DataFrame, keys: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """A successor in two dimensions. ``events``: keys, ``_t`` (time), ``_a``
    (place of arrival); ``asks``: keys, ``_t`` (a cut), ``_a``. For each ask the
    least time after its cut among the events of its key that had arrived by its
    place, as ``_found`` (null if there is none); (keys, ``_a``) names an ask.

    Events and asks are ranged by (keys, time) and each partition answers its
    own asks in one pass in n log n steps. What a partition cannot answer goes
    to the first later one of that key that holds an early enough arrival, which
    a table of each partition's earliest arrival tells. A key that holds most
    events is cut like any other."""
    keys = list(keys)
    kinds = {c: events.schema[c].dataType for c in keys}
    both = events.select(*keys, "_t", F.lit(0).alias("_k"), "_a").unionByName(asks.select(*keys, "_t", F.lit(1).alias("_k"), "_a"))
    ranged = range_partitioned(both, [*keys, "_t", "_k", "_a"], num_partitions, sort=True)
    shape = T.StructType([T.StructField(c, kinds[c]) for c in keys] + [T.StructField("_t", T.LongType()), T.StructField("_k", T.IntegerType()),
                         T.StructField("_a", T.LongType()), T.StructField(PID, T.IntegerType()), T.StructField("_found", T.LongType())])
    first = ranged.mapInPandas(_first_to_the_right(keys), T.StructType([*shape.fields, T.StructField("_more", T.BooleanType())])).checkpoint()
    open_ = first.where("_more").drop("_more", "_found")
    seg = F.struct(*keys) if keys else F.lit(0)
    pieces = ranged.groupBy(PID, seg.alias("_seg")).agg(F.min(F.when(F.col("_k") == 0, F.col("_a"))).alias("_least"))
    starts = pieces.groupBy(PID).agg(F.min_by(F.struct("_seg", "_least"), "_seg").alias("_s")).where("_s._least IS NOT NULL")
    listed = starts.groupBy(F.col("_s._seg").alias("_seg")).agg(F.array_sort(F.collect_list(F.struct(F.col(PID).alias("pid"), F.col("_s._least").alias("least")))).alias("_in"))
    aimed = open_.withColumn("_seg", seg).join(listed, "_seg")
    to = F.filter("_in", lambda p: (p["pid"] > F.col(PID)) & (p["least"] <= F.col("_a")))
    aimed = aimed.withColumn(PID, F.get(to, F.lit(0))["pid"]).where(F.col(PID).isNotNull()).drop("_in").checkpoint()
    rows = ranged.where("_k = 0").withColumn("_seg", seg).select(PID, "_seg", "_t", "_a")
    rows = rows.join(starts.select(PID, F.col("_s._seg").alias("_seg")), [PID, "_seg"], "left_semi").join(aimed.select(PID).distinct(), PID, "left_semi")
    later = aimed.drop("_seg").groupBy(PID).cogroup(rows.select(PID, "_t", "_a").groupBy(PID)).applyInPandas(_first_from_the_start, shape)
    told = first.select(*keys, "_a", "_found").where("_found IS NOT NULL").unionByName(later.select(*keys, "_a", "_found"))
    return told


def with_neighbour(df: DataFrame, order_cols: Sequence[str], cols: Sequence[str], step: int,
                   num_partitions: int | None = None) -> DataFrame:
    """Adds ``near_<c>`` from the row ``step`` places on (-1: the one before)
    in the global order; null at the ends. Ranks are distributed and the
    neighbour is found by an equi-join on the rank: no window over all rows."""
    ranked = global_rank(df, order_cols, "_rank", num_partitions)
    other = ranked.select((F.col("_rank") - step).alias("_rank"), *[F.col(c).alias(f"near_{c}") for c in cols])
    return ranked.join(other, "_rank", "left").select(*df.columns, *[f"near_{c}" for c in cols])


def exact_percentiles(df: DataFrame, value_col: str, quantiles: Sequence[float],
                      num_partitions: int | None = None) -> DataFrame:
    """Exact percentiles with linear interpolation between closest ranks
    (numpy's default), one row per quantile: ``q, value``; ``value`` is null
    when there are no non-null inputs."""
    named = {f"q{i}": (value_col, float(q)) for i, q in enumerate(quantiles)}
    row = percentiles_of_columns(df, named, num_partitions)
    return row.select(F.inline(F.array(*[F.struct(F.lit(q).alias("q"), F.col(n).alias("value")) for n, (_, q) in named.items()])))


def percentiles_row(df: DataFrame, value_col: str, named: dict[str, float],
                    num_partitions: int | None = None) -> DataFrame:
    """One row with a column per named quantile (see ``exact_percentiles``)."""
    return percentiles_of_columns(df, {n: (value_col, q) for n, q in named.items()}, num_partitions)


def percentiles_of_columns(df: DataFrame, named: dict[str, tuple[str, float]],
                           num_partitions: int | None = None) -> DataFrame:
    """One row of exact percentiles over several columns. ``named``: output
    name → (column, q).

    Equal values are one row with a count (summed on the map side) before
    anything is sorted, so a value that most rows share weighs no more than
    any other. The distinct (column, value) rows are range-sorted; running
    counts give each the ranks it covers, and the few rows that cover a wanted
    rank are kept by comparing against a literal list of ranks (two per
    quantile), read as one scalar subquery."""
    cols = sorted({c for c, _ in named.values()})
    stacked = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("_v"))
                                           for i, c in enumerate(cols)]))).where(F.col("_v").isNotNull())
    return _percentiles(stacked.groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_n")), cols, named, num_partitions)


def percentiles_of_counts(counts: DataFrame, value_col: str, count_col: str, named: dict[str, float],
                          num_partitions: int | None = None) -> DataFrame:
    """``percentiles_row`` over values that come with a count (each value once, counts above 0)."""
    held = counts.select(F.lit(0).alias("_c"), F.col(value_col).cast("double").alias("_v"), F.col(count_col).alias("_n")).where(F.col("_v").isNotNull())
    return _percentiles(held, [value_col], {n: (value_col, q) for n, q in named.items()}, num_partitions)


def _percentiles(distinct: DataFrame, cols: list[str], named: dict[str, tuple[str, float]], num_partitions: int | None) -> DataFrame:
    held = running_totals(distinct, ["_c", "_v"], ["_n"], num_partitions=num_partitions)

    sizes = distinct.groupBy().agg(*[F.coalesce(F.sum(F.when(F.col("_c") == i, F.col("_n"))), F.lit(0)).alias(f"_n{i}")
                                     for i in range(len(cols))])
    wanted = []
    for name, (c, q) in named.items():
        i = cols.index(c)
        offset = sum((F.col(f"_n{k}") for k in range(i)), F.lit(0))
        place = (F.col(f"_n{i}") - 1) * F.lit(float(q))
        wanted.append(F.struct(F.lit(name).alias("name"), (offset + F.floor(place) + 1).cast("long").alias("lo"),
                               (offset + F.ceil(place) + 1).cast("long").alias("hi"), (place - F.floor(place)).alias("part"),
                               (F.col(f"_n{i}") > 0).alias("any")))
    spec = attach_row(held, sizes.select(F.filter(F.array(*wanted), lambda w: w["any"]).alias("_wanted")))
    covers = lambda rank: (rank > F.col("pre__n") - F.col("_n")) & (rank <= F.col("pre__n"))
    hits = spec.select("_v", F.explode(F.transform(
        F.filter("_wanted", lambda w: covers(w["lo"]) | covers(w["hi"])),
        lambda w: F.struct(w["name"].alias("name"), w["part"].alias("part"), covers(w["lo"]).alias("lo"), covers(w["hi"]).alias("hi")))).alias("_w"))
    ends = hits.groupBy("_w.name").agg(F.max(F.when(F.col("_w.lo"), F.col("_v"))).alias("lo"), F.max(F.when(F.col("_w.hi"), F.col("_v"))).alias("hi"),
                                       F.max("_w.part").alias("part"))
    values = ends.select("name", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias("value"))
    return values.agg(*[F.max(F.when(F.col("name") == F.lit(n), F.col("value"))).alias(n) for n in named])
