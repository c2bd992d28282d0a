"""Distributed generation of a regular time grid (for gap filling)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shuffle_partitions(df: DataFrame) -> int:
    """Asked for by number: the few narrow rows that become many would
    otherwise be coalesced into one task for their small size."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def time_grid(bounds: DataFrame, lo_col: str, hi_col: str, step_us: int,
              out_col: str = "bucket_us", chunk: int = 65536) -> DataFrame:
    """Every ``lo + k*step`` up to ``hi`` (micros), from a one-row ``bounds``.

    The grid is built in two levels so no task has to generate it alone:
    the one-row frame explodes into chunk starts (``span / (step*chunk)``
    rows), those are spread over partitions, and each chunk explodes its own
    at most ``chunk`` buckets. Empty input (null bounds) gives an empty grid.
    """
    big = step_us * chunk
    starts = bounds.select(
        F.explode(F.sequence(F.col(lo_col), F.col(hi_col), F.lit(big).cast("long"))).alias("_c0"),
        F.col(hi_col).alias("_hi"),
    ).repartition(shuffle_partitions(bounds), "_c0")
    end = F.least(F.col("_c0") + F.lit(big - step_us), F.col("_hi"))
    return starts.select(F.explode(F.sequence(F.col("_c0"), end, F.lit(step_us).cast("long"))).alias(out_col))


def span_buckets(spans: DataFrame, lo_col: str, hi_col: str, step_us: int,
                 out_col: str = "bucket_us", chunk: int = 65536) -> DataFrame:
    """Every grid bucket ``k*step`` (micros, epoch-aligned) with
    ``lo ≤ bucket ≤ hi``, once per span row, other columns kept.

    Turns a range condition ``bucket BETWEEN lo AND hi`` into rows that
    join on the bucket by equality (no nested-loop range join). Two levels
    with a shuffle between, as in ``time_grid``: a task makes at most
    ``chunk`` buckets of a span.
    """
    first = F.col(lo_col) + F.pmod(-F.col(lo_col), F.lit(step_us))        # ceil to the grid
    last = F.col(hi_col) - F.pmod(F.col(hi_col), F.lit(step_us))          # floor to the grid
    big = step_us * chunk
    keep = [c for c in spans.columns]
    starts = spans.select(*keep, first.alias("_first"), last.alias("_last")) \
        .where(F.col("_first") <= F.col("_last")) \
        .select(*keep, "_first", "_last", F.explode(F.sequence(F.col("_first"), F.col("_last"),
                                                     F.lit(big).cast("long"))).alias("_c0")) \
        .repartition(shuffle_partitions(spans), "_c0", "_first", "_last")
    end = F.least(F.col("_c0") + F.lit(big - step_us), F.col("_last"))
    return starts.select(*keep, F.explode(F.sequence(F.col("_c0"), end, F.lit(step_us).cast("long")))
                         .alias(out_col))
