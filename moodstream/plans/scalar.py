"""Attaching global aggregates to rows without a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Adds the columns of ``one_row`` (a global aggregate: exactly one row)
    to every row of ``df``.

    The row is read through one scalar subquery, which Spark runs once and
    uses as a constant inside the consuming stage, so there is no join, no
    broadcast and no nested loop, whatever the size of ``df``.
    """
    cols = one_row.columns
    row = one_row.select(F.struct(*cols).alias("_row")).scalar()
    return df.withColumn("_row", row).select(*df.columns, *[F.col("_row")[c].alias(c) for c in cols])
