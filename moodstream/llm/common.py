"""Shared pieces: reading tables, folds, hash samples, Python workers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.session import checkpoint_dir, ship_package

# The white space of every contract here: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE_CHARS = " \t\n\x0b\x0c\r"
TWO_64 = 1 << 64


def prepare(spark: SparkSession) -> SparkSession:
    """Shared folder for checkpoints and the package on Python workers."""
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def strip_space(col: Column) -> Column:
    """Deletes every character of ``[\\x20\\x09-\\x0D]``."""
    for ch in SPACE_CHARS:
        col = F.replace(col, F.lit(ch), F.lit(""))
    return col


def fold(modulus: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (null id: null)."""
    return F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % modulus


def unit_hash(*cols: str, seed: int = 0) -> Column:
    """A repeatable number in [0, 1) from the columns and the seed."""
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[F.col(c) for c in cols]), 11)
    return h.cast("double") / F.lit(float(1 << 53))


def hash_sample(df: DataFrame, bound: int, total: int, *cols: str, seed: int = 0) -> DataFrame:
    """Rows whose hash falls below ``bound / total``: about ``bound`` rows of
    ``total``, the same rows on every run, without a sort or a shuffle."""
    if total <= bound:
        return df
    return df.where(unit_hash(*cols, seed=seed) < F.lit(bound / total))


def one_per_id(rows: DataFrame, *cols: str) -> DataFrame:
    """One row per ``_id`` with the largest of (``cols``); the map side already
    reduces an id that many rows carry."""
    return rows.groupBy("_id").agg(F.max(F.struct(*cols)).alias("_best")).select("_id", "_best.*")


def row_key(id_col: str, text_col: str) -> list[Column]:
    """128 bits of the id and the text, as two longs: names a row whose id is
    null or stands on other texts too."""
    # A null adds nothing to the hash, so that it is told apart by a flag.
    parts = [F.col(id_col), F.col(id_col).isNull(), F.col(text_col), F.col(text_col).isNull()]
    return [F.xxhash64(F.lit(k), *parts).alias(f"_k{k}") for k in (1, 2)]


def keep_rows(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows whose key is among ``keys``, with all columns."""
    row: Column = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("_row"), *row_key(id_col, text_col)).join(keys, ["_k1", "_k2"], "left_semi").select("_row.*")


def level(sizes: list[int], bound: int) -> int:
    """The most that one may give of its size so that all together give at
    most ``bound``; 1 if even that is more."""
    held, lo, hi = np.array(sizes, np.int64), 1, max([1, *sizes])
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if np.minimum(held, mid).sum() <= bound else (lo, mid - 1)
    return lo


def spaced(n: int, most: int) -> list[int]:
    """0 to n - 1, or ``most`` of them, evenly spaced."""
    return list(range(n)) if n <= most else [k * n // most for k in range(most)]


def require_model(rows: list, what: str) -> list:
    if not rows:
        raise ValueError(f"{what}: no labelled rows to learn from")
    return rows
