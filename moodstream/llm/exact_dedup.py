"""Exact duplicates: 128-bit content hash, then bytes compared in each group.

Texts are equal when identical after white space ``[\\x20\\x09-\\x0D]`` is
deleted (null counts as empty). The steps, all DataFrame functions:

1. one pass over the texts gives narrow rows (id, MD5 of the normalised
   text, its SHA-256, code points of the original), written once to the
   shared checkpoint folder;
2. a partial aggregate by MD5 finds the hashes that more than one row has;
3. rows of those hashes (a second pass over the texts, joined by the hash) are grouped by
   (hash, whole normalised text), so the grouping itself compares the bytes
   and two texts with one hash fall apart. The aggregate combines on the map
   side, so a text that a third of all rows share is one row per task;
4. each row finds its class by (MD5, SHA-256), a narrow join that adaptive
   execution splits for a hot key.

Defined cases: an empty table gives an empty result; a null id never beats
another id of the same length and stays only when no row of the group has
one; repeated rows (same id and text) count in ``group_size`` and are all
marked like the row that stays; ``survivors`` returns such a row once. Extra
columns are ignored by ``exact_dedup`` and carried by ``survivors``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodstream.llm.common import prepare, strip_space


# Parts over which the copies of one text are spread.
SPREAD = 16


def _text(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def _rank(length: Column, ident: Column) -> Column:
    """Sorts last for the row that stays: most code points, then smallest id."""
    return F.struct(length.alias("n"), ident.isNotNull().alias("has"), (-ident).alias("neg"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hashed: Callable[[Column], Column] = F.md5) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.
    ``hashed``: the 128-bit hash, in hex."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_id"), _text(text_col).alias("_text"))
    norm = rows.select("_id", F.length("_text").alias("_n"), strip_space(F.col("_text")).alias("_norm"))
    norm = norm.select("_id", "_n", "_norm", F.unhex(hashed(F.col("_norm"))).alias("_hash"))
    keys = norm.select("_id", "_n", "_hash", F.unhex(F.sha2("_norm", 256)).alias("_sha")).checkpoint()

    # Written out, so that the join below is between two plain shuffles, which adaptive execution can split for a hot hash.
    shared = keys.groupBy("_hash").agg(F.count("*").alias("_c")).where("_c > 1").select("_hash").checkpoint()
    # By the hash of the text itself: an id plays no part, so rows without one, or with one id, do not meet. The copies of
    # a text are spread over ``SPREAD`` parts (and may be split further): the aggregate below then has a shuffle of its
    # own, before which each task makes one row of a text's copies.
    part = F.pmod(F.xxhash64("_id", "_n"), F.lit(SPREAD)).cast("int")
    parts = shared.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    classes = (
        norm.withColumn("_part", part).join(parts, ["_hash", "_part"], "left_semi")
        .groupBy("_hash", "_norm")
        .agg(F.count("*").alias("_size"), F.max(_rank(F.col("_n"), F.col("_id"))).alias("_best"))
        .select("_hash", F.unhex(F.sha2("_norm", 256)).alias("_sha"), "_size", F.col("_best.has").alias("_has"),
                F.when(F.col("_best.has"), -F.col("_best.neg")).alias("_keep"))
    )
    out = keys.join(classes, ["_hash", "_sha"], "left")
    keep = F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_keep"))
    return out.select(
        F.col("_id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with every column of the input, one per class.

    One shuffle keyed by (hash, normalised bytes); the map side already
    reduces copies, so a hot text does not travel more than once per task.
    """
    norm = strip_space(_text(text_col))
    best = F.max_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), _rank(F.length(_text(text_col)), F.col(id_col)))
    grouped = docs.groupBy(F.md5(norm).alias("_hash"), norm.alias("_norm")).agg(best.alias("_best"))
    return grouped.select("_best.*")
