"""Dataset preparation: label mapping, dedupe, sequential ids, stratified
split and subsample, class weights, replay schedule.

Per-class ordering never uses ``Window.partitionBy(label)`` — with three
labels that would put a third of the data in one task. Rows are ranked
globally on ``(label, hash, id)`` with the distributed ``global_rank`` and
the class offset (from a table with one row per class) is subtracted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodstream.functions.text import is_blank, py_strip
from moodstream.functions.time import utc_ts
from moodstream.plans.ordered import global_rank
from moodstream.schemas import LABELS, SOURCE_LABELS

OBJECTIVE = "objective"


def map_labels(df: DataFrame, objective: str = "neutral", text_col: str = "tweet",
               label_col: str = "label", order_col: str = "_row") -> DataFrame:
    """Source rows (text, label id 0..3) → ``text, label`` names.

    Text is stripped; "objective" is folded into neutral (``objective =
    "neutral"``) or dropped (``"drop"``); blank texts are dropped; duplicate
    texts keep the first row by ``order_col``; an unknown label id stops
    the job."""
    if objective not in ("neutral", "drop"):
        raise ValueError("objective must be 'neutral' or 'drop'")
    names = F.create_map(*[x for k, v in SOURCE_LABELS.items() for x in (F.lit(k), F.lit(v))])
    lab = F.element_at(names, F.col(label_col).cast("int"))
    lab = F.when(lab.isNull(), F.raise_error(F.concat(F.lit("unknown label id "),
                                                      F.col(label_col).cast("string")))).otherwise(lab)
    out = df.select(py_strip(F.col(text_col).cast("string")).alias("text"), lab.alias("label"),
                    F.col(order_col).alias(order_col))
    if objective == "drop":
        out = out.where(F.col("label") != F.lit(OBJECTIVE))
    else:
        out = out.withColumn("label", F.when(F.col("label") == F.lit(OBJECTIVE), F.lit("neutral"))
                             .otherwise(F.col("label")))
    out = out.where(F.col("text") != F.lit(""))
    return dedupe_by(out, "text", order_col)


def dedupe_by(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """First row per ``key`` by ``order_col``. Rows are grouped by a 256-bit
    hash of the key, so the text itself is neither sort nor shuffle key
    (min_by: partial aggregation)."""
    return df.groupBy(F.unhex(F.sha2(F.col(key).cast("string"), 256)).alias("_h")).agg(
        F.min_by(F.struct(*df.columns), F.col(order_col)).alias("_r")).select("_r.*").select(key, *[c for c in df.columns if c != key])


def union_datasets(*frames: DataFrame) -> DataFrame:
    """All rows of several data sets (columns by name, absent ones null),
    with ``_set``: the position of the frame a row came from."""
    out = None
    for i, f in enumerate(frames):
        f = f.withColumn("_set", F.lit(i))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def _ranked(df: DataFrame, order_col: str) -> DataFrame:
    """``df`` with its 1-based rank ``_rk`` by the unique ``order_col``. Only
    that column is sorted and checkpointed; the rank joins back on it."""
    ranks = global_rank(df.select(order_col), [order_col], "_rk")
    return df.join(ranks, order_col).select(*df.columns, "_rk")


def with_ids(df: DataFrame, order_col: str, prefix: str = "astd-") -> DataFrame:
    """Sequential ids ``{prefix}{i}`` (i from 0) in ``order_col`` order,
    from a distributed global rank of that (unique) column."""
    return _ranked(df, order_col).select(
        F.concat(F.lit(prefix), (F.col("_rk") - 1).cast("string")).alias("id"), *df.columns)


def _hash_order(id_col: str, seed: int):
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(str(seed))))


def _class_ranks(df: DataFrame, label_col: str, id_col: str, seed: int) -> DataFrame:
    """Per-class 1-based rank by md5(id ‖ seed), computed globally.

    Only the narrow ``(label, hash, id)`` projection is ranked and
    checkpointed; the rank joins back to the rows on the (unique) id, so
    wide columns such as the text are never written to the checkpoint and
    are pruned entirely when the consumer does not need them."""
    keys = df.select(label_col, id_col).withColumn("_h", _hash_order(id_col, seed))
    r = global_rank(keys, [label_col, "_h", id_col], "_g")
    counts = keys.groupBy(label_col).agg(F.count(F.lit(1)).alias("_nc"))
    offs = counts.select(label_col, "_nc", F.coalesce(F.sum("_nc").over(
        Window.orderBy(label_col).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    ranks = r.join(offs, label_col) \
        .select(id_col, (F.col("_g") - F.col("_off")).alias("_r"), "_nc", "_off")
    return df.join(ranks, id_col).select(*df.columns, "_r", "_nc", "_off")


def _largest_remainder(counts: DataFrame, label_col: str, n_col: str, draws, out: str) -> DataFrame:
    """Split ``draws`` over classes in proportion to ``n_col``: floors plus
    one extra for the largest remainders (ties by label). Small table."""
    tot = F.sum(n_col).over(Window.partitionBy(F.lit(1)))
    c = counts.withColumn("_cont", F.col(n_col) * draws / tot) \
        .withColumn("_fl", F.floor("_cont").cast("long")) \
        .withColumn("_rem", F.col("_cont") - F.col("_fl"))
    need = draws - F.sum("_fl").over(Window.partitionBy(F.lit(1)))
    order = Window.partitionBy(F.lit(1)).orderBy(F.col("_rem").desc(), F.col(label_col))
    return c.withColumn(out, F.col("_fl") + F.when(F.row_number().over(order) <= need, 1).otherwise(0)) \
        .drop("_cont", "_fl", "_rem")


def stratified_split(df: DataFrame, label_col: str = "label", id_col: str = "id", seed: int = 42,
                     holdout: float = 0.3, test_of_holdout: float = 2 / 3) -> DataFrame:
    """Disjoint stratified train/val/test (70/10/20 by default) in two
    stages like the reference: hold out ``ceil(holdout·n)`` rows, then
    ``ceil(test_of_holdout·held)`` of those are test. Adds ``split``."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_n"))
    n = F.sum("_n").over(Window.partitionBy(F.lit(1)))
    c = counts.withColumn("_ntrain", n - F.ceil(F.lit(holdout) * n))
    c = _largest_remainder(c, label_col, "_n", F.col("_ntrain"), "_train")
    c = c.withColumn("_rest", F.col("_n") - F.col("_train"))
    held = F.sum("_rest").over(Window.partitionBy(F.lit(1)))
    c = c.withColumn("_nval", held - F.ceil(F.lit(test_of_holdout) * held))
    c = _largest_remainder(c, label_col, "_rest", F.col("_nval"), "_val")
    quotas = c.select(label_col, "_train", "_val")
    r = _class_ranks(df, label_col, id_col, seed).join(quotas, label_col)
    split = F.when(F.col("_r") <= F.col("_train"), "train") \
        .when(F.col("_r") <= F.col("_train") + F.col("_val"), "val").otherwise("test")
    return r.withColumn("split", split).drop("_r", "_nc", "_off", "_train", "_val")


def stratified_sample(df: DataFrame, fraction: float, label_col: str = "label", id_col: str = "id",
                      seed: int = 42) -> DataFrame:
    """Exactly ``round(fraction·n_class)`` rows of every class (half to even),
    chosen by md5(id ‖ seed)."""
    r = _class_ranks(df, label_col, id_col, seed)
    return r.where(F.col("_r") <= F.bround(F.lit(float(fraction)) * F.col("_nc"), 0)) \
        .drop("_r", "_nc", "_off")


def class_weights(df: DataFrame, label_col: str = "label", labels: Sequence[str] = LABELS) -> DataFrame:
    """Inverse-frequency weights ``n / (k · max(count, 1))`` for every label
    of the domain (absent labels count as 1)."""
    counts = df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("_c"))
    dom = df.sparkSession.createDataFrame([(x,) for x in labels], "label string")
    full = F.broadcast(dom).join(counts, "label", "left")
    n = F.sum(F.coalesce("_c", F.lit(0))).over(Window.partitionBy(F.lit(1)))
    return full.select("label", (n / (F.lit(len(labels)) * F.greatest(F.coalesce("_c", F.lit(0)), F.lit(1))))
                       .alias("weight"))


def negative_slice(df: DataFrame, label_col: str = "label") -> DataFrame:
    return df.where(F.col(label_col) == F.lit("negative"))


def replay_schedule(df: DataFrame, order_col: str, rate_per_sec: float, start,
                    max_messages: int = 0) -> DataFrame:
    """Due time of item *i* (0-based, in ``order_col`` order) at
    ``start + i / rate``; a rate ≤ 0 means no pacing (all due at start).
    ``max_messages > 0`` keeps only the first that many items (0 = all);
    it filters on the distributed rank, so no single-task limit."""
    r = _ranked(df, order_col)
    if max_messages > 0:
        r = r.where(F.col("_rk") <= F.lit(int(max_messages)))
    t0 = F.unix_micros(utc_ts(start if not isinstance(start, str) else F.lit(start)))
    step = (F.col("_rk") - 1) * F.lit(1e6 / rate_per_sec) if rate_per_sec > 0 else F.lit(0)
    return r.select(*df.columns, F.timestamp_micros(t0 + F.round(step).cast("long")).alias("due_at"))


def drop_blank(df: DataFrame, text_col: str = "text") -> DataFrame:
    return df.where(F.col(text_col).isNotNull() & ~is_blank(text_col))
