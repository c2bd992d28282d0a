"""Mixing sources to target weights by hierarchical budgeting.

The tree is domain -> language -> source; a leaf is one (domain, language,
source). The total budget of tokens goes down the tree level by level. At
each node it is shared among the children in proportion to their weights,
but no child gets more than its subtree can give (the tokens of its leaves
whose weights are positive at every level, times the number of epochs); what a child cannot use is shared among its siblings in
the same proportion until they are full too. As a node's own budget was capped
by what its subtree holds, a shortage is made up by siblings first and reaches
the next ancestor's children only when the whole node is exhausted.

Sharing a budget B among children with weight w and capacity c has a closed
form: child k gets ``min(c, L * w)`` for one level L. Sorted by c / w, the
children that are full come first, and L follows from running sums: one
window per parent over the table of tree nodes, no iteration.

Within a leaf the documents stand in an order given by a seeded hash, another
one for each epoch, and the leaf takes the prefix whose running token count
starts below its budget (the last document may run over it; a leaf with no
budget takes none). The running count needs no window over a leaf: documents
fall into cells by the leading digits of the order hash, cells get their
offsets from per-cell sums, and a small window runs inside each cell. Only
narrow rows move; ``mix`` alone moves texts, once.

Tokens are counted as words ``[^\\x20\\x09-\\x0D]+`` unless a token column is
given. Defined cases: a text without words (null or empty) has no tokens and is
never selected; a null domain, language or source is the leaf "(none)"; a
weight that is not listed is 1, a weight of 0 or less takes nothing; rows with a
null id are ordered by a hash of their text; repeated rows are separate documents
of ``select``, and rows equal in id and text stay together in ``mix``;
an empty table gives an empty result; extra columns are ignored by ``select``
and carried by ``mix``.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodstream.llm.common import keep_rows, prepare, row_key

TREE = ["domain", "lang", "source"]
# Leaves up to which the budget table is broadcast.
SMALL_TREE = 100_000


def _weight(level: str, table: Mapping[str, float]) -> Column:
    out = F.lit(1.0)
    for name, w in table.items():
        out = F.when(F.col(level) == name, F.lit(max(float(w), 0.0))).otherwise(out)
    return out


def share(nodes: DataFrame, parents: list[str], key: str) -> DataFrame:
    """(parents, key, cap, weight, above) -> the same with ``budget``."""
    siblings = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = siblings.orderBy(F.asc_nulls_last("ratio"), key)
    filled = F.sum(F.when(F.col("weight") > 0, F.col("cap"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    open_weight = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    out = nodes.withColumn("ratio", F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")))
    out = out.withColumn("left", F.greatest(F.col("above") - F.coalesce(filled, F.lit(0.0)), F.lit(0.0)))
    out = out.withColumn("level", F.when(F.col("weight") > 0, F.col("left") / open_weight))
    # The first child that its level does not fill sets the level of all; later ones compute a lower one.
    out = out.withColumn("level", F.max(F.when(F.col("level") < F.col("ratio"), F.col("level"))).over(siblings))
    budget = F.when(F.col("weight") <= 0, 0.0).otherwise(F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))))
    return out.withColumn("budget", budget).drop("ratio", "left", "level")


def budgets(leaves: DataFrame, total: float, weights: Mapping[str, Mapping[str, float]], epochs: int) -> DataFrame:
    """Leaf table (tree, leaf_tokens) -> (tree, leaf_tokens, leaf_budget)."""
    above = None
    open_leaf = reduce(and_, [_weight(level, weights.get(level, {})) > 0 for level in TREE])
    counted = leaves.withColumn("_usable", F.when(open_leaf, F.col("leaf_tokens")).otherwise(F.lit(0)))
    for depth, level in enumerate(TREE):
        path, parents = TREE[: depth + 1], TREE[:depth]
        nodes = counted.groupBy(*path).agg((F.sum("_usable") * epochs).cast("double").alias("cap"))
        nodes = nodes.withColumn("weight", _weight(level, weights.get(level, {})))
        nodes = nodes.withColumn("above", F.lit(float(total))) if above is None else nodes.join(above, parents)
        shared = share(nodes, parents, level)
        above = shared.select(*path, F.col("budget").alias("above"))
    whole = F.floor(F.col("budget") + 1e-6).cast("long").alias("leaf_budget")
    return leaves.join(shared.select(*TREE, whole), TREE)


def select(docs: DataFrame, weights: Mapping[str, Mapping[str, float]], share_of_tokens: float, domain: Column,
           seed: int = 11, epochs: int = 1, tokens: Column | None = None, cell_digits: int = 3, id_col: str = "doc_id",
           text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The chosen documents, one row per epoch in which each is taken: id,
    tree, epoch, n_tokens, first_token (in the leaf's stream), leaf_budget."""
    chosen = _chosen(docs, weights, share_of_tokens, domain, [F.col(id_col).alias("_id")], seed, epochs, tokens, cell_digits,
                     id_col, text_col, lang_col, source_col)
    return chosen.select(F.col("_id").alias(id_col), *TREE, "epoch", "n_tokens", "first_token", "leaf_budget")


def _chosen(docs: DataFrame, weights: Mapping[str, Mapping[str, float]], share_of_tokens: float, domain: Column, carried: list[Column],
            seed: int = 11, epochs: int = 1, tokens: Column | None = None, cell_digits: int = 3, id_col: str = "doc_id",
            text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``select`` with the ``carried`` columns instead of the id."""
    prepare(docs.sparkSession)
    if tokens is None:
        tokens = F.regexp_count(F.col(text_col), F.lit("[^\\x20\\x09-\\x0D]+"))
    name = lambda c: F.coalesce(c.cast("string"), F.lit("(none)"))
    narrow = docs.select(
        *carried, name(domain).alias("domain"), name(F.col(lang_col)).alias("lang"),
        name(F.col(source_col)).alias("source"), tokens.cast("long").alias("n_tokens"),
        F.coalesce(F.col(id_col).cast("string"), F.md5(F.col(text_col))).alias("_key"),
    ).where("n_tokens > 0").checkpoint()

    leaves = narrow.groupBy(*TREE).agg(F.sum("n_tokens").alias("leaf_tokens")).checkpoint()
    total = (leaves.agg(F.sum("leaf_tokens")).first()[0] or 0) * share_of_tokens
    plan = budgets(leaves, total, weights, epochs)
    if leaves.count() <= SMALL_TREE:  # some 10 MB at most; a larger tree is joined by a shuffle that adaptive execution splits
        plan = F.broadcast(plan)

    last = F.ceil(F.col("leaf_budget") / F.col("leaf_tokens")) - 1
    stream = (
        narrow.join(plan, TREE)
        .where("leaf_budget > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .withColumn("_order", F.md5(F.concat_ws("/", F.lit(str(seed)), "epoch", "_key")))
        .withColumn("_cell", F.substring("_order", 1, cell_digits))
    )
    cell = [*TREE, "epoch", "_cell"]
    sums = stream.groupBy(*cell).agg(F.sum("n_tokens").alias("_c"))
    before = F.sum("_c").over(Window.partitionBy(*TREE).orderBy("epoch", "_cell")) - F.col("_c")
    offsets = sums.select(*cell, before.alias("_before"))
    running = F.sum("n_tokens").over(Window.partitionBy(*cell).orderBy("_order", "n_tokens").rowsBetween(Window.unboundedPreceding, 0))
    return (
        stream.withColumn("_run", running - F.col("n_tokens"))
        .join(offsets, cell)
        .withColumn("first_token", F.col("_before") + F.col("_run"))
        .where("first_token < leaf_budget")
    )


def mix(docs: DataFrame, weights: Mapping[str, Mapping[str, float]], share_of_tokens: float, domain: Column,
        id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The chosen documents with all their columns, in one epoch."""
    chosen = _chosen(docs, weights, share_of_tokens, domain, row_key(id_col, text_col), id_col=id_col, text_col=text_col, epochs=1, **options)
    return keep_rows(docs, chosen.select("_k1", "_k2"), id_col, text_col)
