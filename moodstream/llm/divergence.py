"""Source divergence: how far the sources of a language differ in their words.

Terms are runs of letters (ASCII letters, lower-cased, and every character
outside ASCII). A language keeps the terms that occur in at least
``least_docs`` of its documents, V of them. A (language, source) group with N
occurrences of kept terms gives a term with ``count`` occurrences the share
``p = 1 + floor(unit * (count + prior) / (N + prior * V))``; the distance of two
sources is the sum of ``|p - q|`` over all kept terms.

Most terms are missing in most sources, where p is the source's ``zero`` (the
share of count 0). With ``z`` for zero, a pair of sources (g, h) has

    V * |z_g - z_h|
    + sum over terms of g of  |p_g - z_h| - |z_g - z_h|     (and the same for h)
    + sum over terms of both of |p_g - p_h| - |p_g - z_h| - |z_g - p_h| + |z_g - z_h|

The first two lines need only how often a group has each share. The third runs
over a frequent-pattern tree: each term is a row of its nonzero (source, share)
items in source order, equal rows are one row with a multiplicity, and rows
with a common beginning share its nodes. A node stands for all terms below it,
so the correction of its item and the item of an ancestor is made once, times
the node's multiplicity.

The tree is never held as a whole: rows are dealt by ranges and sorted, so
that nodes open and close like a stack in one pass, and memory is one path and
the sums per pair of sources (``MOST_SUMS`` of them, then they are sent on). A
node that a range border cuts is two nodes with smaller multiplicities, which
gives the same sum. Everything is whole numbers; order plays no part.

The texts are read once: each task counts the terms of what it reads (memory
bounded by the bytes read since it last sent its counts on), and the counts
meet in one aggregate, so a source or a term that most rows have is one row
per task.

Defined cases: null text, language and source are ''; every group that occurs
is reported, without terms too (all values 0 if its language keeps no term);
a language with one source has no pairs; repeated rows are separate
documents; an empty table gives an empty result; extra columns are ignored. The
result has a row per pair of sources of a language, and a term's row holds
one item per source that has it: sources are meant to be a list, not a key of
documents.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodstream.llm.common import prepare

# Bytes of text that a task counts before it sends its counts on; sums of pairs that it holds.
STRETCH, MOST_SUMS = 32 << 20, 2_000_000
# Bytes of terms: ASCII letters in lower case and all bytes of other characters; the rest separates.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        times, docs, held = defaultdict(Counter), defaultdict(Counter), 0
        lang, source, texts = (b.column(c).to_pylist() for c in ("lang", "source", "text"))
        for k, text in enumerate(texts):
            terms = text.translate(TERM_BYTES).split()
            times[lang[k], source[k]].update(terms)
            docs[lang[k], source[k]].update(set(terms))
            held += len(text)
            if held >= STRETCH or k + 1 == len(texts):
                for (one, two), counts in times.items():
                    n, has = len(counts), docs[one, two]
                    yield pa.RecordBatch.from_pydict({
                        "lang": pa.array([one] * n, pa.string()), "source": pa.array([two] * n, pa.string()), "term": pa.array(list(counts), pa.binary()),
                        "n": pa.array(list(counts.values()), pa.int64()), "docs": pa.array([has[t] for t in counts], pa.int64())})
                times, docs, held = defaultdict(Counter), defaultdict(Counter), 0


class Tree:
    """The open path of a frequent-pattern tree, and the corrections so far."""

    def __init__(self):
        self.path: list[tuple[str, int, int]] = []
        self.times: list[int] = []
        self.share, self.zero = np.empty(0, np.int64), np.empty(0, np.int64)
        self.sums: dict[tuple[str, str], int] = defaultdict(int)

    def add(self, row: list[tuple[str, int, int]], times: int) -> None:
        """Inserts a row; rows come in order."""
        common = 0
        while common < min(len(row), len(self.path)) and row[common] == self.path[common]:
            common += 1
        self.close(common)
        self.path += row[common:]
        self.times += [0] * (len(row) - common)
        self.share, self.zero = (np.array([i[k] for i in self.path], np.int64) for k in (1, 2))
        if row:
            self.times[-1] += times

    def close(self, depth: int) -> None:
        """Closes the nodes below ``depth``, each with its multiplicity."""
        while len(self.path) > depth:
            source, p, z = self.path.pop()
            times, k = self.times.pop(), len(self.path)
            if k:
                self.times[-1] += times
                g, zero = self.share[:k], self.zero[:k]
                extra = times * (abs(g - p) - abs(g - z) - abs(zero - p) + abs(zero - z))
                for item, e in zip(self.path, extra.tolist(), strict=True):
                    self.sums[item[0], source] += e


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tree, open_lang = Tree(), None

    def told() -> pa.RecordBatch:
        tree.close(0)
        sums, tree.sums = tree.sums, defaultdict(int)
        return pa.RecordBatch.from_pydict({"lang": pa.array([open_lang] * len(sums), pa.string()), "source": pa.array([a for a, _ in sums], pa.string()),
                                           "item": pa.array([b for _, b in sums], pa.string()), "value": pa.array(list(sums.values()), pa.int64())})

    for b in batches:
        for lang, items, times in zip(*(b.column(c).to_pylist() for c in ("lang", "items", "times")), strict=True):
            if lang != open_lang or len(tree.sums) > MOST_SUMS:
                if open_lang is not None:
                    yield told()
                open_lang = lang
            tree.add([(i["source"], i["p"], i["zero"]) for i in items], times)
    if open_lang is not None:
        yield told()


def _share(count: str, total: str, unit: int, prior: int) -> Column:
    # Decimal, as unit * count may leave 64 bits.
    return F.expr(f"1 + (cast({count} + {prior} as decimal(28,0)) * {unit}) div nullif({total} + {prior} * terms, 0)")


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50, unit: int = 1_000_000_000, prior: int = 5,
          text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part (``pair``: item is another source, value the distance; ``term``:
    item is one of the ``top`` terms that the source has more of than its
    language, value by how much), rank."""
    prepare(docs.sparkSession)
    blank = F.lit("")
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), blank).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))],
                       F.coalesce(F.col(text_col), blank).cast("binary").alias("text"))
    counted = read.mapInArrow(_count_terms, "lang string, source string, term binary, n long, docs long")
    # A group without terms gives one row without a term.
    named = read.select("lang", "source").distinct().select("lang", "source", F.lit(None).cast("binary").alias("term"), F.lit(0).cast("long").alias("n"),
                                                            F.lit(0).cast("long").alias("docs"))
    counts = counted.unionByName(named).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = counts.groupBy("lang", F.col("term").cast("string").alias("term")).agg(
        F.collect_list(F.struct("source", "n")).alias("items"), F.sum("docs").alias("docs"), F.sum("n").alias("everywhere"))
    by_term = by_term.where(F.col("term").isNull() | (F.col("docs") >= least_docs)).drop("docs").checkpoint()

    item = F.explode("items").alias("i")
    sizes = by_term.select("lang", item).groupBy("lang", F.col("i.source").alias("source")).agg(F.sum("i.n").alias("total"))
    langs = by_term.groupBy("lang").agg(F.count("term").alias("terms"), F.sum("everywhere").alias("lang_total"))
    groups = sizes.join(langs, "lang").withColumn("zero", _share("0", "total", unit, prior)).checkpoint()

    kept = by_term.where("term IS NOT NULL").select("lang", "term", "everywhere", item).select("lang", "term", "everywhere", "i.source", "i.n")
    shares = kept.join(groups, ["lang", "source"]).select("lang", "source", "term", "zero", _share("n", "total", unit, prior).alias("p"),
                                                          _share("everywhere", "lang_total", unit, prior).alias("q")).checkpoint()

    rows = shares.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("source", "p", "zero"))).alias("items"))
    rows = rows.groupBy("lang", "items").agg(F.count("*").alias("times"))
    ordered = rows.repartitionByRange("lang", "items").sortWithinPartitions("lang", "items")
    both = ordered.mapInArrow(_corrections, "lang string, source string, item string, value long")

    other = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("other"))
    pairs = groups.join(other, "lang").where("source <> item").select("lang", "source", "item", F.expr("coalesce(terms * abs(zero - other), 0)").alias("value"))
    often = shares.groupBy("lang", "source", "zero", "p").agg(F.count("*").alias("times"))
    one = often.join(other, "lang").where("source <> item").groupBy("lang", "source", "item").agg(
        F.sum(F.expr("times * (abs(p - other) - abs(zero - other))")).alias("value"))
    sides = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    twice = one.unionByName(both).select("lang", "value", F.explode(sides).alias("s")).select("lang", "s.source", "s.item", "value")
    distance = pairs.unionByName(twice).groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("part", F.lit("pair"))
    more = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("p - q").alias("value"), F.lit("term").alias("part"))

    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    # The limit also holds before the shuffle: a task sends at most ``top`` rows of a group.
    first = more.withColumn("rank", place).where(F.col("rank") <= top)
    told = distance.withColumn("rank", place).unionByName(first)
    return told.select("lang", "source", "part", "item", "value", "rank")
