"""Hard negatives by threshold joins over an inverted index with norm bounds.

For each anchor: its first positives (rows of its label, highest integer inner
product first), and for each positive the first negatives (rows of other
labels) whose score lies in a window under the positive's score.

Rows are reduced first. Equal vectors of one label are one class that keeps its
smallest ids, as many as a list can hold, because equal vectors have equal
scores; so a vector that a third of all rows share weighs as much as any other.
Anchors with equal vector and label are searched for once.

The search (``fill``) runs in cells: a bounded block of anchors against a
bounded block of rows, both dealt by hash, in one grouped task. In a cell,
``above`` finds all pairs over a threshold per anchor:

1. dimensions are ordered by weight; a row is indexed for the leading ones
   only: the rest is left out as soon as the norm of the rest, times that of any
   anchor's, is below the anchor's threshold;
2. partial scores are summed over the index, some dimensions at a time, and
   rows that no anchor can reach any more (partial score plus the product of
   the norms that remain) are dropped;
3. pairs whose bound still reaches the threshold are finished exactly.

Thresholds begin near the upper end of a window and are lowered until the
window holds its rows or reaches its lower end, so most windows never look at
weak pairs. Each cell fills its windows for itself; the best of all cells per
window are the result. All scores are exact: sums of whole numbers below 2^52
in double precision, or 64-bit integers beyond that.

The anchors are a stated query set (a condition), compared with all rows in
blocks. Rows are copied once per block of anchors, anchors once per block of
rows; a task holds one block of each.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component take no part, nor does a row whose scaled vector has a norm of 2^30
or more (its scores would not fit a long); vectors of different dimension are
never compared; repeated rows (same id, label, vector) count once; an id on several
vectors is as many rows, none of which is a positive of an anchor of that id;
an anchor without positives, or a positive without rows in its window, gives
no rows; ties go to the smaller id; an empty table or no anchors give an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodstream.llm.common import prepare

SLACK = 1 + 1e-9  # over the rounding of the norms
CHUNK, TILE = 8, 1024
# How far down its window a threshold goes, round by round.
LEVELS = (0.25, 0.5, 1.0)


def above(a: np.ndarray, x: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, row of x, score) of all pairs with score >= theta[row of a]."""
    dims = a.shape[1]
    order = np.argsort(-np.square(x.astype(float)).sum(axis=0), kind="stable")
    a, x = a[:, order], x[:, order]
    edges = [*range(0, dims, CHUNK), dims]
    last = len(edges) - 1
    rest_a, rest_x = (np.stack([np.sqrt(np.square(v[:, e:].astype(float)).sum(axis=1)) * SLACK for e in edges], axis=1) for v in (a, x))
    with np.errstate(divide="ignore", invalid="ignore"):
        limit = np.where(theta[:, None] > 0, theta[:, None] / rest_a, -1.0).min(axis=0, initial=np.inf)
    covered = rest_x < limit  # from this edge on, no anchor can gain its threshold
    depth = np.where(covered.any(axis=1), covered.argmax(axis=1), last)
    rows = np.argsort(-depth, kind="stable")
    rows = rows[depth[rows] > 0] if last else rows  # with no edge inside there is nothing to leave out
    x, rest_x, depth = x[rows], rest_x[rows], depth[rows]
    score = np.zeros((len(a), len(rows)), a.dtype)
    for k in range(last):
        n = int((depth > k).sum())
        if not n:
            break
        score[:, :n] += a[:, edges[k] : edges[k + 1]] @ x[:n, edges[k] : edges[k + 1]].T
        if k % 2 and k + 1 < last:
            alive = np.ones(len(rows), bool)
            alive[:n] = (score[:, :n] + rest_a[:, k + 1 : k + 2] * rest_x[:n, k + 1] >= theta[:, None]).any(axis=0)
            if alive.mean() < 0.7:
                rows, x, rest_x, depth, score = rows[alive], x[alive], rest_x[alive], depth[alive], score[:, alive]
    found = [(np.empty(0, np.int64),) * 3]
    for k in np.unique(depth):
        lo, hi = np.searchsorted(-depth, [-k, -k + 1])
        part = score[:, lo:hi]
        at, to = np.nonzero(part + rest_a[:, k : k + 1] * rest_x[lo:hi, k] >= theta[:, None])
        exact = part[at, to] + np.einsum("ij,ij->i", a[at, edges[k] :], x[lo + to, edges[k] :])
        keep = exact >= theta[at]
        found.append((at[keep], rows[lo + to[keep]], exact[keep].astype(np.int64)))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def fill(a: np.ndarray, x: np.ndarray, ids: list[list[int]], windows: list[tuple[int, int, int]], k: int, apart=None) -> list[list[tuple[int, int]]]:
    """For each window (row of a, lowest, highest score): its first ``k``
    (score, id), from rows of x with the ids ``ids``. ``apart``: the labels
    of a and x, if only rows of other labels count."""
    out: list[list[tuple[int, int]]] = [[] for _ in windows]
    first = np.array([i[0] for i in ids], np.int64)
    todo = [w for w, (_, lo, hi) in enumerate(windows) if lo <= hi]
    for level in LEVELS:
        if not todo or not len(x):
            break
        theta = np.full(len(a), np.inf)
        for w in todo:
            r, lo, hi = windows[w]
            theta[r] = min(theta[r], lo if level == 1 else hi - np.floor((hi - lo) * level))
        some = np.flatnonzero(np.isfinite(theta))
        lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for at in range(0, len(some), TILE):
            part = some[at : at + TILE]
            r, c, s = above(a[part], x, theta[part] - np.abs(theta[part]) * 1e-12 - 1)
            r = part[r]
            if apart is not None:
                other = apart[0][r] != apart[1][c]
                r, c, s = r[other], c[other], s[other]
            order = np.lexsort((first[c], -s, r))
            r, c, s = r[order], c[order], s[order]
            ends = np.searchsorted(r, part, side="right")
            lists |= {int(q): (c[lo:hi], s[lo:hi]) for q, lo, hi in zip(part, np.searchsorted(r, part), ends, strict=True)}
        open_ = []
        for w in todo:
            r, lo, hi = windows[w]
            c, s = lists[r]
            known = lo if level == 1 else max(lo, int(theta[r]) + 1)  # all from here up have been found
            i, j = np.searchsorted(-s, -hi), np.searchsorted(-s, -known, side="right")
            # The first k rows are in the first k classes, whose smallest ids decide ties.
            best = sorted((-int(s[n]), name) for n in range(int(i), min(int(j), int(i) + k)) for name in ids[c[n]])[:k]
            if len(best) == k or level == 1:
                out[w] = [(-n, name) for n, name in best]
            else:
                open_.append(w)
        todo = open_
    return out


def _matrix(column: pa.ChunkedArray, dim: int, rows: np.ndarray, dtype) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    begins = flat.offsets.to_numpy()[:-1][rows]
    values = flat.values.to_numpy(zero_copy_only=False)
    return values[begins[:, None] + np.arange(dim)].astype(dtype) if dim else np.empty((len(rows), 0), dtype)


def _by_dimension(rows: pa.Table, anchors: pa.Table):
    """(dim, anchors' rows, their matrix, rows, their matrix, codes of both sides' labels)."""
    codes: dict = {}
    label = [np.array([codes.setdefault(v, len(codes)) for v in t.column("label").to_pylist()], np.int64) for t in (anchors, rows)]
    size = [pc.list_value_length(t.column("q")).to_numpy() for t in (anchors, rows)]
    for dim in np.unique(size[0]).tolist():
        at, to = (np.flatnonzero(s == dim) for s in size)
        if len(to):
            a, x = _matrix(anchors.column("q"), dim, at, np.int64), _matrix(rows.column("q"), dim, to, np.int64)
            norms = [float(np.sqrt(np.square(v.astype(float)).sum(axis=1)).max(initial=0)) for v in (a, x)]
            if norms[0] * norms[1] < 2.0**52:
                a, x = a.astype(float), x.astype(float)
            yield at, a, to, x, label[0][at], label[1][to]


def _positives(k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and anchors.num_rows:
            names, ids = anchors.column("acls").to_pylist(), rows.column("ids").to_pylist()
            for at, a, to, x, la, lx in _by_dimension(rows, anchors):
                for label in np.intersect1d(la, lx):
                    p, r = np.flatnonzero(la == label), np.flatnonzero(lx == label)
                    widest = np.sqrt(np.square(x[r].astype(float)).sum(axis=1)).max()
                    most = np.ceil(np.sqrt(np.square(a[p].astype(float)).sum(axis=1)) * widest * SLACK) + 1
                    best = fill(a[p], x[r], [ids[to[n]] for n in r], [(n, -int(m), int(m)) for n, m in enumerate(most)], k)
                    out += [(names[at[p[n]]], s, i) for n, found in enumerate(best) for s, i in found]
        return _table(out, ["acls", "score", "id"])

    return run


def _negatives(k: int, low: int, high: int, of: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and anchors.num_rows:
            names, ids, tops = anchors.column("acls").to_pylist(), rows.column("ids").to_pylist(), anchors.column("tops").to_pylist()
            for at, a, to, x, la, lx in _by_dimension(rows, anchors):
                asked = [(n, top) for n, r in enumerate(at) for top in tops[r]]
                windows = [(n, -(-low * top // of), high * top // of) for n, top in asked]
                best = fill(a, x, [ids[n] for n in to], windows, k, (la, lx))
                out += [(names[at[n]], top, s, i) for (n, top), found in zip(asked, best, strict=True) for s, i in found]
        return _table(out, ["acls", "top", "score", "id"])

    return run


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})


def mine(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, of: int = 100, scale: int = 256,
         row_block: int = 2048, anchor_block: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per anchor, positive and negative: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score, where ``low`` * positive_score
    <= ``of`` * negative_score <= ``high`` * positive_score."""
    prepare(vectors.sparkSession)
    vec, kept = F.col("vec"), max(positives + 1, negatives)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vec"), anchor.alias("asks"))
    finite = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < 2.0**40))
    square = F.aggregate(vec, F.lit(0.0), lambda s, v: s + F.pow(F.floor(v.cast("double") * scale).cast("double"), F.lit(2.0)))
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & vec.isNotNull() & finite & (square < 2.0**60)
    good = rows.where(F.coalesce(usable, F.lit(False)))
    good = good.select("id", "label", F.transform(vec, lambda v: F.floor(v.cast("double") * scale)).alias("q"), "asks")
    good = good.groupBy("id", "label", "q").agg(F.max("asks").alias("asks")).checkpoint()

    # The limit per window also holds before the shuffle, so that a class of many copies sends few rows.
    smallest = F.row_number().over(Window.partitionBy("label", "q").orderBy("id"))
    classes = good.select("label", "q", "id", smallest.alias("r")).where(F.col("r") <= kept)
    classes = classes.groupBy("label", "q").agg(F.array_sort(F.collect_list("id")).alias("ids")).checkpoint()
    anchors = good.where("asks")
    searched = anchors.select(F.col("label").alias("label"), F.col("q").alias("q")).distinct().withColumn("acls", F.monotonically_increasing_id()).checkpoint()

    row_blocks, anchor_blocks = (max(1, -(-t.count() // size)) for t, size in ((classes, row_block), (searched, anchor_block)))
    dealt = classes.select("label", "q", "ids", F.pmod(F.xxhash64("label", "q"), F.lit(row_blocks)).alias("rb"),
                           F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))).alias("ab"))

    def cells(asking: DataFrame, run, schema: str) -> DataFrame:
        asking = asking.withColumn("ab", F.pmod(F.xxhash64("acls"), F.lit(anchor_blocks)).cast("int"))
        asking = asking.withColumn("rb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(row_blocks - 1).cast("long"))))
        return dealt.groupBy("ab", "rb").cogroup(asking.groupBy("ab", "rb")).applyInArrow(run, schema)

    def first(found: DataFrame, k: int, *key: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("score"), "id"))
        listed = found.withColumn("r", place).where(F.col("r") <= k)
        return listed.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("neg"), "id"))).alias("list"))

    pool = first(cells(searched, _positives(positives + 1), "acls long, score long, id long"), positives + 1, "acls").checkpoint()
    asking = searched.join(pool, "acls").select("acls", "label", "q", F.array_distinct(F.transform("list", lambda p: -p["neg"])).alias("tops"))
    found = first(cells(asking, _negatives(negatives, low, high, of), "acls long, top long, score long, id long"), negatives, "acls", "top")
    windows = found.groupBy("acls").agg(F.map_from_entries(F.collect_list(F.struct("top", "list"))).alias("windows"))
    told = searched.join(pool, "acls").join(windows, "acls").select("label", "q", "list", "windows")

    out = anchors.select(F.col("id").alias("anchor_id"), "label", "q").join(told, ["label", "q"])
    others = F.slice(F.filter("list", lambda p: p["id"] != F.col("anchor_id")), 1, positives)
    out = out.select("anchor_id", "windows", F.explode(others).alias("p"))
    out = out.select("anchor_id", F.col("p.id").alias("positive_id"), (-F.col("p.neg")).alias("positive_score"),
                     F.posexplode(F.try_element_at("windows", -F.col("p.neg"))).alias("place", "n"))
    return out.select("anchor_id", "positive_id", (F.col("place") + 1).alias("rank"), F.col("n.id").alias("negative_id"), "positive_score",
                      (-F.col("n.neg")).alias("negative_score"))
