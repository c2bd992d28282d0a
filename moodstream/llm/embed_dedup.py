"""Embedding near-duplicates by a subspace pigeonhole join.

Vectors are scaled to length 1 and rotated by a seeded orthogonal matrix (one
per dimension), which spreads every direction over all coordinates. Cosine >= c
means a squared distance of at most ``2 - 2c``. The rotated vector is cut into
blocks of about ``block`` coordinates; if every block's squared distance were
over its share of the budget (in proportion to its coordinates), the whole
would be over the budget. So a pair within the budget is within the share in at
least one block, and the union of the blocks' range joins holds every pair.

Range join of one block: the first ``grid`` coordinates give a cell of width
twice the radius. Each vector is in its own cell and looks into the cells that
its range touches, only upward in cell order, so that a pair meets once per
block. The join is an equality on (label, dimension, block, cell) with the
block's squared distance as its condition (the coordinates that made no cell
first), compiled by Spark and streamed; a hot cell is split by adaptive
execution. Candidates of all blocks are
united, and each is verified once: cosine of the original vectors in
double precision.

Equal vectors of one label (same components) are one class with a count from
the start, so copies, however many, never meet. Classes are linked with a count:
``n_links`` of a vector is the size of the linked classes plus its own copies.

Defined cases: a null label, a null or zero vector, or one with a null or
non-finite component links with nothing (its own component, no links); vectors
of different dimension never link; repeated rows are separate vectors with
equal results; a null id is carried and is a component id only if the
component has no other; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodstream.llm.common import prepare
from moodstream.llm.components import connected_components

SLACK = 1e-5  # over the rounding of single precision, in which blocks travel: the filter loses no pair that verification keeps


@lru_cache(maxsize=4)
def rotation(dim: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def block_edges(dim: int, block: int) -> list[tuple[int, int]]:
    parts = np.array_split(np.arange(dim), max(1, round(dim / block)))
    return [(int(p[0]), int(p[-1]) + 1) for p in parts]


def cell_ranges(x: np.ndarray, radius: float, width: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row, cell by coordinate) of all cells that the rows' ranges touch."""
    low, high = np.floor((x - radius) / width).astype(np.int64), np.floor((x + radius) / width).astype(np.int64)
    rows, cells = np.arange(len(x)), np.empty((len(x), 0), np.int64)
    for k in range(x.shape[1]):
        wide = int((high[:, k] - low[:, k]).max(initial=0)) + 1
        options = low[rows, k][:, None] + np.arange(wide)
        r, c = np.nonzero(options <= high[rows, k][:, None])
        cells = np.concatenate([cells[r], options[r, c][:, None]], axis=1)
        rows = rows[r]
    return rows, cells


def _pack(cells: np.ndarray) -> np.ndarray:
    """One number per cell that keeps their order."""
    bits, out = 60 // cells.shape[1], np.zeros(len(cells), np.int64)
    for k in range(cells.shape[1]):
        out = (out << bits) + (cells[:, k] + (1 << bits - 1))
    return out


def block_width(block: int) -> int:
    """The most coordinates a block can have."""
    return max(hi - lo for dim in range(1, 4 * block) for lo, hi in block_edges(dim, block))


def _blocks(look: bool, budget: float, block: int, grid: int, seed: int):
    """Classes (cls, vec) -> their blocks in the cells where they are at home,
    or in those they look into."""
    places = block_width(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            label, ids = b.column("label"), b.column("cls").to_numpy(zero_copy_only=False)
            begins, values = b.column("vec").offsets.to_numpy(), b.column("vec").flatten().to_numpy(zero_copy_only=False)
            begins, dims = begins[:-1] - begins[0], np.diff(begins)
            for dim in np.unique(dims):
                some = np.flatnonzero(dims == dim)
                x = values[begins[some][:, None] + np.arange(dim)].astype(float)
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ rotation(int(dim), seed)
                for blk, (lo, hi) in enumerate(block_edges(int(dim), block)):
                    part, share = x[:, lo:hi].astype(np.float32), budget * (hi - lo) / dim + SLACK
                    radius, axes = float(np.sqrt(share)), min(grid, hi - lo)
                    width = 2 * radius
                    home = _pack(np.floor(part[:, :axes].astype(float) / width).astype(np.int64))
                    rows, cell = np.arange(len(some)), home
                    if look:
                        rows, cells = cell_ranges(part[:, :axes].astype(float), radius, width)
                        cell = _pack(cells)
                        up = cell >= home[rows]
                        rows, cell = rows[up], cell[up]
                    n, flat = len(rows), np.zeros((len(rows), places), np.float32)
                    flat[:, : hi - lo] = part[rows]
                    columns = {"label": label.take(pa.array(some[rows])), "dim": pa.array(np.full(n, dim, np.int32)), "blk": pa.array(np.full(n, blk, np.int32)),
                               "cell": pa.array(cell), "cls": pa.array(ids[some[rows]]), "above": pa.array(cell > home[rows]), "share": pa.array(np.full(n, share))}
                    columns |= {f"x{k}": pa.array(np.ascontiguousarray(flat[:, k])) for k in range(places)}
                    yield pa.RecordBatch.from_pydict(columns)

    return run


def _verify(limit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            left, right = b.column("va"), b.column("vb")
            starts = left.offsets.to_numpy()
            u, v = (np.asarray(c.flatten().to_numpy(zero_copy_only=False), float) for c in (left, right))
            starts, sizes = starts[:-1] - starts[0], np.diff(starts)
            # A power of two takes out the scale without rounding, so that squares stay in range.
            u, v = (p * np.repeat(np.ldexp(1.0, -np.frexp(np.maximum.reduceat(np.abs(p), starts))[1]), sizes) for p in (u, v))
            dot, uu, vv = (np.add.reduceat(p, starts) for p in (u * v, u * u, v * v))
            yield b.select(["a", "b"]).filter(pa.array(dot / (np.sqrt(uu) * np.sqrt(vv)) >= limit))

    return run


def near_duplicates(vectors: DataFrame, limit: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", block: int = 8, grid: int = 4, seed: int = 4) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept."""
    prepare(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vec"))
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    usable = F.col("label").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda v: v != 0)
    good = rows.where(F.coalesce(usable, F.lit(False)))
    alone = rows.where(~F.coalesce(usable, F.lit(False)))

    # Classes of equal vectors; the checkpoint fixes their numbers.
    classes = good.groupBy("label", "vec").agg(F.count("*").alias("n"), F.min("_id").alias("first"))
    classes = classes.withColumn("cls", F.monotonically_increasing_id()).checkpoint()

    kind, places = dict(classes.dtypes)["label"], block_width(block)
    schema = f"label {kind}, dim int, blk int, cell long, cls long, above boolean, share double, " + ", ".join(f"x{k} float" for k in range(places))
    content = classes.select("label", "vec", "cls")
    made = {look: content.mapInArrow(_blocks(look, 2 - 2 * limit, block, grid, seed), schema) for look in (False, True)}
    key = ["label", "dim", "blk", "cell"]
    home = made[False].select(*key, F.col("cls").alias("a"), *[F.col(f"x{k}").alias(f"a{k}") for k in range(places)])
    look = made[True].select(*key, "above", "share", F.col("cls").alias("b"), *[F.col(f"x{k}").alias(f"b{k}") for k in range(places)])
    apart = [(F.col(f"a{k}") - F.col(f"b{k}")) * (F.col(f"a{k}") - F.col(f"b{k}")) for k in range(places)]
    free, whole = sum(apart[grid:], F.lit(0.0)), sum(apart, F.lit(0.0))
    # A pair of one cell meets from both sides: it counts when a < b.
    met = home.join(look, key).where((free <= F.col("share")) & (F.col("above") | (F.col("a") < F.col("b"))) & (whole <= F.col("share")))
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    content = classes.select("cls", "vec")
    both = (
        pairs.join(content.withColumnsRenamed({"cls": "a", "vec": "va"}), "a")
        .join(content.withColumnsRenamed({"cls": "b", "vec": "vb"}), "b")
        .select("a", "b", F.col("va").cast("array<double>").alias("va"), F.col("vb").cast("array<double>").alias("vb")))
    links = both.mapInArrow(_verify(limit), "a long, b long").checkpoint()

    sizes = classes.select("cls", "n")
    sided = links.select(F.col("a").alias("cls"), F.col("b").alias("to")).unionByName(links.select(F.col("b").alias("cls"), F.col("a").alias("to")))
    linked = sided.join(sizes.withColumnsRenamed({"cls": "to"}), "to").groupBy("cls").agg(F.sum("n").alias("others"))
    roots = connected_components(links, "a", "b")
    told = (
        classes.join(linked, "cls", "left").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
        .select("label", "vec", "first", F.coalesce("root", "cls").alias("root"), (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")))
    smallest = told.groupBy("root").agg(F.min("first").alias("component_id"))
    told = told.join(smallest, "root").select("label", "vec", "n_links", "component_id")
    out = good.join(told, ["label", "vec"]).select("_id", "n_links", "component_id").unionByName(
        alone.select("_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id")))
    return out.select(F.col("_id").alias(id_col), "n_links", "component_id", F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))
