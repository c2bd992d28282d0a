"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``vnodes`` points on a ring of ``2**cell_bits`` cells; a row's
cell is a hash of its id, and the row goes clockwise to the first point whose
shard is not full. A shard's bound is ``floor(n/k)`` rows, one more for the
first ``n mod k`` shards: the bounds sum to n, so counts end at most one apart
(law ``rows``). Points do not depend on the number of shards: adding one moves
the rows that fall to its points and those that the lower bounds push on.

Order of arrival is fixed: first every arc's own rows (arcs clockwise, rows of
an arc by ring position), then what overflowed, one point further per round.
So the walk needs only the number of rows per arc. Those counts (``shards x
vnodes`` numbers, a size fixed by the parameters) are all the driver sees; it
answers with consecutive segments of each arc's rows and the shard of each.

A row's rank in its arc is its row number in its cell (many small windows that
the hash fills evenly) plus the cell's offset in the arc. Shard and slot
follow from the segment that holds the rank: no window over a shard, no key
of source or text, one shuffle of narrow rows. The broadcast table has at most
``2**cell_bits`` rows plus one per segment, whatever the input.

Defined cases: null text has size 1 (no bytes, plus one) and the CRC-32 of no
bytes; rows with a null id take their place by text CRC and size; repeated
rows are placed one by one; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import json
from hashlib import blake2b

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moodstream.llm.common import prepare


def ring(shards: int, vnodes: int, cells: int) -> list[tuple[int, int]]:
    """The points (cell, shard), clockwise; a taken cell passes a point on."""
    points: dict[int, int] = {}
    for shard in range(shards):
        for v in range(vnodes):
            at = int.from_bytes(blake2b(b"%d/%d" % (shard, v), digest_size=8).digest(), "big") % cells
            while at in points:
                at = (at + 1) % cells
            points[at] = shard
    return sorted(points.items())


def bounded_walk(counts: list[int], owners: list[int], bounds: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Segments (arc, first rank, end rank, shard, first slot) of each arc's
    rows; ``sum(bounds)`` must reach ``sum(counts)``."""
    room, slot = list(bounds), [0] * len(bounds)
    segments, waiting = [], {a: [(a, 0, c)] for a, c in enumerate(counts) if c}
    while waiting:
        onward: dict[int, list[tuple[int, int, int]]] = {}
        for at in sorted(waiting):
            shard = owners[at]
            for arc, lo, hi in waiting[at]:
                take = min(hi - lo, room[shard])
                if take:
                    segments.append((arc, lo, lo + take, shard, slot[shard]))
                    room[shard] -= take
                    slot[shard] += take
                if lo + take < hi:
                    onward.setdefault((at + 1) % len(owners), []).append((arc, lo + take, hi))
        waiting = onward
    return segments


def _literal_table(spark: SparkSession, rows: list, names: list[str]) -> DataFrame:
    """A small table of whole numbers made of one literal."""
    schema = "array<struct<" + ",".join(f"{n}:bigint" for n in names) + ">>"
    text = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), schema)))


def shard_by_ring(docs: DataFrame, shards: int = 8, vnodes: int = 128, cell_bits: int = 16,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = prepare(docs.sparkSession)
    cells = 1 << cell_bits
    if not 0 < shards * vnodes <= cells // 4:
        raise ValueError(f"{shards} x {vnodes} points need at least four cells each: raise cell_bits")
    points = ring(shards, vnodes, cells)
    owners = [s for _, s in points]

    data = F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.lit(b""))
    rows = docs.select(F.col(id_col).alias("_id"), (F.octet_length(data) + 1).cast("long").alias("size"),
                       F.crc32(data).alias("text_crc32"))
    at = F.when(F.col("_id").isNotNull(), F.xxhash64("_id")).otherwise(F.xxhash64("text_crc32", "size"))
    rows = rows.withColumn("_at", at).withColumn("_cell", F.shiftrightunsigned("_at", 64 - cell_bits))

    starts = [(points[a - 1][0] + 1) % cells for a in range(len(points))]
    arcs = [(a, starts[a], (points[a][0] - starts[a]) % cells) for a in range(len(points))]
    grid = (
        _literal_table(spark, arcs, ["arc", "start", "steps"])
        .select("arc", "start", F.explode(F.sequence(F.lit(0).cast("long"), "steps")).alias("step"))
        .select("arc", "step", ((F.col("start") + F.col("step")) % cells).alias("_cell"))
    )
    filled = rows.groupBy("_cell").agg(F.count("*").alias("c"))
    grid = grid.join(filled, "_cell").checkpoint()

    counts = [0] * len(points)
    for r in grid.groupBy("arc").agg(F.sum("c").alias("c")).collect():
        counts[r["arc"]] = r["c"]
    base, more = divmod(sum(counts), shards)
    segments = bounded_walk(counts, owners, [base + (s < more) for s in range(shards)])

    before = F.sum("c").over(Window.partitionBy("arc").orderBy("step")) - F.col("c")
    pieces = _literal_table(spark, segments, ["arc", "lo", "hi", "shard", "first"])
    takes = (
        grid.withColumn("off", before)
        .join(F.broadcast(pieces), "arc")
        .where("lo < off + c AND hi > off")
        .select("_cell", "shard", F.greatest(F.col("lo") - F.col("off"), F.lit(0)).alias("_from"),
                (F.col("hi") - F.col("off")).alias("_to"), (F.col("first") + F.col("off") - F.col("lo")).alias("_shift"))
    )
    in_cell = Window.partitionBy("_cell").orderBy("_at", "_id", "text_crc32", "size")
    ranked = rows.withColumn("_rank", F.row_number().over(in_cell) - 1)
    return (
        ranked.join(F.broadcast(takes), "_cell")
        .where("_rank >= _from AND _rank < _to")
        .select(F.col("_id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"),
                F.col("shard").cast("int").alias("shard"), (F.col("_rank") + F.col("_shift")).alias("slot"),
                F.lit(None).cast("int").alias("grown_shard"))
    )
