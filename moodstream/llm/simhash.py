"""SimHash near-duplicates by anchor-point covering.

Fingerprint. A-Z are lower-cased, words are runs of ``[^\\x20\\x09-\\x0D]``, and
every 3-word shingle (repeats included; fewer words: the whole sequence) is
hashed with XXH64, seed 42. A bit of the 64 is 1 if set in over half of the
hashes; a text without words has fingerprint zero.

Anchors. The covering code is a product of binary Golay codes of length 23,
one per block of 23 bits (two blocks: 46 bits, 2^24 anchors). The code is
perfect, so each fingerprint lies within 3 bits of one codeword per block:
covering radius R = 3 per block. A pair within t bits has a point z halfway:
one end is at most floor(t/2) bits from z, the other at most ceil(t/2). The
anchor nearest to z is therefore within R + ceil(t/2) of both. So every
fingerprint goes to the anchors that are nearest to some point at most
ceil(t/2) bits away from it, marked ``near`` where floor(t/2) bits are enough,
and each pair is found where a near copy meets any other copy. (Sending it
to all anchors within R + t would find the same pairs at five times the rows.)
Bits outside the blocks take no part: a distance on some of the bits is never
larger than on all. The anchors of a block depend only on the coset of its
23 bits, so they come from a table of 2048 rows built once per task.

Compare. Copies are shuffled by anchor and sorted; one pass over each
partition compares the members of each anchor on all 64 bits and reduces the
links of every batch to a spanning forest, so that a dense group of g
fingerprints leaves a task as fewer than g rows. An anchor with more than
``block`` members is compared in blocks of that many, one pair of blocks per
task group (see ``_spread``), so no task holds a whole hot anchor.

Only distinct fingerprints take part: copies with one fingerprint, however
many, are one row. ``component_id`` is the smallest id reachable.

Defined cases: null and empty texts have fingerprint zero and are linked like
any other; a null id is carried and never is a component id unless nothing
else is there (``survivors`` then keeps one of those rows); repeated rows
are linked like copies; an empty table gives an
empty result; extra columns are ignored by ``near_duplicates`` and carried by
``survivors`` and ``representatives``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodstream.llm.common import keep_rows, prepare, row_key
from moodstream.llm.components import connected_components

SHINGLE, MAX_BITS, SEED = 3, 3, 42
# The generator polynomial of the binary Golay code, and its length.
GOLAY, LENGTH = 0b110001110101, 23
# Members of one anchor that one task compares with as many others.
BLOCK = 4096


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, count = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, len(words), 65536):
        part = words[at : at + 65536 + shingle - 1]
        grams = map(b" ".join, zip(*(part[k:] for k in range(shingle)), strict=False))
        bits = np.frombuffer(b"".join([digest(g, SEED) for g in grams]), np.uint8).reshape(-1, 8)
        count += np.unpackbits(bits, axis=1).sum(axis=0, dtype=np.int64)
    shingles = len(words) - shingle + 1
    return int.from_bytes(np.packbits(count * 2 > shingles).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All columns but the text, and its fingerprint."""
    for b in batches:
        prints = np.array([fingerprint(t) for t in b.column("_text").to_pylist()], np.uint64).astype(np.int64)
        names = [n for n in b.schema.names if n != "_text"]
        yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], pa.array(prints)], names=[*names, "fp"])


def _syndromes() -> np.ndarray:
    """Remainders of all 23-bit words of one byte, at each of three places."""
    table = np.zeros((3, 256), np.int64)
    for place in range(3):
        for byte in range(256):
            word = byte << 8 * place
            for bit in range(LENGTH, 10, -1):
                if word >> bit & 1:
                    word ^= GOLAY << bit - 11
            table[place, byte] = word
    return table


def syndrome(words: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[0][words & 255] ^ table[1][words >> 8 & 255] ^ table[2][words >> 16 & 127]


@lru_cache
def anchor_tables(flips: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The syndrome table and, for each number of flips j, the patterns that
    lead a word of a coset to the anchors that take j flips at least:
    (patterns by coset, padded; how many per coset)."""
    table = _syndromes()
    singles = [1 << i for i in range(LENGTH)]
    by_weight = [[0], singles, [a | b for i, a in enumerate(singles) for b in singles[:i]]]
    by_weight.append([a | b for i, a in enumerate(singles) for b in by_weight[2] if b < a and not a & b])
    leader = np.zeros(1 << 11, np.int64)
    for patterns in by_weight:
        leader[syndrome(np.array(patterns), table)] = patterns
    cosets, known, out = np.arange(1 << 11), np.full(((1 << 11), 0), -1, np.int64), []
    for j in range(flips + 1):
        moves = np.array(by_weight[j])
        reach = np.sort(moves ^ leader[cosets[:, None] ^ syndrome(moves, table)], axis=1)
        fresh = np.ones(reach.shape, bool)
        fresh[:, 1:] = reach[:, 1:] != reach[:, :-1]
        if known.shape[1]:
            fresh &= ~(reach[:, :, None] == known[:, None, :]).any(axis=2)
        n = fresh.sum(axis=1)
        packed = np.take_along_axis(reach, np.argsort(~fresh, axis=1, kind="stable"), axis=1)[:, : max(1, n.max())]
        packed = np.where(np.arange(packed.shape[1]) < n[:, None], packed, -1)
        known = np.concatenate([known, packed], axis=1)
        out.append((packed, n))
    return table, out


def _splits(flips: int, blocks: int) -> list[tuple[int, ...]]:
    if blocks == 1:
        return [(j,) for j in range(flips + 1)]
    return [(j, *rest) for j in range(flips + 1) for rest in _splits(flips - j, blocks - 1)]


def anchors(prints: np.ndarray, flips: int, blocks: int, tables) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(row, anchor, flips needed) of all anchors reachable with ``flips``."""
    table, by_flips = tables
    words = [prints.astype(np.uint64) >> np.uint64(LENGTH * k) & np.uint64((1 << LENGTH) - 1) for k in range(blocks)]
    words = [w.astype(np.int64) for w in words]
    cosets = [syndrome(w, table) for w in words]
    for split in _splits(flips, blocks):
        rows, anchor = np.arange(len(prints)), np.zeros(len(prints), np.int64)
        for k, j in enumerate(split):
            patterns = by_flips[j][0][cosets[k][rows]]
            r, c = np.nonzero(patterns >= 0)
            rows, anchor = rows[r], anchor[r] | (words[k][rows[r]] ^ patterns[r, c]) << LENGTH * k
        yield rows, anchor, sum(split)


def _replicate(flips: int, near: int, blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = anchor_tables(flips)
        for b in batches:
            prints = b.column("fp").to_numpy(zero_copy_only=False)
            for at in range(0, len(prints), 8192):
                part = prints[at : at + 8192]
                for rows, anchor, needed in anchors(part, flips, blocks, tables):
                    if len(rows):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(anchor), pa.array(part[rows]), pa.array(np.full(len(rows), needed <= near))],
                            names=["group", "fp", "near"])

    return run


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its part) of the graph with these edges, for
    nodes that are not smallest themselves."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        while not np.array_equal(jump := new[new], new):
            new = jump
        if (new == label).all():
            break
        label = new
    away = label != np.arange(len(nodes))
    return nodes[away], nodes[label[away]]


def _close(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= bits


def link_sorted(group: np.ndarray, prints: np.ndarray, near: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows that are sorted by group: at each distance in the order,
    all rows are compared at once with the row that many places on."""
    found_a, found_b, step, live = [], [], 1, np.arange(len(group))
    while True:
        live = live[live + step < len(group)]
        live = live[group[live] == group[live + step]]
        if not len(live):
            break
        a, b = prints[live], prints[live + step]
        hit = _close(a, b, bits) & (near[live] | near[live + step]) & (a != b)
        found_a.append(a[hit])
        found_b.append(b[hit])
        step += 1
    if not found_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


def _compare(bits: int, block: int | None):
    """Rows (group, fp, near) sorted by group -> links (node, root) and, of
    groups larger than ``block``, the rows themselves (group, fp), ``hot``."""

    def emit(a: np.ndarray, b: np.ndarray, near: np.ndarray, hot: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(near), pa.array(np.full(len(a), hot))],
                                          names=["a", "b", "near", "hot"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))
        streaming = None

        def whole(group, prints, near):
            starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            sizes = np.diff(np.r_[starts, len(group)])
            large = np.repeat(sizes > block, sizes) if block else np.zeros(len(group), bool)
            if large.any():
                yield emit(group[large], prints[large], near[large], True)
            a, b = forest(*link_sorted(group[~large], prints[~large], near[~large], bits))
            if len(a):
                yield emit(a, b, np.zeros(len(a), bool), False)

        for batch in batches:
            new = tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("group", "fp", "near"))
            group, prints, near = (np.concatenate(x) for x in zip(kept, new, strict=True))
            if streaming is not None:
                n = int(np.searchsorted(group, streaming, "right"))
                if n:
                    yield emit(group[:n], prints[:n], near[:n], True)
                group, prints, near = group[n:], prints[n:], near[n:]
            if not len(group):
                kept = (group, prints, near)
                continue
            cut = int(np.searchsorted(group, group[-1], "left"))
            if cut:
                yield from whole(group[:cut], prints[:cut], near[:cut])
            kept = (group[cut:], prints[cut:], near[cut:])
            streaming = None
            if block and len(kept[0]) > block:
                streaming = kept[0][0]
                yield emit(*kept, True)
                kept = tuple(x[:0] for x in kept)
        if len(kept[0]):
            yield from whole(*kept)

    return run


def _links(rows: DataFrame, bits: int, block: int | None) -> DataFrame:
    """Rows (group, fp, near), compared group by group."""
    ordered = rows.repartition("group").sortWithinPartitions("group")
    return ordered.mapInArrow(_compare(bits, block), "a long, b long, near boolean, hot boolean")


def _spread(hot: DataFrame, block: int) -> DataFrame:
    """Large groups cut into blocks by a hash of the fingerprint; every pair of
    blocks becomes a group of its own."""
    sizes = hot.groupBy("a").agg(F.ceil(F.count("*") / block).alias("m"))
    cut = hot.join(sizes, "a").withColumn("i", F.pmod(F.xxhash64("b"), F.col("m")))
    paired = cut.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)))
    return paired.select(F.xxhash64("a", F.least("i", "j"), F.greatest("i", "j")).alias("group"), F.col("b").alias("fp"), "near")


def near_links(prints: DataFrame, bits: int = MAX_BITS, blocks: int = 2, block: int = BLOCK) -> DataFrame:
    """Distinct fingerprints (``fp`` long) -> links (a, b): a spanning forest
    of all pairs within ``bits`` bits. ``blocks``: Golay blocks used, 1 or 2
    (2^12 or 2^24 anchors)."""
    far, near = -(-bits // 2), bits // 2
    if far > 2:
        raise ValueError("anchors are tabulated for up to 4 bits")
    copies = prints.mapInArrow(_replicate(far, near, blocks), "group long, fp long, near boolean")
    first = _links(copies, bits, block).checkpoint()
    second = _links(_spread(first.where("hot"), block), bits, None)
    return first.where("NOT hot").select("a", "b").unionByName(second.select("a", "b"))


def _rooted(prints: DataFrame, first: Column, bits: int) -> DataFrame:
    """Rows with ``fp`` -> (fp, first, root) of each distinct fingerprint;
    ``first`` is an aggregate."""
    classes = prints.groupBy("fp").agg(first.alias("first"))
    roots = connected_components(near_links(classes.select("fp"), bits), "a", "b")
    return classes.join(roots, classes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: id, fingerprint (hex), component_id."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    prints = texts.mapInArrow(_fingerprints, "_id long, fp long").checkpoint()
    rooted = _rooted(prints, F.min("_id"), bits)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    parts = rooted.join(smallest, "root").select("fp", "component_id")
    return prints.join(parts, "fp").select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = MAX_BITS) -> DataFrame:
    """The row of the smallest id of each component (null ids last, then by the
    key of id and text), with all columns. Rows equal in id and text stay
    together."""
    prepare(docs.sparkSession)
    keyed = docs.select(F.col(id_col).cast("long").alias("_id"), *row_key(id_col, text_col), F.col(text_col).alias("_text"))
    prints = keyed.mapInArrow(_fingerprints, "_id long, _k1 long, _k2 long, fp long").checkpoint()
    best = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_k1", "_k2"))
    stay = _rooted(prints, best, bits).groupBy("root").agg(F.min("first").alias("best")).select("best._k1", "best._k2")
    return keep_rows(docs, stay, id_col, text_col)


def representatives(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of the smallest id of each component, with all columns: those
    of ``survivors`` that have an id."""
    return survivors(docs, id_col, **options).where(F.col(id_col).isNotNull())
