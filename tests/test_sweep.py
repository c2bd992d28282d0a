"""Points and the spans over them against every pair compared."""

import random

import pytest

from moodstream.plans import sweep

POINTS, SPANS = "k string, t long, v double", "k string, lo long, hi long, name string"


def brute(points, spans, keyed=True):
    out = []
    for k, t, v in points:
        met = [(lo, hi, n) for key, lo, hi, n in spans if (key == k or not keyed) and None not in (t, lo, hi) and lo <= t <= hi]
        out += [(k, t, v, *m) for m in met] or [(k, t, v, None, None, None)]
    return sorted(out, key=str)


def data(seed, n=300, m=60):
    rnd = random.Random(seed)
    key = lambda: "hot" if rnd.random() < 0.5 else rnd.choice(["a", "b", None])
    points = [(key(), rnd.randrange(1000), rnd.random()) for _ in range(n)] + [("a", None, 1.0), ("lone", 5, 2.0)] + [("hot", 77, 3.0)] * 30
    spans = [(key(), lo := rnd.randrange(1000), lo + rnd.choice([-3, 0, 5, 40, 2000]), f"s{i}") for i in range(m)]
    return points, spans + [("hot", 0, 10**6, "all")] * 2 + [("none", 1, 9, "x"), ("a", None, 9, "n"), ("a", 1, None, "n"), ("hot", 77, 77, "one")]


@pytest.mark.parametrize(("seed", "parts"), [(1, 7), (2, 1), (3, 30)])
def test_every_pair(spark, seed, parts):
    points, spans = data(seed)
    p, s = spark.createDataFrame(points, POINTS).repartition(3), spark.createDataFrame(spans, SPANS)
    got = sweep.covering(p, s, "t", "lo", "hi", keys=["k"], num_partitions=parts)
    assert got.columns == ["k", "t", "v", "lo", "hi", "name"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(points, spans)


def test_without_keys_and_in_small_batches(spark):
    points, spans = data(4)
    p, s = spark.createDataFrame(points, POINTS), spark.createDataFrame(spans, SPANS).drop("k")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = sorted((tuple(r) for r in sweep.covering(p, s, "t", "lo", "hi", num_partitions=4).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute(points, spans, keyed=False)


def test_output_goes_out_in_pieces(spark):
    def pieces(batches):
        held, sweep.OUT_ROWS = sweep.OUT_ROWS, 11
        try:
            yield from sweep._sweep(["_pid"])(batches)
        finally:
            sweep.OUT_ROWS = held

    rows = [(0, 0, 0, 100, None, (1,)), (0, 0, 0, 20, None, (2,))] + [(0, i, 1, None, (i,), None) for i in range(200)]
    df = spark.createDataFrame(rows, "_pid int, _t long, _k int, _hi long, _p struct<x:long>, _s struct<n:long>").coalesce(1)
    got = df.mapInArrow(pieces, "_p struct<x:long>, _s struct<n:long>").select("_p.x", "_s.n").collect()
    assert sorted((r["x"], r["n"] or 0) for r in got) == sorted([(i, 1) for i in range(101)] + [(i, 2) for i in range(21)] + [(i, 0) for i in range(101, 200)])


def test_nothing_to_sweep(spark):
    p, s = spark.createDataFrame([], POINTS), spark.createDataFrame([], SPANS)
    assert sweep.covering(p, s, "t", "lo", "hi", keys=["k"]).count() == 0
    one = spark.createDataFrame([("a", 1, 1.0)], POINTS)
    assert [tuple(r) for r in sweep.covering(one, s, "t", "lo", "hi", keys=["k"]).collect()] == [("a", 1, 1.0, None, None, None)]
