"""Epochs of the TTL join in batch against the buffer itself."""

import datetime as dt
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from moodstream.operators import join_chains
from moodstream.streaming.join_timers import TtlJoin

T0 = dt.datetime(2026, 2, 1)
SCHEMA = "id string, side string, at timestamp, offset long"
TTL, DEDUPE = 7, 20


class Held:
    """State of one id, with the lifetime that the store would give it."""

    def __init__(self, clock, life_ms=None):
        self.clock, self.life, self.value, self.until = clock, life_ms, None, None

    def exists(self):
        return self.value is not None and (self.until is None or self.clock.now < self.until)

    def get(self):
        return self.value

    def update(self, value):
        self.value, self.until = value, None if self.life is None else self.clock.now + self.life

    def clear(self):
        self.value = None


def stream(rows):
    """(id, epoch outcome, end ms, raw offset, prediction offset) of the stream's processor, half by half, timers on time."""
    out = []
    for name in sorted({r[0] for r in rows}):
        clock, timers = SimpleNamespace(now=0), set()
        handle = SimpleNamespace(getValueState=lambda n, s, life=None: Held(clock, life), registerTimer=timers.add, deleteTimer=timers.discard)
        join, times = TtlJoin(TTL, DEDUPE), SimpleNamespace(getCurrentProcessingTimeInMs=lambda: clock.now)
        join.init(handle)
        for _, side, at, offset in [*sorted((r for r in rows if r[0] == name), key=lambda r: (r[2], r[3], r[1])), (name, None, 10**9, 0)]:
            for due in sorted(t for t in timers if t <= at * 1000):
                clock.now = due
                timers.discard(due)
                out += [(name, r.outcome, r.at_ms, r.raw_payload, r.prediction_payload) for r in join.handleExpiredTimer((name,), times, None)]
            clock.now = at * 1000
            if side:
                row = {"side": side, "payload": str(offset), "topic": side, "partition": 0, "offset": offset}
                out += [(name, r.outcome, r.at_ms, r.raw_payload, r.prediction_payload) for r in join.handleInputRows((name,), [row], times)]
    return out


def halves_of(seed, n=400):
    rnd = random.Random(seed)
    rows = [("hot" if rnd.random() < 0.4 else f"i{rnd.randrange(40)}", rnd.choice(["raw", "prediction"]), rnd.randrange(600), k + 1) for k in range(n)]
    # At one time both sides, the ends of TTL and dedupe period met exactly.
    return rows + [("edge", "raw", 0, 1000), ("edge", "raw", 7, 1001), ("edge", "prediction", 13, 1002), ("edge", "raw", 32, 1003), ("edge", "raw", 33, 1004),
                   ("edge", "prediction", 33, 1005), ("one", "prediction", 5, 1006)]


@pytest.mark.parametrize("seed", [1, 2])
def test_epochs_are_those_of_the_stream(spark, seed):
    rows = halves_of(seed)
    df = spark.createDataFrame([(i, s, T0 + dt.timedelta(seconds=t), o) for i, s, t, o in rows] + [("x", "raw", None, 9999)], SCHEMA).repartition(3)
    epochs = join_chains.join_chains(df, TTL, DEDUPE, num_partitions=5)
    want = stream(rows)
    got = [(r["id"], r["outcome"], int((r["ended_at"] - T0).total_seconds() * 1000), r["raw_offset"] and str(r["raw_offset"]),
            r["prediction_offset"] and str(r["prediction_offset"])) for r in epochs.collect()]
    assert sorted(got, key=str) == sorted((w for w in want if w[1] != "duplicate"), key=str)
    hot = sorted((r["epoch"], r["started_at"]) for r in epochs.collect() if r["id"] == "hot")
    assert [e for e, _ in hot] == list(range(1, len(hot) + 1)) and hot == sorted(hot, key=lambda h: h[1]) and len(hot) > 8
    counts = {r["outcome"]: r["n"] for r in join_chains.chain_outcomes(df, epochs).collect()}
    assert counts == {"joined": sum(w[1] == "joined" for w in want), "expired": sum(w[1] == "expired" for w in want), "duplicates": sum(w[1] == "duplicate" for w in want)}


@pytest.mark.parametrize("tasks", [1, 3, 16, 90])
def test_ids_cut_into_pieces_are_walked_as_one(spark, tasks):
    rows = halves_of(3, 700) + [("wide", ["raw", "prediction"][k % 7 == 0], k // 3, 2000 + k) for k in range(500)]
    df = spark.createDataFrame([(None if i == "i7" else i, s if o % 50 else None, T0 + dt.timedelta(seconds=t), o if o % 11 else None) for i, s, t, o in rows], SCHEMA)
    cols = ["id", "epoch", "side", "started_at", "outcome", "ended_at", "raw_offset", "prediction_offset"]
    got, want = join_chains.join_chains(df, TTL, DEDUPE, num_partitions=tasks).select(*cols).collect(), []
    order = lambda r: (r[2], r[3] is not None, r[3] or 0, r[1] is not None, r[1] or "")
    plain = [(None if i == "i7" else i, s if o % 50 else None, t, o if o % 11 else None) for i, s, t, o in rows]
    for name in {r[0] for r in plain}:
        mine, i, epoch = sorted((r for r in plain if r[0] == name), key=order), 0, 0
        while i is not None:
            _, side, t, offset = mine[i]
            epoch += 1
            met = next((r for r in mine[i + 1:] if r[1] == ("prediction" if side == "raw" else "raw")), None)
            met = met if met and met[2] - t < TTL else None
            end = met[2] + DEDUPE if met else t + TTL
            pair = (offset, met and met[3]) if side == "raw" else (met and met[3], offset)
            at = lambda s: T0 + dt.timedelta(seconds=s)
            want.append((name, epoch, side, at(t), "joined" if met else "expired", at(met[2] if met else end), *pair))
            i = next((k for k in range(i + 1, len(mine)) if mine[k][2] >= end), None)
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_tasks_grow_with_the_halves(spark, monkeypatch):
    monkeypatch.setattr(join_chains, "HALVES", 20)
    df = spark.createDataFrame([("hot", "raw", T0 + dt.timedelta(seconds=k), k) for k in range(400)], SCHEMA)
    epochs = join_chains.join_chains(df, TTL, DEDUPE)
    assert epochs.rdd.getNumPartitions() == 20
    assert [r["epoch"] for r in epochs.orderBy("started_at").collect()] == list(range(1, 59))
    assert max(r["count"] for r in epochs.groupBy(F.spark_partition_id()).count().collect()) < 10


def test_no_halves(spark):
    assert join_chains.join_chains(spark.createDataFrame([], SCHEMA), TTL, DEDUPE).count() == 0


def walked_plainly(rows, ttl, dedupe):
    out = []
    for name in {r[0] for r in rows}:
        mine, i, epoch = sorted((r for r in rows if r[0] == name), key=lambda r: (r[2], r[3], r[1])), 0, 0
        while i is not None:
            _, side, t, offset = mine[i]
            epoch += 1
            met = next((r for r in mine[i + 1:] if r[1] != side), None)
            met = met if met and met[2] - t < ttl else None
            end = met[2] + dedupe if met else t + ttl
            out.append((name, epoch, side, T0 + dt.timedelta(seconds=t), *((offset, met and met[3]) if side == "raw" else (met and met[3], offset))))
            i = next((k for k in range(i + 1, len(mine)) if mine[k][2] >= end), None)
    return sorted(out, key=str)


@pytest.mark.parametrize("ttl, dedupe, tasks", [(TTL, DEDUPE, 8), (TTL, 0, 1), (0, DEDUPE, 1)])
def test_only_halves_that_can_count_are_held_back(spark, monkeypatch, ttl, dedupe, tasks):
    """Of an id that goes over several partitions, at one time the first half of each side;
    every half if an epoch may end as it starts."""
    held, entries = [], join_chains._entries
    monkeypatch.setattr(join_chains, "HALVES", 20)
    monkeypatch.setattr(join_chains, "_entries", lambda halves, *rest: held.append(halves) or entries(halves, *rest))
    rnd = random.Random(7)
    rows = [("hot", rnd.choice(["raw", "prediction"]), rnd.randrange(12) * 5, k) for k in range(900)] + [(f"i{k % 60}", ["raw", "prediction"][k // 60 % 2], k, k) for k in range(600)]
    df = spark.createDataFrame([(i, s, T0 + dt.timedelta(seconds=t), o) for i, s, t, o in rows], SCHEMA).repartition(3)
    got = join_chains.join_chains(df, ttl, dedupe, num_partitions=tasks).select("id", "epoch", "side", "started_at", "raw_offset", "prediction_offset").collect()
    assert sorted((tuple(r) for r in got), key=str) == walked_plainly(rows, ttl, dedupe)
    n = held[0].count()
    assert n < 300 if ttl and dedupe else n >= 900


@pytest.mark.parametrize("tasks", [3, 16, 90])
def test_pieces_are_walked_where_more_is_held_back(spark, monkeypatch, tasks):
    monkeypatch.setattr(join_chains, "HALVES", 20)
    test_ids_cut_into_pieces_are_walked_as_one(spark, tasks)


@pytest.mark.parametrize("most, calls", [(20, 1), (10**6, 0)])
def test_pieces_are_only_followed_where_one_task_is_not_enough(spark, monkeypatch, most, calls):
    made, pieces = [], join_chains._pieces
    monkeypatch.setattr(join_chains, "HALVES", most)
    monkeypatch.setattr(join_chains, "_pieces", lambda held: made.append(held) or pieces(held))
    rows = [("hot", ["raw", "prediction"][k % 3 == 0], k // 30, k) for k in range(900)]
    df = spark.createDataFrame([(i, s, T0 + dt.timedelta(seconds=t), o) for i, s, t, o in rows], SCHEMA)
    got = join_chains.join_chains(df, TTL, DEDUPE, num_partitions=8).select("id", "epoch", "side", "started_at", "raw_offset", "prediction_offset").collect()
    assert sorted((tuple(r) for r in got), key=str) == walked_plainly(rows, TTL, DEDUPE)
    assert len(made) == calls


def test_pointer_doubling_reaches_what_a_walk_reaches(spark):
    rnd = random.Random(5)
    to = {i: rnd.randrange(i + 1, min(i + 4, 301)) for i in range(300)}
    roots, want = [0, 150], set()
    for r in roots:
        while r is not None:
            want.add(r)
            r = to.get(r)
    got = join_chains.reachable(spark.createDataFrame([(r,) for r in roots], "_r long"), spark.createDataFrame(list(to.items()) + [(300, None)], "_r long, _to long"))
    assert {r[0] for r in got.collect()} == want
