"""Ring sharding and mixing against brute force, and the pipeline's stages."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import SF_SMALL
from fixtures import no_documents, odd_documents, rows, rows_of_odd_documents, words
from pyspark.sql import functions as F

from moodstream.llm import mixing, sharding


def _walk_one_by_one(arcs, owners, bounds):
    """Rows one by one: round by round, points clockwise, each row tries its
    round's point."""
    room, slots, placed = list(bounds), Counter(), {}
    waiting = [(a, k) for a, c in enumerate(arcs) for k in range(c)]
    at = {r: r[0] for r in waiting}
    while waiting:
        waiting.sort(key=lambda r: at[r])
        left = []
        for r in waiting:
            shard = owners[at[r]]
            if room[shard]:
                room[shard] -= 1
                placed[r] = (shard, slots[shard])
                slots[shard] += 1
            else:
                at[r] = (at[r] + 1) % len(owners)
                left.append(r)
        waiting = left
    return placed


def test_bounded_walk_is_the_walk_of_single_rows():
    owners, counts = [0, 2, 1, 0, 1, 2, 2], [5, 0, 9, 1, 12, 2, 3]
    bounds = [11, 11, 10]
    want, got = _walk_one_by_one(counts, owners, bounds), {}
    for arc, lo, hi, shard, first in sharding.bounded_walk(counts, owners, bounds):
        for k in range(lo, hi):
            got[arc, k] = (shard, first + k - lo)
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    for shard in range(3):
        assert sorted(s for h, s in got.values() if h == shard) == list(range(bounds[shard]))


@pytest.mark.parametrize("shards", [1, 5, 8])
def test_shards_are_even_and_gapless(spark, shards):
    data = rows_of_odd_documents()
    got = rows(sharding.shard_by_ring(odd_documents(spark), shards, vnodes=16))
    assert Counter(r[0] for r in got) == Counter(r[0] for r in data)
    known = {r[0]: r[1] for r in data}
    by = defaultdict(list)
    for doc, size, crc, law, shard, slot, grown in got:
        data_bytes = (known[doc] or "").encode()
        assert (size, crc, law, grown) == (len(data_bytes) + 1, zlib.crc32(data_bytes), "rows", None)
        by[shard].append(slot)
    sizes = [len(by[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_another_shard_moves_few_rows(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    eight, nine = (dict(rows(sharding.shard_by_ring(docs, n).select("doc_id", "shard"))) for n in (8, 9))
    moved = sum(eight[k] != nine[k] for k in eight)
    assert sum(s == 8 for s in nine.values()) in (444, 445)
    assert moved < 0.4 * len(eight)  # a hash modulo the number of shards moves 8 of 9
    assert sharding.shard_by_ring(no_documents(spark)).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_by_ring(docs, 200, vnodes=128)


def _split(budget, children):
    """Shares by repeated rounds: (name, weight, cap) -> name: budget."""
    given, live = {c[0]: 0.0 for c in children}, [c for c in children if c[1] > 0]
    while live and budget > 1e-9:
        total = sum(c[1] for c in live)
        full = [c for c in live if c[2] <= budget * c[1] / total]
        for name, w, cap in full or live:
            given[name] = cap if full else budget * w / total
        if not full:
            break
        budget -= sum(c[2] for c in full)
        live = [c for c in live if c not in full]
    return given


def _mix(data, weights, part, epochs, seed):
    """The chosen (id, epoch, first token) by plain loops."""
    leaves = defaultdict(list)
    for doc, text, lang, source in data:
        n = len(words(text))
        if n:
            domain = "d" + str(int(re.search("[0-9]+$", source)[0]) % 4) if source else "(none)"
            leaves[domain, lang or "(none)", source or "(none)"].append((doc, n, str(doc) if doc is not None else hashlib.md5(text.encode()).hexdigest()))
    tokens = {k: sum(n for _, n, _ in v) for k, v in leaves.items()}
    budgets = {(): sum(tokens.values()) * part}
    for depth, level in enumerate(("domain", "lang", "source")):
        nxt = {}
        for above in {k[:depth] for k in tokens}:
            names = {k[depth] for k in tokens if k[:depth] == above}
            cap = {n: sum(v for k, v in tokens.items() if k[: depth + 1] == (*above, n)) * epochs for n in names}
            shares = _split(budgets[above], [(n, weights.get(level, {}).get(n, 1.0), cap[n]) for n in names])
            nxt |= {(*above, n): b for n, b in shares.items()}
        budgets = nxt
    out = []
    for leaf, docs in leaves.items():
        at, budget = 0, int(budgets[leaf] + 1e-6)
        for epoch in range(epochs):
            for doc, n, key in sorted(docs, key=lambda d: (hashlib.md5(f"{seed}/{epoch}/{d[2]}".encode()).hexdigest(), d[1])):
                if at < budget:
                    out.append((doc, *leaf, epoch, n, at, budget))
                at += n
    return sorted(out, key=str)


DOMAIN = "concat('d', cast(regexp_extract(source, '([0-9]+)$', 1) as int) % 4)"


@pytest.mark.parametrize(("part", "epochs"), [(0.3, 1), (0.9, 1), (1.4, 3), (0.0, 1)])
def test_mixture_is_brute_force(spark, part, epochs):
    weights = {"domain": {"d0": 6, "d1": 1, "d2": 0}, "lang": {"fr": 3, "(none)": 0.5}, "source": {"src3": 2}}
    data = [r[:4] for r in rows_of_odd_documents()]
    got = rows(mixing.select(odd_documents(spark), weights, part, F.expr(DOMAIN), seed=3, epochs=epochs))
    want = _mix(data, weights, part, epochs, 3)
    assert sorted(got, key=str) == want


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", "s1", 10.0), ("a", "x", "s2", 500.0), ("a", "y", "s3", 500.0), ("b", "x", "s4", 500.0)],
                                   "domain string, lang string, source string, leaf_tokens double")
    got = {r["source"]: r["leaf_budget"] for r in mixing.budgets(leaves, 400.0, {}, 1).collect()}
    # s1 lacks 40 of its 50: its sibling takes them; the other language and domain get what they had.
    assert got == {"s1": 10, "s2": 90, "s3": 100, "s4": 200}


def test_children_without_weight_hold_no_budget(spark):
    """Shares from the leaves: only those with positive weights all the way down count."""
    leaves = [("a", "x", "s1", 50.0), ("a", "y", "s2", 900.0), ("a", "x", "s5", 300.0), ("b", "x", "s3", 500.0), ("b", "y", "s4", 500.0)]
    weights = {"lang": {"y": 0}, "source": {"s5": 0}}
    table = spark.createDataFrame(leaves, "domain string, lang string, source string, leaf_tokens double")
    for total, epochs in ((400.0, 1), (90.0, 1), (700.0, 1), (700.0, 2), (0.0, 1)):
        got = {r["source"]: r["leaf_budget"] for r in mixing.budgets(table, total, weights, epochs).collect()}
        # s1 (of a) and s3 (of b) are all there is to choose from.
        want = _split(total, [("s1", 1, 50.0 * epochs), ("s3", 1, 500.0 * epochs)])
        assert got == {"s2": 0, "s4": 0, "s5": 0, "s1": int(want["s1"] + 1e-6), "s3": int(want["s3"] + 1e-6)}


def test_mix_keeps_columns_and_rows(spark):
    docs = odd_documents(spark)
    out = mixing.mix(docs, {}, 0.7, F.expr(DOMAIN))
    assert out.schema == docs.schema and 0 < out.count() < docs.count()
    assert mixing.mix(no_documents(spark), {}, 0.7, F.expr(DOMAIN)).count() == 0


def test_pipeline_stage_by_stage(spark):
    """Every stage against brute force on the rows that reach it."""
    import public_tokenizers
    from test_links import _exact, _simhash
    from tokenizers import Tokenizer

    import corpus_pipeline as pipe
    from moodstream.llm import quality
    from moodstream.llm.queries import MIX_SEED, MIX_WEIGHTS

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    seen, columns = {}, docs.columns
    for name, stage in pipe.STAGES:
        out = stage(spark, docs, SF_SMALL).cache()
        seen[name] = (rows(docs), rows(out))
        if name != "token_ids":
            assert out.columns == columns
        docs = out
    model = quality.train(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    sizes = quality.Sizes(model.good, model.bad)
    import numpy as np

    before, after = seen["quality"]
    assert {r[0] for r in after} == {r[0] for r in before if np.interp(sizes.difference(r[1]), model.at, model.score) >= 0.3}
    before, after = seen["exact_dedup"]
    assert {r[0] for r in after} == {r[0] for r in _exact(before) if r[3]} and len(after) < len(before)
    before, after = seen["near_dedup"]
    assert {r[0] for r in after} == {r[0] for r in _simhash(before) if r[0] == r[2]}
    before, after = seen["mixture"]
    assert {r[0] for r in after} == {r[0] for r in _mix([r[:4] for r in before], MIX_WEIGHTS, pipe.MIX_SHARE, 1, MIX_SEED)}
    before, after = seen["token_ids"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r[0]: r[1] for r in before}
    assert len(after) == len(before) > 0
    for r in after:
        assert r[-1] == library.encode(texts[r[0]], add_special_tokens=False).ids


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline as pipe

    spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF_SMALL}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert pipe.run(spark, str(tmp_path)).count() == 0


def test_null_and_shared_ids_are_decided_by_row(spark):
    """A third of the rows without an id and two texts with one id."""
    from moodstream.llm import simhash

    text = lambda k: " ".join(f"w{k}x{j}" for j in range(60))
    data = [(k if k % 3 else None, text(k), "en", f"src{k % 4}") for k in range(30)]
    data += [(100, text(100), "en", "src1"), (None, text(100), "en", "src1"), (None, text(101), "en", "src1"), (None, text(101), "en", "src2")]
    # Another text with an id that stays, a copy of a smaller id's text.
    data += [(4, text(1), "en", "src1")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string").repartition(3)
    stay = rows(simhash.survivors(docs))
    want = {(r[0], r[1]) for r in data} - {(None, text(100)), (4, text(1))}
    assert {r[:2] for r in stay} == want
    unique = spark.createDataFrame(data[:30], docs.schema)
    chosen = rows(mixing.select(unique, {}, 0.5, F.expr(DOMAIN)))
    mixed = rows(mixing.mix(unique, {}, 0.5, F.expr(DOMAIN)))
    assert len(mixed) == len(chosen) and Counter(r[0] for r in mixed) == Counter(r[0] for r in chosen)
    assert sum(r[0] is None for r in mixed) > 0


def test_domains_of_odd_sources(spark):
    from moodstream.llm.queries import DOMAIN_SQL

    sources = ["src0", "src7", "src10", "src123", "web", "", None, "7 up", "src" + "9" * 30 + "6", "src2147483648"]
    docs = spark.createDataFrame([(i, "one two three", "en", s) for i, s in enumerate(sources)], "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["domain"] for r in mixing.select(docs, {}, 1.0, F.expr(DOMAIN_SQL)).collect()}
    numbers = [re.search("[0-9]+$", s or "") for s in sources]
    assert got == {i: f"d{int(m[0]) % 4}" if m else "(none)" for i, m in enumerate(numbers)}
