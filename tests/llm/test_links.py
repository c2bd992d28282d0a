"""Exact copies, SimHash and embedding links against brute force."""

import random

import numpy as np
import xxhash
from fixtures import no_documents, odd_documents, rows, rows_of_odd_documents, union_find, words
from pyspark.sql import functions as F

from moodstream.llm import embed_dedup, exact_dedup, simhash
from moodstream.llm.components import connected_components


def _exact(data):
    strip = str.maketrans("", "", " \t\n\x0b\x0c\r")
    groups = {}
    for r in data:
        groups.setdefault((r[1] or "").translate(strip), []).append(r)
    out = []
    for members in groups.values():
        keep = min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0]
        out += [(r[0], keep, len(members), r[0] == keep) for r in members]
    return sorted(out, key=str)


def test_exact_dedup_is_brute_force(spark):
    docs, want = odd_documents(spark), _exact(rows_of_odd_documents())
    got = exact_dedup.exact_dedup(docs).cache()
    assert sorted(rows(got.drop("text_sha256")), key=str) == want
    # One hash for all texts: only the bytes tell them apart.
    clash = exact_dedup.exact_dedup(docs, hashed=lambda _: F.lit("00" * 16))
    assert sorted(rows(clash.drop("text_sha256")), key=str) == want
    assert exact_dedup.exact_dedup(no_documents(spark)).count() == 0


def test_exact_survivors_are_the_kept_rows_once(spark):
    docs = odd_documents(spark)
    stay = exact_dedup.survivors(docs)
    assert stay.schema == docs.schema
    want = {r[0] for r in _exact(rows_of_odd_documents()) if r[3]}
    ids = [r["doc_id"] for r in stay.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and set(ids) == want
    assert exact_dedup.survivors(no_documents(spark)).count() == 0


def _print(text):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def _simhash(data):
    prints = {k: _print(r[1]) for k, r in enumerate(data)}
    values = sorted(set(prints.values()))
    links = [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= 3]
    part = union_find(values, links)
    first = {}
    for k, r in enumerate(data):
        if r[0] is not None:
            first[part[prints[k]]] = min(first.get(part[prints[k]], r[0]), r[0])
    return sorted(((r[0], f"{prints[k]:016x}", first.get(part[prints[k]])) for k, r in enumerate(data)), key=str)


def test_simhash_is_brute_force(spark):
    # Long texts with one or two words changed: fingerprints a few bits apart.
    rnd = random.Random(5)
    base = [rnd.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rnd.randrange(50)) for _ in range(400)]
    near = []
    for k in range(40):
        w = list(base)
        for _ in range(k % 4):
            w[rnd.randrange(400)] = "changed"
        near.append((1000 + k, " ".join(w)) + (None,) * 8)
    data = rows_of_odd_documents() + near
    docs = spark.createDataFrame(data, odd_documents(spark).schema)
    got, want = rows(simhash.near_duplicates(docs)), _simhash(data)
    assert sorted(got, key=str) == want
    assert len({w[2] for w in want if w[0] and w[0] >= 1000}) < len({w[1] for w in want if w[0] and w[0] >= 1000})
    kept = [r["doc_id"] for r in simhash.representatives(docs).collect()]
    assert set(kept) == {w[0] for w in want if w[0] is not None and w[0] == w[2]}
    assert simhash.near_duplicates(no_documents(spark)).count() == 0


def test_anchors_lose_no_pair_and_hot_anchors_are_split(spark):
    rng = np.random.default_rng(1)
    one = rng.integers(-(2**63), 2**63, 300, dtype=np.int64)
    two = one.copy()
    for _ in range(3):
        two ^= np.left_shift(np.int64(1), rng.integers(0, 64, 300))
    crowd = one[0] ^ np.left_shift(np.int64(1), np.arange(62)) ^ np.int64(1)  # all within 2 bits of each other
    prints = sorted({int(v) for v in np.concatenate([one, two, crowd])})
    want = union_find(prints, [(a, b) for i, a in enumerate(prints) for b in prints[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3])
    table = spark.createDataFrame([(p,) for p in prints], "fp long")
    for blocks, block in ((2, 4096), (2, 8), (1, 4096)):
        links = rows(simhash.near_links(table, blocks=blocks, block=block))
        assert union_find(prints, links) == want


def test_components_are_those_of_union_find(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(500, i) for i in range(501, 540)]
    want = union_find({n for e in edges for n in e}, edges)
    got = dict(rows(connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b")))
    assert got == {n: r for n, r in want.items() if n != r}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def _embedding_rows():
    rng = np.random.default_rng(3)
    out = []
    for k in range(30):
        v = rng.standard_normal(16)
        out.append((v, k % 3))
        for noise in (0.02, 0.05, 0.06, 0.2):
            out.append((v + noise * rng.standard_normal(16), k % 3))
    tight = rng.standard_normal(16)
    out += [(tight + 0.01 * rng.standard_normal(16), 1) for _ in range(40)] + [(tight, 1)] * 20 + [(3 * tight, 1), (tight, None), (tight, 2)]
    data = [(i, [float(x) for x in v], lab, "extra") for i, (v, lab) in enumerate(out)]
    n = len(data)
    odd = [None, [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [float("inf")] * 16, [], [1.0, 2.0], [2.0, 4.0], [1e300] * 16, [1e300] * 16, [1e-300] * 16]
    data += [(n + i, v, 1, None) for i, v in enumerate(odd)]
    return data + [data[0], (None, data[0][1], 0, None)]


def test_embedding_links_are_brute_force(spark):
    data = _embedding_rows()
    schema = "vec_id long, embedding array<double>, label int, cls string"
    got = sorted(rows(embed_dedup.near_duplicates(spark.createDataFrame(data, schema).repartition(4), block=4)), key=str)
    ok = [lab is not None and bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, lab, _ in data]
    links = [[] for _ in data]
    for i, (_, a, la, _) in enumerate(data):
        for j, (_, b, lb, _) in enumerate(data):
            if i != j and ok[i] and ok[j] and la == lb and len(a) == len(b):
                x, y = (np.array(v) / np.max(np.abs(v)) for v in (a, b))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    links[i].append(j)
    part = union_find(range(len(data)), [(i, j) for i, js in enumerate(links) for j in js])
    first = {}
    for i, r in enumerate(data):
        if r[0] is not None:
            first[part[i]] = min(first.get(part[i], r[0]), r[0])
    want = sorted(((r[0], len(links[i]), first.get(part[i]), r[0] == first.get(part[i])) for i, r in enumerate(data)), key=str)
    assert got == want
    assert embed_dedup.near_duplicates(spark.createDataFrame([], schema)).count() == 0
