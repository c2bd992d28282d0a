"""Hard negatives, source divergence and quality rules against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from fixtures import no_documents, odd_documents, rows, rows_of_odd_documents, words
from pyspark.sql import functions as F

from moodstream.llm import divergence, hard_negatives, quality_rules

VECTORS = "vec_id long, embedding array<double>, label int, acls string"


def _vectors(wide=1.0):
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((6, 20))
    data = [(i, [float(x) * wide for x in centres[i % 6] + 0.4 * rng.standard_normal(20)], int(rng.integers(4)), "x") for i in range(300)]
    data += [(300 + i, data[5][1], i % 2, None) for i in range(150)]  # a third are copies, under two labels
    odd = [None, [float("nan")] + [1.0] * 19, [None] * 20, [float("inf")] * 20, [], [], [1.0, 2.0], [2.0, 1.0], [3.0, 3.0], [1e300] * 20, [0.0] * 20]
    data += [(500 + 10 * i, v, i % 3, None) for i, v in enumerate(odd)]
    return data + [data[0], (None, data[1][1], 1, None), (700, data[1][1], None, None), (30, [0.5] * 20, 2, None)]


def _mined(data, every, low, k=5, m=4):
    seen = set()
    for i, v, label, _ in data:
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) and abs(x) < 2**40 for x in v):
            seen.add((i, label, tuple(math.floor(256 * x) for x in v)))
    out = set()
    for a, la, qa in seen:
        if a % every:
            continue
        score = [(-sum(x * y for x, y in zip(qa, q, strict=True)), i, label) for i, label, q in seen if len(q) == len(qa)]
        for ps, p, _ in sorted(s for s in score if s[2] == la and s[1] != a)[:k]:
            inside = sorted(s for s in score if s[2] != la and low * -ps <= 100 * -s[0] <= 100 * -ps)[:m]
            out |= {(a, p, r + 1, n, -ps, -ns) for r, (ns, n, _) in enumerate(inside)}
    return out


@pytest.mark.parametrize(("wide", "low", "blocks"), [(1.0, 80, (64, 16)), (1.0, -50, (2048, 4096)), (300000.0, 50, (100, 8))])
def test_hard_negatives_are_brute_force(spark, wide, low, blocks):
    data = _vectors(wide)
    table = spark.createDataFrame(data, VECTORS).repartition(3)
    got = hard_negatives.mine(table, F.col("vec_id") % 10 == 0, negatives=4, low=low, row_block=blocks[0], anchor_block=blocks[1])
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert set(rows(got)) == _mined(data, 10, low) and got.count() == len(_mined(data, 10, low))


def test_hard_negatives_without_rows_or_anchors(spark):
    assert hard_negatives.mine(spark.createDataFrame([], VECTORS), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.mine(spark.createDataFrame(_vectors()[:50], VECTORS), F.col("vec_id") < 0).count() == 0


def test_threshold_join_finds_every_pair():
    rng = np.random.default_rng(2)
    for dims, kind in ((1, float), (8, float), (37, np.int64), (64, float)):
        a, x = (np.floor(100 * rng.standard_normal((n, dims)) * np.geomspace(3, 0.1, dims)).astype(kind) for n in (40, 300))
        want = a @ x.T
        for theta in (np.full(40, want.max() * 0.6), np.sort(want, axis=1)[:, -5].astype(float), np.full(40, -1.0 * want.max())):
            r, c, s = hard_negatives.above(a, x, theta)
            assert sorted(zip(r.tolist(), c.tolist(), s.tolist(), strict=True)) == [
                (i, j, int(want[i, j])) for i in range(40) for j in range(300) if want[i, j] >= theta[i]]


def _terms(text):
    return [t.translate({c: c + 32 for c in range(65, 91)}) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def _audit(data, least, top):
    docs = [(r[2] or "", r[3] or "", _terms(r[1])) for r in data]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        has = Counter(t for d in own for t in set(d[2]))
        kept = [t for t in has if has[t] >= least]
        groups = {s: Counter(t for d in own if d[1] == s for t in d[2] if has[t] >= least) for s in {d[1] for d in own}}

        def share(counts, t):
            return 1 + (10**9 * (counts[t] + 5)) // (sum(counts.values()) + 5 * len(kept))

        whole = sum(groups.values(), Counter())
        for g, counts in groups.items():
            pairs = [(-sum(abs(share(counts, t) - share(other, t)) for t in kept), h) for h, other in groups.items() if h != g]
            terms = [(share(whole, t) - share(counts, t), t) for t in kept if counts[t] and share(counts, t) > share(whole, t)]
            for part, found in (("pair", pairs), ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:top])):
                out += [(lang, g, part, item, -v, n + 1) for n, (v, item) in enumerate(sorted(found, key=lambda x: (x[0], x[1].encode())))]
    return sorted(out)


def _sourced(n=160):
    rnd = random.Random(4)
    vocabulary = ["The", "éa", "don't", "Größe", "漢字", *(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))]
    pad = (None,) * 6
    return rows_of_odd_documents() + [
        (100 + i, " ".join(rnd.choices(vocabulary[: 10 + 9 * (i % 7)], k=rnd.randrange(30))), rnd.choice(["en", "de", "x"]), f"s{i % 6 if i % 3 else 0}", *pad)
        for i in range(n)]


@pytest.mark.parametrize("least", [1, 4, 1000])
def test_divergence_is_brute_force(spark, least):
    data = _sourced()
    docs = spark.createDataFrame(data, odd_documents(spark).schema).repartition(5)
    assert sorted(rows(divergence.audit(docs, least_docs=least, top=7))) == _audit(data, least, 7)


def test_divergence_of_nothing(spark):
    assert divergence.audit(no_documents(spark)).count() == 0


def test_tree_makes_each_correction_once(monkeypatch):
    tree, made = divergence.Tree(), []
    close = divergence.Tree.close
    monkeypatch.setattr(divergence.Tree, "close", lambda self, depth: (made.append(len(self.path) - depth), close(self, depth))[1])
    a, b, c = ("a", 9, 1), ("b", 7, 2), ("c", 4, 3)
    for row, times in (([a, b], 5), ([a, b, c], 2), ([a, c], 1)):
        tree.add(row, times)
    tree.close(0)
    # a, b, c and the other c: four nodes for eight items of rows.
    assert sum(n for n in made if n > 0) == 4
    one = {("a", "b"): 7 * (2 - 7 - 6 + 1), ("a", "c"): 3 * (5 - 6 - 3 + 2), ("b", "c"): 2 * (3 - 4 - 2 + 1)}
    assert dict(tree.sums) == one


def _statistics(text):
    w, t = words(text), text or ""
    spots = {}
    for i in range(len(w) - 2):
        spots.setdefault(tuple(w[i : i + 3]), []).append(i)
    repeated = {i + k for at in spots.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in t.split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeated), len(lines)


def _tail(n, k, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def _judged(data, labels, stratum, risk, error):
    known = {}
    for i, y in labels:
        if i is not None and y is not None:
            known[i] = max(y, known.get(i, 0))
    found = [(r[0], _statistics(r[1]), stratum(r)) for r in data]

    def base(s):
        return s[0] < 50 or 100 * s[4] > 50 * s[0]

    def values(s):
        n, lines = max(s[0], 1), max(s[5], 1)
        return {"long_words": 100 * s[1] // n, "short_words": -(100 * s[1] // n), "symbols": 1000 * s[2] // n,
                "repeated_lines": 1000 * s[3] // lines, "repeated_words": 100 * s[4] // n}

    least = {}
    for i, s, where in found:
        if i in known and not base(s):
            least[i] = min(least.get(i, ((chr(0x10FFFF),), None)), ((where, s[0], s[1], s[2], s[5], s[3], s[4]), s), key=lambda x: x[0])
    hold = [(key[0], values(s), known[i] == 1) for i, (key, s) in least.items()]
    strata, rate, cutoffs = {h[0] for h in hold}, risk / 5, {}
    for where in strata:
        good = [v for h, v, y in hold if h == where and y]
        bad = [v for h, v, y in hold if h == where and not y]
        for rule, (_, ladder) in quality_rules.RULES.items():
            best = (0, None)
            for cutoff in ladder:
                lost, caught = (sum(v[rule] > cutoff for v in of) for of in (good, bad))
                if not good or _tail(len(good), lost, rate) > error / 5 / len(strata):
                    break
                best = max(best, (caught - lost, cutoff), key=lambda b: b[0])
            if best[1] is not None:
                cutoffs[where, rule] = best[1]
    out = []
    for i, s, where in found:
        broken = [] if base(s) else [r for r in quality_rules.RULES if (where, r) in cutoffs and values(s)[r] > cutoffs[where, r]]
        out.append((i, *s[:5], base(s), not base(s) and not broken, s[5], where, broken))
    return sorted(out, key=str), cutoffs


def _judgeable(n=900):
    rnd = random.Random(9)
    pad = (None,) * 6
    out, labels = [], []
    for i in range(n):
        bad = i % 6 == 0
        w = [rnd.choice(["alpha", "be", "gaḿma", "delta", "x"]) + ("###" if bad and i % 12 else "") + str(rnd.randrange(90)) for _ in range(rnd.randrange(40, 120))]
        if rnd.random() < 0.1:
            w = w[:30] + w[:30] + w
        text = " ".join(w).replace(" x1", "\nsame line\n", 3 if rnd.random() < 0.1 else 0)
        out.append((i, text, rnd.choice(["en", "en", "fr"]), "s", *pad))
        labels += [(i, int(not bad))] * (1 + i % 2)
    return out + rows_of_odd_documents(), labels + [(None, 1), (3, None), (5, 0)]


def test_quality_rules_are_brute_force(spark):
    data, labels = _judgeable()
    docs = spark.createDataFrame(data, odd_documents(spark).schema).repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality_rules.judge(docs, marks, stratum=F.col("lang"), risk=0.2, error=0.1)
    want, cutoffs = _judged(data, labels, lambda r: r[2] or "(none)", 0.2, 0.1)
    assert sorted([(*r[:10], list(r[10])) for r in rows(got)], key=str) == want
    assert {r for _, r in cutoffs} >= {"symbols"} and any(not w[6] and not w[7] for w in want)


def test_allowed_is_the_exact_binomial_bound(spark):
    table = spark.createDataFrame([(n,) for n in (0, 1, 30, 298, 299, 300, 1000, 5000)], "n long")
    got = dict(rows(table.select("n", quality_rules._allowed(F.col("n"), 0.01, F.lit(0.05)))))
    for n, k in got.items():
        assert (k < 0 or _tail(n, k, 0.01) <= 0.05) and _tail(n, k + 1, 0.01) > 0.05
    # Far beyond where probabilities underflow.
    k = rows(spark.range(1).select(quality_rules._allowed(F.lit(1_000_000).cast("long"), 0.01, F.lit(0.05))))[0][0]
    assert 9800 < k < 9850


def test_quality_rules_without_labels_or_documents(spark):
    marks = spark.createDataFrame([], "doc_id long, quality int")
    got = rows(quality_rules.judge(odd_documents(spark), marks).select("doc_id", "base_failed", "kept"))
    assert len(got) == len(rows_of_odd_documents()) and all(k != b for _, b, k in got)
    assert quality_rules.judge(no_documents(spark), marks).count() == 0
