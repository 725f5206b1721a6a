"""Multi-start K-means against a plain loop, and the bounded vocabulary against full counts."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseflow.operators import kmeans as km
from caseflow.operators import themes as th


def vectors(n, terms, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        idx = sorted(rng.sample(range(terms), rng.randrange(0, 6)))
        out.append((f"D{i}", idx, [rng.randrange(1, km.SCALE) for _ in idx]))
    return out + [("D0b", out[0][1], out[0][2]), (None, out[1][1], out[1][2])]


def plain_seed(rows, k, start):
    dense = [dict(zip(idx, w)) for _, idx, w in rows]
    chosen = []
    for step in range(k):
        best = None
        for (name, idx, w), x in zip(rows, dense):
            h = int(hashlib.md5(f"{name or ''}:{start}:{step}".encode()).hexdigest()[:13], 16)
            u = (h + 0.5) / 2**52
            if step:
                far = min(sum((x.get(i, 0) - c.get(i, 0)) ** 2 for i in x.keys() | c.keys()) for c in chosen)
                race = -math.log(u) / far if far else math.inf
            else:
                race = u
            key = (race, name is not None, name or "", idx, w)
            best = min(best or (key, x), (key, x), key=lambda b: b[0])
        chosen.append(best[1])
    return chosen


def plain_lloyd(rows, centres, tol):
    dense = [dict(zip(idx, w)) for _, idx, w in rows]

    def distance(x, c):
        return sum((x.get(i, 0) - c.get(i, 0)) ** 2 for i in x.keys() | c.keys())

    while True:
        own = [min(range(len(centres)), key=lambda c: (distance(x, centres[c]), c)) for x in dense]
        cost = sum(distance(x, centres[c]) for x, c in zip(dense, own))
        moved = []
        for c, old in enumerate(centres):
            mine = [x for x, o in zip(dense, own) if o == c]
            if not mine:
                moved.append(old)
                continue
            total = {}
            for x in mine:
                for i, w in x.items():
                    total[i] = total.get(i, 0) + w
            moved.append({i: (2 * t + len(mine)) // (2 * len(mine)) for i, t in total.items()})
        if max(distance(a, b) for a, b in zip(moved, centres)) <= math.floor((tol * km.SCALE) ** 2):
            return centres, cost, own
        centres = moved


@pytest.mark.parametrize("block", [7, 200_000])
def test_all_starts_equal_a_plain_loop(spark, monkeypatch, block):
    monkeypatch.setattr(km, "BLOCK", block)
    rows, terms, k = vectors(80, 30, 1), 30, 5
    points = spark.createDataFrame(rows, "id string, idx array<int>, w array<int>").repartition(6)
    seeds = km.first_centres(points, k, terms, 3, seed=7)
    final, costs = km.lloyd(points, seeds)
    for s in range(3):
        want = plain_seed(rows, k, 7 + s)
        assert [{i: int(v) for i, v in enumerate(seeds[s, c]) if v} for c in range(k)] == [{i: v for i, v in c.items() if v} for c in want]
        centres, cost, _ = plain_lloyd(rows, want, 1e-4)
        assert costs[s] == cost
        assert [{i: int(v) for i, v in enumerate(final[s, c]) if v} for c in range(k)] == [{i: v for i, v in c.items() if v} for c in centres]
    best = km.best_start(points, k, terms, 3, seed=7)
    _, _, own = min((plain_lloyd(rows, plain_seed(rows, k, 7 + s), 1e-4) for s in range(3)), key=lambda r: r[1])
    got = {(r["id"], tuple(r["idx"])): r["cluster"] for r in km.assign(points, best).collect()}
    assert got == {(name, tuple(idx)): c for (name, idx, _), c in zip(rows, own)}


@pytest.mark.parametrize("steps", [{0}, {1, 2}, {2, 4}])
def test_bounds_from_staged_distances_change_nothing(spark, monkeypatch, steps):
    """Later steps measure only points that the bounds leave open, with the result of measuring all."""
    rows, terms, k = vectors(300, 25, 5), 25, 4
    points = spark.createDataFrame(rows, "id string, idx array<int>, w array<int>").repartition(3)
    seeds = km.first_centres(points, k, terms, 2, seed=3)
    monkeypatch.setattr(km, "MARKED", frozenset())
    all_centres, all_costs = km.lloyd(points, seeds)
    monkeypatch.setattr(km, "MARKED", frozenset(steps))
    centres, costs = km.lloyd(points, seeds)
    assert (centres == all_centres).all() and costs == all_costs


def test_only_points_near_a_bound_are_measured_again(monkeypatch):
    """Two far groups and centres that moved a little: one point between them is open, and it changes its centre."""
    w = np.array([1000.0, 1100.0, 1480.0, 2000.0])
    points = km.Points(np.zeros(4, np.int64), w, np.ones(4, np.int64))
    before, now = np.array([[[1000.0], [2000.0]]]), np.array([[[990.0], [1930.0]]])
    far = np.abs(w[:, None] - before[0, :, 0]).astype(np.float32)[:, None, :]
    measured = []
    distances = km.Points.distances
    monkeypatch.setattr(km.Points, "distances", lambda self, c: measured.extend(self.w) or distances(self, c))
    own = km._own(points, far, far.argmin(axis=2), now, np.abs(now - before).sum(axis=2))
    assert own[:, 0].tolist() == [0, 0, 1, 1] and measured == [1480.0]


def test_fewer_different_points_than_clusters(spark):
    points = spark.createDataFrame([("a", [0], [5]), ("b", [0], [5]), ("c", [], [])], "id string, idx array<int>, w array<int>")
    best = km.best_start(points, 4, 2, 2)
    assert {r["id"]: r["cluster"] for r in km.assign(points, best).collect()}.keys() == {"a", "b", "c"}
    assert np.abs(best).max() == 5


@pytest.mark.parametrize("buckets,heavy", [(2**18, 4), (16, 1), (64, 1)])
def test_bounded_vocabulary_equals_full_counts(spark, monkeypatch, buckets, heavy):
    """Few buckets mix rare terms with frequent ones, so buckets must be added to prove the result."""
    monkeypatch.setattr(th, "BUCKETS", buckets)
    monkeypatch.setattr(th, "HEAVY_PER_TERM", heavy)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(200)]
    texts = [(f"T{i}", " ".join(rng.choices(words, weights=[1 / (j + 1) for j in range(200)], k=rng.randrange(3, 60)))) for i in range(60)]
    df = spark.createDataFrame([(i, t, "") for i, t in texts], "ticket_id string, customer_message string, agent_notes string")
    terms = th.with_bigrams(th.staged_tokens(df, []))
    full = sorted((r["term"], r["document_frequency"], r["corpus_frequency"]) for r in th.vocabulary(terms, 2, 10).collect())
    kept, n_docs = th.heavy_vocabulary(terms, 2, 10)
    assert [r[:3] for r in kept] == full and n_docs == th.usable_texts(df).count()
    assert len(th.heavy_vocabulary(terms, 2, 100_000)[0]) == th.vocabulary(terms, 2, 100_000).count()
    assert th.heavy_vocabulary(terms.limit(0), 2, 10) == ([], 0)


def test_vocabulary_is_counted_in_the_tasks_from_words(spark, monkeypatch):
    """Words with their bigrams give what lists of all terms give, also beside counts that were put together before."""
    monkeypatch.setattr(th, "BUCKETS", 50)
    monkeypatch.setattr(th, "HEAVY_PER_TERM", 1)
    monkeypatch.setattr(th, "BLOCK_TOKENS", 30)
    rng = random.Random(11)
    texts = [[rng.choice(["aa", "bb", "cc", "dä", "日本", "ee", "ff"]) for _ in range(rng.randrange(12))] for _ in range(60)] + [[]]
    tokens = spark.createDataFrame([(t,) for t in texts], "tokens array<string>").repartition(3)
    plan = th.bucket_totals(tokens)[0]
    assert plan.sum() == sum(max(2 * len(t) - 1, 0) for t in texts)
    want = {(r["term"], r["document_frequency"], r["corpus_frequency"]) for r in th.vocabulary(th.with_bigrams(tokens), 2, 12).collect()}
    kept, n_docs = th.heavy_vocabulary(tokens, 2, 12)
    assert {r[:3] for r in kept} == want and n_docs == len(texts)
    single, joint = tokens.limit(0), th.with_bigrams(tokens.withColumn("id", F.monotonically_increasing_id())).select("id", F.explode("terms").alias("term"))
    joint = joint.groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"))
    assert {r[:3] for r in th.heavy_vocabulary(single, 2, 12, joint, len(texts))[0]} == want
