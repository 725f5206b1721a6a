"""Exact skew-safe median against a brute-force median per group."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from caseflow.operators.median import exact_median


def _fixture(spark):
    rnd = random.Random(7)
    rows = []
    for g in range(30):
        key = f"g{g}" if g % 6 else None  # NULL keys form one group
        for _ in range(rnd.choice([1, 2, 3, 8, 41, 250])):
            rows.append((key, rnd.choice([None, rnd.random() * 10, float(rnd.randint(0, 4))])))
    # one hot group: a third of the rows, many ties
    n_hot = len(rows)
    rows += [("hot", rnd.gauss(5, 2)) for _ in range(n_hot)] + [("hot", 1.0)] * (n_hot // 2)
    rows += [("only_nulls", None)] * 3
    return rows, spark.createDataFrame(rows, "g string, v double")


def _brute(rows):
    by = {}
    for g, v in rows:
        by.setdefault(g, []).append(v)
    return {g: (statistics.median([v for v in vs if v is not None]) if any(v is not None for v in vs) else None) for g, vs in by.items()}


def test_exact_median_matches_brute_force(spark):
    rows, df = _fixture(spark)
    want = _brute(rows)
    got = {r["g"]: r for r in exact_median(df, ["g"], "v", "m", {"rows": F.lit(1)}).collect()}
    assert set(got) == set(want)
    for g, m in want.items():
        assert got[g]["rows"] == sum(1 for k, _ in rows if k == g)
        if m is None:
            assert got[g]["m"] is None
        else:
            assert got[g]["m"] == pytest.approx(m, abs=1e-12)
