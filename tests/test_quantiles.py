import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quantiles as Q

SHARES = [0.0, 0.05, 0.5, 0.95, 1.0]


def both(spark, rows, by):
    df = spark.createDataFrame(rows, "g string, h int, x double, n int")
    got = Q.exact_quantiles(df, by, "x", SHARES)
    want = df.groupBy(*by).agg(F.percentile("x", F.array(*[F.lit(s) for s in SHARES])).alias("q"))
    show = lambda f: sorted(((tuple(r[c] for c in by), None if r["q"] is None else [round(v, 9) for v in r["q"]]) for r in f.collect()), key=str)
    return show(got), show(want)


@pytest.mark.parametrize("splits,few,most", [(64, 2048, 50_000), (4, 3, 50_000), (3, 2, 0)])
def test_is_percentile(spark, monkeypatch, splits, few, most):
    """One group holds two thirds of the rows; others are tied, single, null or empty of values."""
    for name, v in (("SPLITS", splits), ("FEW", few), ("BROADCAST_TARGETS", most)):
        monkeypatch.setattr(Q, name, v)
    rng = random.Random(splits)
    rows = [("hot", 1, rng.choice([rng.gauss(0, 1e6), float(rng.randrange(9)), -1e300]), 1) for _ in range(400)]
    rows += [(rng.choice(["a", "b", None]), rng.randrange(2), rng.choice([None, 1.5, rng.random()]), 1) for _ in range(150)] + [("tied", 0, 7.0, 1)] * 40 + [("one", 0, -0.0, 1), ("none", 0, None, 1)]
    got, want = both(spark, rows, ["g"])
    assert got == want
    got, want = both(spark, rows, ["g", "h"])
    assert got == want


def test_no_group_and_no_rows(spark):
    got, want = both(spark, [("a", 1, float(k), 1) for k in (5, 1, 4)], [])
    assert got == want
    assert both(spark, [], ["g"])[0] == []
