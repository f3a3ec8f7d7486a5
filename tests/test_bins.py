import random

import pytest

from tidemark.operators import evaluation as E


def slow(rows, bins=15):
    """(lower, upper, n, hits) by a plain scan."""
    rows, out, target = sorted(rows), [], max(1, len(rows) // bins)
    while rows:
        k = min(target, len(rows))
        while k < len(rows) and rows[k][0] == rows[k - 1][0]:
            k += 1
        own, rows = rows[:k], rows[k:]
        out.append((own[0][0], own[-1][0], len(own), sum(ok for _, ok in own)))
    return out


@pytest.mark.parametrize("near", [200_000, 0])
@pytest.mark.parametrize("kind", ["smooth", "tied", "one", "few", "heavy"])
def test_bins(spark, monkeypatch, near, kind):
    monkeypatch.setattr(E, "NEAR_ROWS", near)
    rng = random.Random(kind)
    conf = {"smooth": lambda: rng.random(), "tied": lambda: round(rng.random(), 1), "one": lambda: 0.5, "few": lambda: rng.random(), "heavy": lambda: rng.choice([0.25, rng.random()])}[kind]
    rows = [(conf(), rng.random() < 0.6) for _ in range(7 if kind == "few" else 500)]
    got = E.calibration_bins(spark.createDataFrame(rows, "confidence double, correct boolean")).orderBy("bin").collect()
    assert [(r["lower"], r["upper"], r["n"], round(r["accuracy"] * r["n"])) for r in got] == slow(rows)
    assert [r["bin"] for r in got] == list(range(len(got)))


def test_errors(spark):
    for rows, said in (([], "nothing"), ([(1.5, True)], "outside"), ([(-0.1, True)], "outside")):
        with pytest.raises(ValueError, match=said):
            E.calibration_bins(spark.createDataFrame(rows, "confidence double, correct boolean"))
