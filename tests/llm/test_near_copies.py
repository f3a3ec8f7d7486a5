import random

import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm import near_copies


def grams(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def similar(a, b):
    return a == b or 10 * len(a & b) >= 8 * len(a | b)


def slow_first(rows):
    """Smallest id of each document's component."""
    sets, label = [grams(t) for _, t in rows], [d for d, _ in rows]
    for _ in rows:
        before = list(label)
        for i, a in enumerate(sets):
            for j in range(i):
                if label[i] != label[j] and similar(a, sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
        if label == before:
            break
    return label


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["Alpha", "beta", "gamma", "délta"]) + str(rnd.randint(0, 300))
    passage = " ".join(word() for _ in range(30))
    base = [" ".join(word() for _ in range(rnd.randint(40, 150))) for _ in range(8)]
    rows = [(k, t) for k, t in enumerate(base)]
    for k in range(90):
        w = rnd.choice(base[:3]).split()
        for _ in range(rnd.randint(0, 5)):
            w[rnd.randrange(len(w))] = word()
        rows.append((100 + k, " ".join(w)))
    rows += [(300 + k, " ".join(word() for _ in range(10)) + " " + passage) for k in range(40)]
    return rows + [(500, None), (501, ""), (502, " \n"), (503, "One"), (504, "one"), (505, "two words")]


@pytest.mark.parametrize("limit, often", [(64, 8), (3, 2), (1, 1)])
def test_against_brute_force(spark, monkeypatch, limit, often):
    monkeypatch.setattr(near_copies, "OFTEN", often)
    rows = corpus(limit)
    label = slow_first(rows)
    got = near_copies.clusters(spark.createDataFrame(rows, "doc_id long, text string"), group_limit=limit).collect()
    assert {r.doc_id: r.first for r in got} == {d: c for (d, _), c in zip(rows, label, strict=True)}
    assert 30 < len(set(label)) < len(rows) - 20


def test_pipeline_stage_takes_near_copies(spark):
    rows = corpus(9)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, df, "").collect()} == set(slow_first(rows))
    assert near_copies.clusters(df.limit(0)).count() == 0


def test_sketches_never_differ_in_more_bits_than_the_sets_in_shingles():
    rnd = np.random.default_rng(3)
    for n in (0, 1, 63, 64, 65, 300, 1000, 40_000):
        for m in (0, 1, 64, 290, 5000, 90_000):
            pool = np.unique(rnd.integers(-(1 << 63), (1 << 63) - 1, 2 * max(n, m) + 8))
            x, y = (np.sort(rnd.choice(pool, k, replace=False)) for k in (n, m))
            apart = len(np.setxor1d(x, y, assume_unique=True))
            found = near_copies.differing(near_copies.sketch(x), near_copies.sketch(y))
            assert found <= apart and found % 2 == apart % 2
            assert found == near_copies.differing(near_copies.sketch(y), near_copies.sketch(x))
    for n in (300, 1000, 9000):  # unrelated sets of like size need no look at the whole sets
        x, y = (np.unique(rnd.integers(-(1 << 63), (1 << 63) - 1, n)) for _ in range(2))
        assert near_copies.differing(near_copies.sketch(x), near_copies.sketch(y)) > (len(x) + len(y)) / 9
