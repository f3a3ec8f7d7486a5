import random

import numpy as np
import pytest
from test_checks import slow_clusters

from tidemark.functions import python as P
from tidemark.functions.columns import fold
from tidemark.operators import similar


def titles(seed, count=60):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdé") for _ in range(rnd.randint(2, 5)))
    stem = " ".join(word() for _ in range(14))
    rows = [(f"k{k:03d}", f"{stem} {' '.join(word() for _ in range(rnd.randint(0, 16)))}") for k in range(count)]
    return rows + [("p", "Ab"), ("q", "ab!"), ("r", "abc"), ("s", ""), ("t", " "), ("u", "\U00010400\U00010401\U00010402\U00010403\U00010404")]


@pytest.mark.parametrize("block", [5, 8192])
def test_buckets_in_blocks_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(similar, "BLOCK", block)
    rows = titles(block)
    df = spark.createDataFrame(rows, "key string, title string")
    want = slow_clusters([(r.key, r.f) for r in df.select("key", fold(df.title).alias("f")).collect()])[0]
    assert {r.key: r.cluster_id for r in similar.cluster(df, bucket=(2, 3)).collect()} == want
    assert 8 < len(set(want.values())) < len(rows) - 8


def test_null_titles_are_blank_ones(spark):
    df = spark.createDataFrame([("a", None), ("b", ""), ("c", "some title"), ("d", None)], "key string, title string")
    assert {r.key: r.cluster_id for r in similar.cluster(df).collect()} == {"a": "a", "b": "a", "c": "c", "d": "a"}


def test_sketches_lose_no_pair():
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice(["ab", "cde", "fgh", "ijkl", "m"]) + rnd.choice("nopq") for _ in range(rnd.choice([3, 60, 200, 220]))) for _ in range(50)]
    sets = [P.char_grams(t) for t in texts]
    want = {(i, j) for i in range(50) for j in range(i + 1, 50) if 2 * len(sets[i] & sets[j]) >= len(sets[i] | sets[j])}
    n, compared = np.array([len(s) for s in sets]), 0
    for halves in ([range(50)], [range(0, 50, 2), range(1, 50, 2)]):
        sides = [similar.Side(np.array(h), n[list(h)], [texts[k] for k in h]) for h in map(list, halves)]
        found = {(min(a, b), max(a, b)) for a, b in similar.similar_pairs(sides, 50, 0.5, True)}
        assert found == {p for p in want if len(halves) == 1 or (p[0] + p[1]) % 2}
        compared += len(found)
    assert compared > 50


def test_candidates_of_the_report(spark):
    rows = [(k, t) for k, t in titles(7, 40)] + [("z", None)]
    df = spark.createDataFrame(rows, "key string, title string")
    want, pairs, good = slow_clusters([(k, f or "") for k, f in df.select("key", fold(df.title).alias("f")).collect()])
    r = similar.cluster_report(df).first()
    sizes = [n for n in np.unique(list(want.values()), return_counts=True)[1] if n > 1]
    assert (r.candidate_pairs, r.confirmed_pairs, r.clusters, r.rows_in_a_cluster) == (pairs, good, len(sizes), sum(sizes))


@pytest.mark.parametrize("block", [30, 8192])
def test_report_counts_pairs_of_large_buckets(spark, monkeypatch, block):
    """F2 of round 4: buckets of over 50 titles were not counted."""
    monkeypatch.setattr(similar, "BLOCK", block)
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    rows = [(f"m{k:03d}", f"the long opening of a daily letter to all readers {' '.join(word() for _ in range(k % 9))} {word()}") for k in range(120)] + titles(8, 20)
    df = spark.createDataFrame(rows, "key string, title string")
    want, pairs, good = slow_clusters([(r.key, r.f) for r in df.select("key", fold(df.title).alias("f")).collect()])
    r = similar.cluster_report(df).first()
    sizes = [n for n in np.unique(list(want.values()), return_counts=True)[1] if n > 1]
    assert (r.candidate_pairs, r.confirmed_pairs, r.clusters, r.rows_in_a_cluster, r.largest) == (pairs, good, len(sizes), sum(sizes), max(sizes))
    assert 50 * 49 / 2 < good < pairs and r.false_candidate_rate == pytest.approx(1 - good / pairs)


def test_report_of_no_titles(spark):
    r = similar.cluster_report(spark.createDataFrame([], "key string, title string")).first()
    assert (r.candidate_pairs, r.confirmed_pairs, r.clusters, r.rows_in_a_cluster, r.largest, r.false_candidate_rate) == (0, 0, 0, 0, 0, 0.0)
