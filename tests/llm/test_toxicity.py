import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import toxicity

WORDS = "lorem ipsum dolor amet sit tempor magna aliqua enim minim quis nostrud".split()


@pytest.fixture(scope="module")
def tables(spark):
    rnd = random.Random(3)
    docs, labels = [], []
    for k in range(400):
        words = [rnd.choice(WORDS) for _ in range(rnd.randint(5, 80))]
        toxic = rnd.random() < 0.3
        if toxic:
            words.insert(rnd.randrange(len(words)), rnd.choice(["Blockhead", "numbskull"]))
        docs.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    docs += [(1000, None), (1001, ""), (1002, "blockhead " * 50_000), (None, "plain ipsum dolor"), (5, docs[5][1])]
    labels += [(5, labels[5][1]), (7, None), (None, 1), (2000, 1)]
    return spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS y", "2 AS score"), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels[:400])


def test_held_out_accuracy_and_cases(tables):
    docs, labels, truth = tables
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == 405
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {d for d in [*range(400), 1000, 1001, 1002] if zlib.crc32(str(d).encode()) % 5 == 0}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held if r.doc_id in truth]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert {r.doc_id: r.predicted for r in got}[1002] == 1
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.score < 0.5 for r in got)


def test_labels_of_held_out_rows_do_not_count(tables):
    docs, labels, _ = tables
    flipped = labels.withColumn("toxic", toxicity.held_out(labels.doc_id).cast("int"))
    model = toxicity.train(docs, flipped)
    assert not model.weight.any() and model.score("anything") == 0.5


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.train(docs, labels)).count() == 0


def test_features_against_plain_code():
    text = "Ab\n cé  x"
    raw = b" ab c\xc3\xa9 x "
    want = {((int.from_bytes(raw[k : k + n], "big") * ((0x9E3779B97F4A7C15 + 2 * n) % 2**64)) % 2**64) >> 44 for n in (3, 4, 5) for k in range(len(raw) - n + 1)}
    assert set(toxicity.features(text).tolist()) == want


def slow_score(docs, labels, texts, kept, rounds, penalty):
    """The scores by plain Python: presence counts, ratios, chi-square, accelerated gradient steps."""

    def grams(text):
        raw = b" " + b" ".join((text or "").encode().lower().split()) + b" "
        return {((int.from_bytes(raw[k : k + n], "big") * ((0x9E3779B97F4A7C15 + 2 * n) % 2**64)) % 2**64) >> 44 for n in (3, 4, 5) for k in range(len(raw) - n + 1)}

    known = [(grams(docs[d]), y) for d, y in labels if d in docs and y in (0, 1) and zlib.crc32(str(d).encode()) % 5]
    n = Counter(y for _, y in known)
    count = {y: Counter(f for x, label in known if label == y for f in x) for y in (0, 1)}

    def chi(f):
        p, q = count[1][f], count[0][f]
        return (p * (n[0] - q) - q * (n[1] - p)) ** 2 * (n[0] + n[1]) / (n[0] * n[1] * (p + q) * max(n[0] + n[1] - p - q, 1))

    best = sorted({*count[0], *count[1]}, key=lambda f: (-chi(f), f))[:kept]
    r = {f: math.log((count[1][f] + 1) / (n[1] + 2) / ((count[0][f] + 1) / (n[0] + 2))) for f in best}
    rows = [([f for f in x if f in r], y) for x, y in known]
    share = {y: 0.5 / n[y] for y in (0, 1)}
    step = 1 / (0.25 * (sum(share[y] * sum(r[f] ** 2 for f in x) for x, y in rows) + 1) + penalty)
    w, ww, b, bb, t = dict.fromkeys(best, 0.0), dict.fromkeys(best, 0.0), 0.0, 0.0, 1.0
    for _ in range(rounds):
        slope, g0 = {f: penalty * ww[f] for f in best}, 0.0
        for x, y in rows:
            g = share[y] * (1 / (1 + math.exp(-sum(r[f] * ww[f] for f in x) - bb)) - y)
            g0 += g
            for f in x:
                slope[f] += g * r[f]
        w1, b1, t1 = {f: ww[f] - step * slope[f] for f in best}, bb - step * g0, (1 + math.sqrt(1 + 4 * t * t)) / 2
        ww, bb = {f: w1[f] + (t - 1) / t1 * (w1[f] - w[f]) for f in best}, b1 + (t - 1) / t1 * (b1 - b)
        w, b, t = w1, b1, t1
    return [1 / (1 + math.exp(-b - sum(w[f] * r[f] for f in grams(x) if f in r))) for x in texts]


def test_scores_against_a_slow_version(tables):
    docs, labels, _ = tables
    few = docs.where("doc_id < 60 AND doc_id <> 5 OR doc_id >= 1000")
    model = toxicity.train(few, labels, kept=300, rounds=12)
    texts = {r.doc_id: r.text for r in few.collect() if r.doc_id is not None}
    got = {r.doc_id: r.score for r in toxicity.score(few, model).collect() if r.doc_id is not None}
    want = slow_score(texts, [(r.doc_id, r.toxic) for r in labels.collect() if r.doc_id is not None], list(texts.values()), 300, 12, toxicity.PENALTY)
    pairs = {d: s for d, s in zip(texts, want, strict=True)}
    assert all(abs(got[d] - pairs[d]) < 1e-9 for d in texts)


def test_the_fit_is_bounded_by_values_too(tables):
    docs, labels, truth = tables
    model = toxicity.train(docs, labels, fit_values=20_000)
    held = [r for r in toxicity.score(docs, model).collect() if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.9


def test_one_class_drops_nothing(tables):
    docs, labels, _ = tables
    assert toxicity.keep_clean(docs, toxicity.train(docs, labels.where("toxic = 1"))).count() == docs.count()
