import json
import random

import numpy as np
import pytest

from tidemark.functions import features
from tidemark.functions import python as P
from tidemark.functions.columns import fold
from tidemark.operators import checks, similar, splits
from tidemark.operators import evaluation as E
from tidemark.operators.models import Majority, TfIdfMargins, latency_ms, local_scorer


def slow_clusters(rows, limit=None):
    """Components of titles that share a band of their MinHash signature and are similar enough."""
    first = {}
    for key, folded in sorted(rows):
        first.setdefault(folded, key)
    grams = {t: {t[k : k + 4] for k in range(max(1, len(t) - 3))} if t else set() for t in first}
    sig = {t: P.minhash([*g]) for t, g in grams.items()}
    label, pairs, good = {t: k for t, k in first.items()}, set(), set()
    for b in range(32):
        buckets = {}
        for t in first:
            buckets.setdefault(tuple(sig[t][4 * b : 4 * b + 4]), []).append(t)
        for own in buckets.values():
            if limit is None or len(own) <= limit:
                pairs |= {(x, y) for x in own for y in own if first[x] < first[y]}
    for x, y in pairs:
        if len(grams[x] | grams[y]) == 0 or len(grams[x] & grams[y]) >= 0.5 * len(grams[x] | grams[y]):
            good.add((x, y))
    for _ in first:
        before = dict(label)
        for x, y in good:
            label[x] = label[y] = min(label[x], label[y])
        if before == label:
            break
    return {k: label[t] for k, t in rows}, len(pairs), len(good)


def test_clusters_with_large_buckets(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    stem, other = "the long opening of a daily letter to all readers", "quite another opening that many titles have in common too"
    rows = [(f"k{k:03d}", f"{stem} {word()}") for k in range(40)] + [(f"m{k:03d}", f"{other} {word()} {word()}") for k in range(30)] + [(f"z{k}", word() * 3) for k in range(10)]
    df = spark.createDataFrame(rows, "key string, title string")
    folded = [(r.key, r.f) for r in df.select("key", fold(df.title).alias("f")).collect()]
    for limit in (5, 50):
        want, _, _ = slow_clusters(folded)
        assert {r.key: r.cluster_id for r in similar.cluster(df, bucket=(2, limit)).collect()} == want
    assert {r.key: r.cluster_id for r in similar.cluster(df, bucket=(2, 5), large=False).collect()} == slow_clusters(folded, 5)[0]
    want, pairs, good = slow_clusters(folded)
    r = similar.cluster_report(df).first()
    sizes = [n for n in np.unique(list(want.values()), return_counts=True)[1] if n > 1]
    assert (r.candidate_pairs, r.confirmed_pairs, r.clusters, r.rows_in_a_cluster, r.largest) == (pairs, good, len(sizes), sum(sizes), max(sizes))
    assert r.false_candidate_rate == pytest.approx(1 - good / pairs)


def test_bootstrap_draws_whole_clusters(spark):
    rnd = random.Random(5)
    rows = []
    for c in range(60):
        for _ in range(rnd.randint(1, 4)):
            t = rnd.choice("ab")
            rows.append((t, t if rnd.random() < 0.7 else "a", t if rnd.random() < 0.8 else "b", c))
    got = E.paired_bootstrap(spark.createDataFrame(rows, "y_true string, champion string, challenger string, cluster int"), resamples=4000)

    def f1(rows, k):
        out = []
        for v in {r[0] for r in rows}:
            hit, true, pred = (sum(f(r) for r in rows) for f in (lambda r: r[0] == r[k] == v, lambda r: r[0] == v, lambda r: r[k] == v))
            out.append(2 * hit / (true + pred))
        return sum(out) / len(out)

    by = [[r for r in rows if r[3] == c] for c in range(60)]
    deltas = []
    for _ in range(1500):
        drawn = [r for _ in by for r in by[rnd.randrange(60)]]
        deltas.append(f1(drawn, 2) - f1(drawn, 1))
    assert got["delta"] == pytest.approx(f1(rows, 2) - f1(rows, 1))
    assert got["lower"] == pytest.approx(np.quantile(deltas, 0.025), abs=0.02) and got["upper"] == pytest.approx(np.quantile(deltas, 0.975), abs=0.02)


def test_local_scorer_agrees_with_spark(spark):
    rnd = random.Random(6)
    words = {"sport": "bola gol pemain liga tim".split(), "money": "rupiah bank saham pasar harga".split(), "law": "polisi hakim sidang kasus jaksa".split()}
    rows = [(" ".join(rnd.choice(words[v] + ["dan", "di", "Yang"]) for _ in range(rnd.randint(1, 9))), v) for v in words for _ in range(15)]
    m = TfIdfMargins(rounds=8)
    df = spark.createDataFrame(rows, "text string, label string")
    m.fit(df)
    m.temperature = 0.7
    score = local_scorer(m)
    for r in m.predict(spark.createDataFrame([*rows, ("", "x"), ("Bola, BOLA!  é\tbank", "x")], "text string, label string")).collect():
        name, p = score(r.text)
        assert p == pytest.approx(r.confidence, abs=1e-9) and name == r.prediction
    assert latency_ms(score, [t for t, _ in rows])["p95_ms"] < 300
    one = Majority()
    one.fit(df)
    assert local_scorer(one)("any") == (one.label, one.share)


def test_only_title_and_summary_are_features(spark):
    df = spark.createDataFrame([("t", "s", "k")], "title string, summary string, kanal string")
    assert features.guarded(df, "title", "summary").columns == ["title", "summary"]
    for bad in ("kanal", "source", "raw_link"):
        with pytest.raises(features.ForbiddenField):
            features.guarded(df, "title", bad)
    assert features.feature_hash() == features.feature_hash() and len(features.feature_hash()) == 16


def test_checks_pass_fail_and_block(spark):
    fct = spark.sql("""SELECT * FROM VALUES ('a', 'src0', 'src0:x', TIMESTAMP_NTZ '2026-01-01 10:00:00', TIMESTAMP_NTZ '2026-01-01 11:00:00', false),
        ('b', 'src1', 'src1:x', TIMESTAMP_NTZ '2025-10-01 10:00:00', TIMESTAMP_NTZ '2026-01-01 08:00:00', true) AS t(article_key, source, feed_id, published_at, fetched_at, url_leaks_label)""")
    labelled = spark.sql("SELECT 'src0' AS source, 'x' AS channel, false AS taxonomy_missing")
    got = {c.name: c for c in checks.run(fct, labelled, ["src0", "src1"], ["src0:x", "src1:x", "src2:x"], "2026-01-01 12:00:00")}
    assert got["every_expected_source_reported"].metadata == {"missing": ["src1"]} and not got["every_expected_source_reported"].passed
    assert got["article_keys_are_unique"].passed and got["article_keys_are_unique"].metadata == {"total": 2, "distinct": 2}
    assert got["no_feed_has_gone_silent"].metadata == {"absent": ["src2:x"], "abandoned": ["src1:x"]}
    assert got["at_least_one_low_leakage_source"].metadata == {"sources": {"src0": 0.0}}
    assert got["taxonomy_covers_every_channel"].passed and got["no_future_publication_dates"].passed and checks.enforce(list(got.values()))
    bad = checks.run(fct.union(fct), labelled.selectExpr("source", "channel", "true AS taxonomy_missing"), ["src0"], [], "2026-01-01 12:00:00")
    with pytest.raises(checks.Blocked, match="article_keys_are_unique, taxonomy_covers_every_channel, sources_are_all_registered"):
        checks.enforce(bad)


def test_split_manifest(spark, tmp_path):
    rows = spark.createDataFrame([(f"a{k}", f"c{k // 2}", "s", "k") for k in range(200)], "article_key string, cluster_id string, source string, kanal string")
    split = splits.random_split(rows)
    m = splits.SplitManifest.of(split, {"seed": 42})
    assert sum(m.rows.values()) == 200 and sum(m.clusters.values()) == 100 and 110 < m.rows["train"] < 170
    m.write(str(tmp_path / "m.json"))
    assert json.loads((tmp_path / "m.json").read_text())["content_hash"] == m.content_hash and m.content_hash[:12] in m.summary()
    assert splits.keys(split, "val").count() == m.rows["val"]


def test_html_text():
    assert P.plain_html("<a href='x>y'>t</a>&lt;b <!-- gone --> <DIV>c</DIV>") == "t<b   c"
    assert P.plain_html("<script>a<b&amp;</script>z<style>p</style>") == "a<b&amp;zp"
    assert P.plain_html("1 < 2 & 3") == "1 < 2 & 3" and P.plain_html("a<br/>b</p>c<x") == "a bc<x"
