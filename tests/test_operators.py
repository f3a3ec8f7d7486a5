import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import articles as A
from tidemark.operators import evaluation as E
from tidemark.operators import similar, splits
from tidemark.operators.graph import components
from tidemark.operators.models import Majority, TfIdfMargins
from tidemark.plans import dag
from tidemark.plans.store import AliasNotSet, Champion, FeatureMismatch, Registry


def test_scores(spark):
    rows = spark.createDataFrame(list(zip("pppee", "ppeep")), "y_true string, y_pred string")
    s = {r.label: r for r in E.class_scores(E.confusion(rows)).collect()}
    assert s["p"].f1 == pytest.approx(2 / 3) and s["e"].f1 == pytest.approx(1 / 2)
    m = E.summary(E.confusion(rows), 8).first()
    assert m.macro_f1 == pytest.approx(7 / 12) and m.accuracy == pytest.approx(3 / 5) and m.classes_absent == 6
    never = spark.createDataFrame([("a", "a")] * 97 + [("b", "a")] * 3, "y_true string, y_pred string")
    m = E.summary(E.confusion(never)).first()
    assert m.accuracy == 0.97 and m.macro_f1 < 0.5
    with pytest.raises(ValueError):
        E.checked(rows.limit(0))


def test_calibration(spark):
    sure = spark.createDataFrame([(1.0, k % 2 == 0) for k in range(100)], "confidence double, correct boolean")
    assert E.calibration_error(E.calibration_bins(sure)) == pytest.approx(0.5)
    two = spark.createDataFrame([(0.9, True)] * 50 + [(0.95, True)] * 50, "confidence double, correct boolean")
    bins = E.calibration_bins(two, 10).collect()
    assert len(bins) == 2 and all(b.lower == b.upper for b in bins)
    rnd = random.Random(1)
    many = [(rnd.random(), rnd.random() < 0.5) for _ in range(300)]
    got = E.calibration_bins(spark.createDataFrame(many, "confidence double, correct boolean"), 15).collect()
    assert len(got) <= 16 and max(b.n for b in got) - min(b.n for b in got) <= 5
    with pytest.raises(ValueError):
        E.calibration_bins(spark.createDataFrame([(1.5, True)], "confidence double, correct boolean"))
    logits = np.array([[4.0, 0.0], [4.0, 0.0], [0.0, 4.0], [4.0, 0.0]])
    assert E.fit_temperature(logits, np.array([0, 0, 1, 1])) > 1


def test_significance(spark):
    assert E.mcnemar_p(6, 0) == pytest.approx(2 / 64) and E.mcnemar_p(5, 0) == pytest.approx(2 / 32) and E.mcnemar_p(15, 5) == pytest.approx(0.0413895, abs=1e-6) and E.mcnemar_p(0, 0) == 1
    rnd = random.Random(2)
    rows = [(rnd.choice("ab"), rnd.choice("ab"), k // 3) for k in range(300)]
    same = spark.createDataFrame([(t, p, p, c) for t, p, c in rows], "y_true string, champion string, challenger string, cluster int")
    r = E.paired_bootstrap(same, resamples=200)
    assert r["lower"] == r["upper"] == r["delta"] == 0
    better = spark.createDataFrame([(t, p, t, c) for t, p, c in rows], "y_true string, champion string, challenger string, cluster int")
    r = E.paired_bootstrap(better, resamples=200)
    assert 0.2 < r["lower"] < r["delta"] < r["upper"]
    assert r == E.paired_bootstrap(better.repartition(3), resamples=200)


def test_gate():
    ok = {"ece": 0.08, "p95_ms": 300, "cost_per_1k": 0.1, "f1": {"a": 0.9}}
    old = {"cost_per_1k": 0.05, "f1": {"a": 0.9}}
    good = {"lower": 0.02, "p": 0.01}
    assert E.gate(ok, None, None, "h", 150, 0)[0] == "PROMOTE"
    assert E.gate(ok, good, old, "h", 150, 1)[0] == "REJECT" and E.gate(ok, good, old, None, 150, 0)[0] == "HOLD" and E.gate(ok, good, old, "h", 149, 0)[0] == "HOLD"
    assert E.gate(ok | {"split_hash": "x"}, good, old, "h", 150, 0)[0] == "REJECT"
    assert E.gate(ok | {"ece": 0.081}, good, old, "h", 150, 0)[0] == "REJECT"
    assert E.gate(ok, {"lower": 0.02, "p": 0.06}, old, "h", 150, 0)[0] == "HOLD" and E.gate(ok, {"lower": 0.01, "p": 0.01}, old, "h", 150, 0)[0] == "HOLD"
    assert E.gate(ok | {"f1": {"a": 0.84}}, good, old, "h", 150, 0)[0] == "REJECT"
    assert E.gate(ok, good, old, "h", 150, 0, hours_since_promotion=71)[0] == "HOLD" and E.gate(ok, good, old, "h", 150, 0, hours_since_promotion=71, slo_violated=True)[0] == "PROMOTE"
    assert E.gate(ok | {"cost_per_1k": 0.2}, None, None, "h", 150, 0)[0] == "REJECT"


def test_splits(spark):
    t = dt.datetime(2026, 7, 30)
    at = lambda days: t - dt.timedelta(days=days)
    rows = [("a", "1", at(14)), ("b", "2", at(13.99)), ("c", "3", at(20)), ("d", "3", at(2)), ("e", "4", at(0)), ("f", "5", at(7))]
    df = spark.createDataFrame([(k, c, p, "s", "k") for k, c, p in rows], "article_key string, cluster_id string, published_at timestamp_ntz, source string, kanal string")
    got = splits.temporal_split(df)
    assert {r.article_key: r.split for r in got.collect()} == {"a": "train", "b": "val", "c": "test", "d": "test", "e": "test", "f": "val"}
    assert splits.spanning(got).count() == 1 and splits.cluster_leaks(got).count() == 0
    assert splits.content_hash(got, {"days": 14}) == splits.content_hash(got.repartition(3), {"days": 14}) != splits.content_hash(got, {"days": 7})
    for f in (splits.random_split, splits.exact_random_split):
        assert splits.cluster_leaks(f(df)).count() == 0
    assert any("provisional" in w for w in splits.warnings(got))
    with pytest.raises(ValueError):
        splits.temporal_split(df.limit(0))


def test_similar(spark):
    base = "pemerintah menaikkan harga bahan bakar minyak bersubsidi mulai pekan depan kata menteri"
    rows = [("k1", f"{base} satu"), ("k2", f"{base} dua"), ("k3", f"{base} tiga"), ("k4", "sesuatu yang lain sama sekali"), ("k5", f"{base.upper()} SATU!"), ("k6", "")]
    got = {r.key: r.cluster_id for r in similar.cluster(spark.createDataFrame(rows, "key string, title string")).collect()}
    assert got == {"k1": "k1", "k2": "k1", "k3": "k1", "k4": "k4", "k5": "k1", "k6": "k6"}
    many = spark.createDataFrame([(f"c{k:03d}", "the same title again") for k in range(80)], "key string, title string")
    assert similar.cluster(many).select("cluster_id").distinct().count() == 1
    pair = [("a", "Pemerintah naikkan cukai rokok tahun depan"), ("b", "Cukai Rokok Naik Lagi Mulai Januari")]
    titles = similar.written(similar.distinct_titles(spark.createDataFrame(pair, "key string, title string")), "titles")
    assert similar.candidate_pairs(titles).count() == 0


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(1, 41)) and got[101] == 100


def test_models(spark):
    rows = spark.createDataFrame([(f"bola gol pemain {k}", "sport") for k in range(20)] + [(f"rupiah bank saham {k}", "money") for k in range(12)], "text string, label string")
    m = Majority()
    with pytest.raises(RuntimeError):
        m.predict(rows)
    m.fit(rows)
    assert m.label == "sport" and m.share == 20 / 32 and m.unit_cost_usd(1000) == pytest.approx(8.3e-9)
    t = TfIdfMargins(rounds=5, features=500)
    t.fit(rows)
    got = t.predict(rows)
    assert got.where("prediction = label").count() == 32 and got.first().probabilities.keys() == {"money", "sport"}
    with pytest.raises(ValueError):
        TfIdfMargins().fit(rows.where("label = 'sport'"))


def test_registry(tmp_path):
    r = Registry(str(tmp_path))
    with pytest.raises(AliasNotSet):
        r.resolve()
    a, b = r.register({"m": 1, "feature_hash": "x"}), r.register({"m": 2, "feature_hash": "x"})
    assert a == r.register({"m": 1, "feature_hash": "x"}) != b
    r.apply(a, "PROMOTE", [])
    r.apply(b, "HOLD", ["why"])
    assert r.resolve() == a and [d["verdict"] for d in r.decisions(refused=True)] == ["HOLD"] and len(r.decisions(last=1)) == 1
    r.apply(b, "PROMOTE", [])
    assert r.rollback() == a == r.resolve()
    with pytest.raises(FeatureMismatch):
        r.meta(a, "y")
    now = [0.0]
    c = Champion(r, lambda n: json.dumps(n), clock=lambda: now[0])
    assert c.get() == json.dumps(a)
    r.promote(b)
    assert c.get() == json.dumps(a)
    now[0] = 61
    assert c.get() == json.dumps(b)


def test_export_and_lineage(spark, tmp_path):
    fct = dag.build(spark, "/root/testdata/sf0.001", "fct_articles")["fct_articles"]
    stats = A.export(fct, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out" / "articles.parquet"))
    assert back.columns == A.PUBLISHED and back.count() == stats["articles"] > 0 and str(stats["articles"]) in A.card(stats)
    with pytest.raises(ValueError):
        A.export(fct.limit(0), str(tmp_path / "none"))
    assert not dag.lineage_faults() and dag.order().index("stg_articles") < dag.order().index("fct_articles")
    assert dag.lineage_faults({"x": (("y",), None)})
    assert fct.where(F.col("is_cluster_representative")).count() == fct.select("cluster_id").distinct().count()
