import datetime as dt

import pytest
from test_sources import record

from tidemark.operators import articles as A
from tidemark.plans import daily
from tidemark.sources import landing as L
from tidemark.sources.tables import Snapshots

SHAPE = "source string, channel string, kanal string, confidence string, notes string"


def rows(spark, *specs):
    """specs: key, story, day, source."""
    made = [record(k, source=s, title=f"t {story}", title_fingerprint=story, fetched=f"2026-07-{d:02d}T0{i % 8}:00:00+00:00", published_at=f"2026-07-{d:02d}T00:00:00+00:00") for i, (k, story, d, s) in enumerate(specs)]
    return spark.createDataFrame([{k: v for k, v in r.items() if k != "fetched"} | {"fetched_at": r.get("fetched", r["fetched_at"])} for r in made], L.RECORD)


def whole(store, taxonomy):
    fct = A.facts(A.labelled(A.deduped(A.staging(store.read("articles"))), taxonomy))
    return fct, A.source_health(fct), A.feed_health(fct)


def same(a, b):
    return sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect()))


def test_refresh_equals_a_full_rebuild(spark, tmp_path):
    root, store = str(tmp_path / "raw"), Snapshots(spark, str(tmp_path / "w"))
    taxonomy = spark.createDataFrame([("s", "c", "k", "high", None), ("r", "c", "other", "low", "n")], SHAPE)

    def step(*specs):
        L.land(rows(spark, *specs), root)
        L.load(spark, root, store)
        before = store.manifest()["tables"].get(daily.FACTS, {"folders": []})["folders"]
        days = daily.refresh(store, taxonomy)
        after = store.manifest()["tables"][daily.FACTS]["folders"]
        for got, want in zip((daily.facts(store), store.read(daily.SOURCE_HEALTH), store.read(daily.FEED_HEALTH)), whole(store, taxonomy), strict=True):
            assert same(got, want)
        return days, sorted(f.split("=")[-1] for f in after if f not in before)

    assert step(("1", "a", 1, "s"), ("2", "b", 1, "s"), ("3", "c", 2, "r"), ("4", "a", 3, "s"))[0] == ["2026-07-01", "2026-07-02", "2026-07-03"]
    assert step(("5", "new", 2, "s"), ("6", "fresh", 2, "r")) == (["2026-07-02"], ["2026-07-02"])  # its day only
    assert step(("7", "a", 4, "r")) == (["2026-07-01", "2026-07-03", "2026-07-04"],) * 2  # a story that others have
    assert daily.refresh(store, taxonomy) == [] and step(("7", "a", 4, "r"))[0] == []
    with store.writer() as t:
        t.replace("articles", t.read("articles").where("article_key <> '4'"))
    assert daily.refresh(store, taxonomy) == ["2026-07-01", "2026-07-02", "2026-07-04"]
    for got, want in zip((daily.facts(store), store.read(daily.SOURCE_HEALTH)), whole(store, taxonomy), strict=False):
        assert same(got, want)
    assert len(daily.refresh(store, taxonomy, full=True)) == 3


def test_nothing_loaded(spark, tmp_path):
    with pytest.raises(KeyError):
        daily.refresh(Snapshots(spark, str(tmp_path / "w")), spark.createDataFrame([], SHAPE))
