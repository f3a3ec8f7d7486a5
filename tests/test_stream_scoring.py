import time

import pytest
from pyspark.sql import functions as F

from tidemark.plans.store import Champion, Registry
from tidemark.sources.tables import Snapshots
from tidemark.streaming import ingest


class Says:
    """A model that gives one answer."""

    def __init__(self, label):
        self.label = label

    def predict(self, rows):
        return rows.withColumns({"prediction": F.lit(self.label), "confidence": F.lit(1.0)})


@pytest.fixture
def stage(spark, tmp_path):
    registry, broken = Registry(str(tmp_path / "r")), set()
    names = {registry.register({"label": v}): v for v in ("old", "new", "bad")}

    def load(name):
        if name in broken:
            raise OSError("unreadable")
        return Says(names[name])

    return registry, {v: k for k, v in names.items()}, broken, Champion(registry, load, ttl=0), Snapshots(spark, str(tmp_path / "w"))


def put(spark, tmp_path, *keys):
    spark.createDataFrame([(k, f"text {k}") for k in keys], "article_key string, text string").coalesce(1).write.mode("append").json(str(tmp_path / "in"))


def wait(store, n):
    until = time.time() + 60
    while time.time() < until:
        got = {r["article_key"]: (r["prediction"], r["model_id"]) for r in store.read("scores").collect()} if store.version() else {}
        if len(got) >= n:
            return got
        time.sleep(0.3)
    raise AssertionError(f"{len(got)} of {n} rows came")


def test_promotion_shows_in_the_next_batch(spark, tmp_path, stage):
    registry, ids, broken, champion, store = stage
    registry.promote(ids["old"])
    put(spark, tmp_path, "1", "2")
    cp = str(tmp_path / "cp")
    stream = spark.readStream.schema("article_key string, text string").json(str(tmp_path / "in"))
    q = stream.writeStream.foreachBatch(ingest.score_into(champion, store, "scores", cp)).option("checkpointLocation", cp).trigger(processingTime="300 milliseconds").start()
    try:
        assert wait(store, 2) == {"1": ("old", ids["old"]), "2": ("old", ids["old"])}
        registry.promote(ids["new"])
        put(spark, tmp_path, "3")
        assert wait(store, 3)["3"] == ("new", ids["new"])
        broken.add(ids["bad"])
        registry.promote(ids["bad"])
        put(spark, tmp_path, "4")
        assert wait(store, 4)["4"] == ("new", ids["new"]) and champion.last_error == "unreadable" and champion.failed_reloads >= 1
    finally:
        q.stop()


def test_a_batch_that_runs_again_adds_nothing(spark, tmp_path, stage):
    registry, ids, _, champion, store = stage
    registry.promote(ids["old"])
    (tmp_path / "cp").mkdir()
    (tmp_path / "cp" / "metadata").write_text('{"id": "q1"}')
    sink = ingest.score_into(champion, store, "scores", str(tmp_path / "cp"))
    batch = spark.createDataFrame([("1", "t")], "article_key string, text string")
    for k in (0, 0, 1):
        sink(batch, k)
    assert store.read("scores").count() == 2 and store.version() == 2
