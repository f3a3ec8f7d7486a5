"""Incremental ingestion on Structured Streaming: each file once, keys once per source within a lookback, table appends that may repeat."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.articles import new_rows
from tidemark.plans.store import Champion
from tidemark.sources.landing import RECORD, TABLE, typed
from tidemark.sources.tables import Snapshots


def stream(spark: SparkSession, root: str, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(RECORD).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_trigger).json(root)


def fresh(records: DataFrame, lookback: str = "3 days") -> DataFrame:
    """First record of each (source, key) within the lookback; older ones land again. State is bounded by the watermark on the fetch time."""
    return typed(records).withWatermark("fetched_at", lookback).dropDuplicatesWithinWatermark(["source", "article_key"])


def hourly_coverage(records: DataFrame, late: str = "2 hours") -> DataFrame:
    return typed(records).withWatermark("fetched_at", late).groupBy(F.window("fetched_at", "1 hour"), "source").agg(F.count("*").alias("articles"))


def merge_into(store: Snapshots, checkpoint: str):
    """A foreachBatch sink: adds keys that the table has not. What it did is noted in the same version, so a batch that runs again is passed over.

    Batches are known by the id that the stream has in its checkpoint; one that starts anew with a new checkpoint adds nothing twice either, as keys are met.
    """

    def sink(batch: DataFrame, number: int) -> None:
        with store.writer() as t:
            stream_id = json.loads(store.files.read(f"{checkpoint}/metadata"))["id"]
            if t.now["marks"].get(f"stream-{stream_id}", -1) >= number:
                return
            t.append(TABLE, new_rows(batch, t.read(TABLE, batch.schema), "article_key", "fetched_at"))
            t.mark(f"stream-{stream_id}", number)

    return sink


def run_available(spark: SparkSession, root: str, store: Snapshots, checkpoint: str) -> None:
    """Takes all files that are there and ends."""
    q = fresh(stream(spark, root)).writeStream.foreachBatch(merge_into(store, checkpoint)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def run_every(spark: SparkSession, root: str, store: Snapshots, checkpoint: str, interval: str = "1 hour"):
    """The same as a standing query, a micro-batch each interval; returns the query."""
    return fresh(stream(spark, root)).writeStream.foreachBatch(merge_into(store, checkpoint)).option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()


def score_into(champion: Champion, store: Snapshots, table: str, checkpoint: str):
    """A foreachBatch sink that scores article_key and text with the champion of the moment: the alias is looked up before each batch (a Champion with ttl 0).

    A promotion shows in the next batch; where the new champion can't be loaded, the one at hand goes on. Each row names the model that scored it.
    """

    def sink(batch: DataFrame, number: int) -> None:
        model = champion.get()
        scored = model.predict(batch).select("article_key", "prediction", "confidence", F.lit(champion.name).alias("model_id"))
        with store.writer() as t:
            stream_id = json.loads(store.files.read(f"{checkpoint}/metadata"))["id"]
            if t.now["marks"].get(f"stream-{stream_id}", -1) >= number:
                return
            t.append(table, scored)
            t.mark(f"stream-{stream_id}", number)

    return sink
