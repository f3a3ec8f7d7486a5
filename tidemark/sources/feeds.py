"""Feeds as a Python data source: `spark.read.format("feeds")` polls once, `spark.readStream.format("feeds")` once a micro-batch.

Options: `feeds` (JSON list of source, channel, kanal, url), `state` (file of validators and breakers, for conditional requests), `delay` (seconds
between requests), `retries`, `base` (seconds of the first pause before a retry); of a stream also `log`, the folder in which each cycle's answers are kept.
The files lie where driver and executors see them. All feeds are one partition, polled one after the other: publishers are not to be asked in parallel.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from tidemark.sources.cycle import BODIES, read_feeds
from tidemark.sources.landing import StateStore, fetch

ANSWERS = f"{BODIES}, status string"


def poll(options: dict) -> Iterator[tuple]:
    """One row (ANSWERS) a feed, in order; body is null but for status ok. The state is saved when all have been asked."""
    store, delay = StateStore(options["state"]), float(options.get("delay", 1.0))
    for k, feed in enumerate(read_feeds(options["feeds"])):
        if k and delay:
            time.sleep(delay)
        status, body = fetch(feed.url, feed.feed_id, store, retries=int(options.get("retries", 3)), base=float(options.get("base", 1.0)))
        at = time.strftime("%Y-%m-%dT%H:%M:%S+00:00", time.gmtime())
        yield feed.source, feed.channel, feed.kanal, feed.feed_id, body.decode("utf-8", "replace") if status == "ok" and body is not None else None, at, status
    store.save()


class Once(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from poll(self.options)


class Cycles(SimpleDataSourceStreamReader):
    """The offset is the number of cycles polled. A cycle's answers are written before they are handed on, so one that runs again is read, not asked for anew."""

    def __init__(self, options: dict):
        self.options = dict(options)
        os.makedirs(self.options["log"], exist_ok=True)

    def _path(self, cycle: int) -> str:
        return os.path.join(self.options["log"], f"{cycle:09d}.json")

    def initialOffset(self) -> dict:
        return {"cycle": 0}

    def _logged(self, cycle: int) -> list[tuple]:
        with open(self._path(cycle), encoding="utf-8") as f:
            return [tuple(r) for r in json.load(f)]

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        cycle = int(start["cycle"])
        if not os.path.exists(self._path(cycle)):
            rows = list(poll(self.options))  # one body a feed
            tmp = f"{self._path(cycle)}.tmp"
            with open(tmp, "w", encoding="utf-8") as f:
                json.dump(rows, f)
            os.replace(tmp, self._path(cycle))
        return iter(self._logged(cycle)), {"cycle": cycle + 1}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        for cycle in range(int(start["cycle"]), int(end["cycle"])):
            yield from self._logged(cycle)

    def commit(self, end: dict) -> None:
        """Cycles that are surely done go."""
        for name in os.listdir(self.options["log"]):
            if name.endswith(".json") and int(name[:-5]) < int(end["cycle"]) - 1:
                os.remove(os.path.join(self.options["log"], name))


class FeedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "feeds"

    def schema(self) -> str:
        return ANSWERS

    def reader(self, schema) -> Once:
        return Once(self.options)

    def simpleStreamReader(self, schema) -> Cycles:
        return Cycles(self.options)


def answers(spark: SparkSession, streaming: bool = False, **options) -> DataFrame:
    """The feeds' answers as a frame or a stream."""
    spark.dataSource.register(FeedSource)
    reader = (spark.readStream if streaming else spark.read).format("feeds")
    return reader.options(**{k: str(v) for k, v in options.items()}).load()
