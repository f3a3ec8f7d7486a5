"""State of each feed over a stream of polls: validators for conditional requests, failures in a row, and the breaker that they open."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

POLLS = "feed_id string, at timestamp, status string, etag string, last_modified string"
DECISIONS = "feed_id string, at timestamp, decision string, failures int, open_until timestamp, etag string, last_modified string"
_KEPT = "etag string, last_modified string, failures int, open_until timestamp, last timestamp"


def prepare(spark: SparkSession) -> None:
    """The state store that keyed state with timers needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Breaker(StatefulProcessor):
    """One feed's polls in order of time. Status says what a request got (ok, not_modified) or that it failed; behind an open breaker no request is made.

    `breaker` failures in a row open it for `pause` seconds. When event time has passed its end a timer closes it and says so, whether a poll comes
    or not. A feed that is not polled for `forget` seconds of event time loses its state. Polls older than one that was decided on before are passed over.
    """

    def __init__(self, breaker: int = 3, pause: float = 3600, forget: float = 30 * 86400):
        self.breaker, self.pause, self.forget = breaker, dt.timedelta(seconds=pause), dt.timedelta(seconds=forget)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("feed", _KEPT)

    def _get(self) -> list:
        return list(self.kept.get()) if self.kept.exists() else [None, None, 0, None, None]

    def _row(self, feed: str, at, decision: str, s: list) -> dict:
        return {"feed_id": feed, "at": at, "decision": decision, "failures": s[2], "open_until": s[3], "etag": s[0], "last_modified": s[1]}

    @staticmethod
    def _ms(at) -> int:
        return int(pd.Timestamp(at, tz="UTC").value // 1_000_000)

    def _wake(self, s: list) -> None:
        """One timer a feed: at the end of the breaker, or when the feed is to be forgotten."""
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        self.handle.registerTimer(self._ms(s[3] if s[3] is not None else s[4] + self.forget))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        s, out = self._get(), []
        for r in pd.concat(list(rows)).sort_values("at", kind="stable").itertuples(index=False):
            at = r.at.to_pydatetime()
            if s[4] is not None and at < s[4]:
                continue
            s[4] = at
            if s[3] is not None and at < s[3]:
                out.append(self._row(key[0], at, "skipped_breaker", s))
                continue
            if r.status in ("ok", "not_modified"):
                if r.status == "ok":
                    s[0], s[1] = (None if pd.isna(x) else x for x in (r.etag, r.last_modified))
                s[2], s[3] = 0, None
            else:
                s[2] += 1
                s[3] = at + self.pause if s[2] >= self.breaker else None
            out.append(self._row(key[0], at, r.status, s))
        if s[4] is not None:
            self.kept.update(tuple(s))
            self._wake(s)
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        s = self._get()
        if s[3] is not None:
            ended, s[3] = s[3], None
            self.kept.update(tuple(s))
            self._wake(s)
            yield self._frame([self._row(key[0], ended, "breaker_closed", s)])
        else:
            self.kept.clear()
            yield self._frame([self._row(key[0], s[4], "forgotten", s)] if s[4] is not None else [])

    @staticmethod
    def _frame(rows: list[dict]) -> pd.DataFrame:
        names = ["feed_id", "at", "decision", "failures", "open_until", "etag", "last_modified"]
        out = pd.DataFrame(rows, columns=names)
        return out.astype({"at": "datetime64[us]", "open_until": "datetime64[us]", "failures": "int32"})

    def close(self) -> None:
        pass


def decisions(polls: DataFrame, late: str = "1 hour", **limits) -> DataFrame:
    """What became of each poll of a stream (POLLS), and when breakers closed. State is one row a feed, kept by its key; call prepare() first."""
    return polls.withWatermark("at", late).groupBy("feed_id").transformWithStateInPandas(statefulProcessor=Breaker(**limits), outputStructType=DECISIONS, outputMode="Append", timeMode="EventTime")


def plain(polls: list[tuple], breaker: int = 3, pause: float = 3600) -> list[tuple]:
    """The same decisions on the driver: (feed, at, decision, failures, open_until, etag) of polls (feed, at, status, etag) in order of time."""
    state, out = {}, []
    for feed, at, status, etag in sorted(polls, key=lambda p: p[1]):
        s = state.setdefault(feed, {"etag": None, "failures": 0, "until": None})
        if s["until"] is not None and at < s["until"]:
            status = "skipped_breaker"
        elif status in ("ok", "not_modified"):
            s.update(failures=0, until=None, etag=etag if status == "ok" else s["etag"])
        else:
            s["failures"] += 1
            s["until"] = at + dt.timedelta(seconds=pause) if s["failures"] >= breaker else None
        out.append((feed, at, status, s["failures"], s["until"], s["etag"]))
    return out
