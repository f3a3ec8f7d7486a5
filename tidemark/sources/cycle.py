"""One polling cycle over a list of feeds, and its report."""

from __future__ import annotations

import json
import time
from collections import Counter, defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.landing import StateStore, existing_keys, fetch, land, parse_feed, parse_report

BODIES = "source string, channel string, kanal string, feed_id string, body string, fetched_at string"


@dataclass(frozen=True)
class Feed:
    source: str
    channel: str
    kanal: str
    url: str

    @property
    def feed_id(self) -> str:
        return f"{self.source}:{self.channel}"


def read_feeds(path: str) -> list[Feed]:
    """Feeds from a JSON list of objects with source, channel, kanal and url."""
    with open(path, encoding="utf-8") as f:
        return [Feed(**x) for x in json.load(f)]


def feeds_for(feeds: list[Feed], source: str | None) -> list[Feed]:
    """Feeds of one source, or all; an unknown source is a KeyError."""
    found = [x for x in feeds if source in (None, x.source)]
    if source is not None and not found:
        raise KeyError(source)
    return found


@dataclass
class CycleReport:
    results: list[tuple[Feed, str]] = field(default_factory=list)
    unreachable: frozenset[str] = frozenset()
    landed: dict[str, int] = field(default_factory=dict)
    failures: dict[str, list[str]] = field(default_factory=dict)  # reason: feeds
    samples: dict[str, list[str]] = field(default_factory=dict)  # feed: its first failures

    @property
    def by_status(self) -> dict[str, int]:
        return dict(Counter(s for _, s in self.results))

    @property
    def by_source(self) -> dict[str, dict[str, int]]:
        out: dict[str, dict[str, int]] = defaultdict(lambda: {"feeds": 0, "ok": 0, "failed": 0, "landed": 0})
        for f, status in self.results:
            own = out[f.source]
            own["feeds"] += 1
            own["ok"] += status in ("ok", "not_modified")
            own["failed"] += status == "failed"
        for source, n in self.landed.items():
            out[source]["landed"] = n
        return dict(out)

    @property
    def _seen(self) -> set[str]:
        return {s for s, v in self.by_source.items() if v["ok"]}

    @property
    def lost(self) -> set[str]:
        """Sources that were expected and gave nothing."""
        return {f.source for f, _ in self.results} - self.unreachable - self._seen

    @property
    def stale(self) -> set[str]:
        """Sources declared unreachable that answered."""
        return set(self.unreachable) & self._seen

    @property
    def healthy(self) -> bool:
        return bool(self.results) and not self.lost

    def summary(self) -> str:
        lines = ["status: " + ", ".join(f"{k} {v}" for k, v in sorted(self.by_status.items()))]
        lines += [f"  {'!' if s in self.lost else ' '} {s}: {v['ok']} of {v['feeds']} feeds, {v['landed']} landed" for s, v in sorted(self.by_source.items())]
        lines += [f"  failed, {reason}: {', '.join(names[:4])}{f' and {len(names) - 4} more' if len(names) > 4 else ''}" for reason, names in sorted(self.failures.items())]
        lines += [f"  {name}: {text}" for name, texts in sorted(self.samples.items()) for text in texts]
        lines += [f"  {s} is declared unreachable but answered" for s in sorted(self.stale)]
        return "\n".join(lines)


def run_cycle(spark: SparkSession, feeds: list[Feed], root: str, state: str, delay: float = 1.0, unreachable: frozenset[str] = frozenset(), poll: Callable = fetch, sleep: Callable = time.sleep, now: Callable = time.time, lookback: int = 3) -> CycleReport:
    """Polls the feeds one after the other with a pause between them, lands the new records, and reports.

    Only bodies of responses pass through the driver, one for each feed.
    """
    store, report, bodies = StateStore(state), CycleReport(unreachable=unreachable), []
    reasons = defaultdict(list)
    for k, feed in enumerate(feeds):
        if k and delay:
            sleep(delay)
        status, body = poll(feed.url, feed.feed_id, store)
        report.results.append((feed, status))
        if status == "ok":
            at = time.strftime("%Y-%m-%dT%H:%M:%S+00:00", time.gmtime(now()))
            bodies.append((feed.source, feed.channel, feed.kanal, feed.feed_id, (body or b"").decode("utf-8", "replace"), at))
        elif status != "not_modified":
            reasons[status].append(feed.feed_id)
    store.save()
    if bodies:
        sent = spark.createDataFrame(bodies, BODIES)
        rows = parse_feed(sent).persist()
        for r in rows.where("failure IS NOT NULL").select("failure", "feed_id").distinct().collect():
            reasons[r["failure"]].append(r["feed_id"])
        report.samples = {r["feed_id"]: list(r["samples"]) for r in parse_report(sent).where("failures > 0").collect()}
        fresh = _fresh(spark, rows.where("failure IS NULL").drop("failure"), root, {(b[0], b[5][:10]) for b in bodies}, lookback)
        names, seen = sorted({f.source for f in feeds}), Observation()
        land(fresh.observe(seen, *[F.count_if(F.col("source") == n).alias(f"n{k}") for k, n in enumerate(names)]), root)  # counted as they are written
        report.landed = {n: seen.get[f"n{k}"] for k, n in enumerate(names) if seen.get[f"n{k}"]}
        rows.unpersist()
    report.failures = {k: sorted(v) for k, v in reasons.items()}
    return report


def _fresh(spark: SparkSession, rows: DataFrame, root: str, parts: set[tuple[str, str]], lookback: int) -> DataFrame:
    """Records whose key their source has not landed lately; one row of each."""
    rows = rows.dropDuplicates(["source", "article_key"])
    try:
        for source, day in sorted(parts):
            rows = rows.join(existing_keys(spark, root, source, day, lookback), ["source", "article_key"], "left_anti").select(rows.columns)
    except Exception as e:  # nothing has landed yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
    return rows
