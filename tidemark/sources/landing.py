"""Feeds to tables: fetching, parsing RSS and Atom, the landing zone, idempotent loads."""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.request
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import columns as C
from tidemark.functions.python import canonical_url, strip_html
from tidemark.operators.articles import first_seen, new_rows
from tidemark.sources.tables import Snapshots

RECORD = "article_key string, canonical_url string, title_fingerprint string, title string, summary string, kanal string, source string, channel string, feed_id string, raw_link string, published_at string, fetched_at string, schema_version int, extra string"
RETRIED = frozenset({408, 425, 429, 500, 502, 503, 504})


@dataclass
class FeedState:
    etag: str | None = None
    last_modified: str | None = None
    failures: int = 0
    open_until: float = 0.0


class StateStore:
    """State of all feeds in one JSON file, replaced atomically; a file that can't be read is a fresh start."""

    def __init__(self, path: str):
        self.path = path
        try:
            with open(path, encoding="utf-8") as f:
                self.feeds = {k: FeedState(**v) for k, v in json.load(f).items()}
        except (OSError, ValueError, TypeError, AttributeError):
            self.feeds = {}

    def get(self, feed: str) -> FeedState:
        return self.feeds.setdefault(feed, FeedState())

    def save(self) -> None:
        tmp = f"{self.path}.tmp"
        with open(tmp, "w", encoding="utf-8") as f:
            json.dump({k: asdict(v) for k, v in self.feeds.items()}, f)
        os.replace(tmp, self.path)


def backoff(base: float, attempt: int, retry_after: str | None, most: float = 60.0) -> float:
    floor = float(retry_after) if (retry_after or "").replace(".", "", 1).isdigit() else 0.0
    return min(max(base * 2**attempt, floor), most)


def fetch(url: str, feed: str, store: StateStore, opener=urllib.request.urlopen, now=time.time, sleep=time.sleep, retries: int = 3, base: float = 1.0, breaker: int = 3, pause: float = 3600) -> tuple[str, bytes | None]:
    """(status, body) of one poll: ok, not_modified, skipped_breaker or failed. Conditional; retries what may pass; opens a breaker."""
    s = store.get(feed)
    if now() < s.open_until:
        return "skipped_breaker", None
    headers = {k: v for k, v in (("If-None-Match", s.etag), ("If-Modified-Since", s.last_modified)) if v}
    for attempt in range(retries + 1):
        wait = None
        try:
            with opener(urllib.request.Request(url, headers=headers)) as r:
                s.etag, s.last_modified, s.failures, s.open_until = r.headers.get("ETag"), r.headers.get("Last-Modified"), 0, 0.0
                return "ok", r.read()
        except urllib.error.HTTPError as e:
            if e.code == 304:
                s.failures, s.open_until = 0, 0.0
                return "not_modified", None
            if e.code not in RETRIED:
                break
            wait = e.headers.get("Retry-After") if e.headers else None
        except OSError:
            pass
        if attempt < retries:
            sleep(backoff(base, attempt, wait))
    s.failures += 1
    if s.failures >= breaker:
        s.open_until = now() + pause
    return "failed", None


def parse_time(x):
    """RFC 822 and ISO times as UTC timestamps, null where neither fits."""
    bare = F.regexp_replace(x, r"^[A-Za-z]+,\s*", "")
    return F.coalesce(F.try_to_timestamp(bare, F.lit("dd MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(x))


# Element names that are columns already, or that tell the label.
NOT_EXTRA = ("title", "summary", "description", "link", "id", "guid", "published", "pubDate", "updated", "dc:date", "category", "dc:subject", "keywords")
_ITEM = "struct<title string, link string, description string, pubDate string>"
_ENTRY = "struct<title string, link array<struct<_href string, _rel string>>, summary string, published string, updated string>"
# The corrupt column stays last: elsewhere Spark fills the wrong field.
_FEED = "channel struct<item array<{item}>>, entry array<{entry}>, _corrupt_record string"
SAMPLES = 3


def entries(bodies: DataFrame) -> DataFrame:
    """Items of RSS bodies and entries of Atom bodies (source, channel, kanal, feed_id, body, fetched_at), with `pos` and, for a bad one, `failure`.

    `extra` holds what else an item has as plain text, but for NOT_EXTRA and nested elements. An item without link or title gives a row with
    `failure` set and no key; so does, once, a body that is no XML and has no items. A sound body without items gives no row.
    """
    read = lambda item, entry: F.from_xml("body", T.StructType.fromDDL(_FEED.format(item=item, entry=entry)))
    rows = bodies.select("source", "channel", "kanal", "feed_id", "fetched_at", read(_ITEM, _ENTRY).alias("x"), read("map<string,string>", "map<string,string>").alias("m"))
    main = lambda links: F.filter(links, lambda x: (F.coalesce(x["_rel"], F.lit("alternate")) == "alternate") & x["_href"].isNotNull())
    item = lambda i: F.struct(i["title"].alias("title"), i["link"].alias("link"), i["description"].alias("summary"), i["pubDate"].alias("sent"))
    entry = lambda e: F.struct(e["title"].alias("title"), F.try_element_at(main(e["link"]), F.lit(1))["_href"].alias("link"), e["summary"].alias("summary"), F.coalesce(e["published"], e["updated"]).alias("sent"))
    none = F.expr("array()")
    both = F.concat(F.coalesce(F.transform("x.channel.item", item), none), F.coalesce(F.transform("x.entry", entry), none))
    more = F.concat(F.coalesce("m.channel.item", none), F.coalesce("m.entry", none))
    unread = (F.size(both) == 0) & (F.col("x").isNull() | F.col("x._corrupt_record").isNotNull())
    rows = rows.select("*", unread.alias("unread"), both.alias("both"), more.alias("more")).select("*", F.posexplode_outer("both").alias("pos", "i")).where("pos IS NOT NULL OR unread")
    other = F.map_filter(F.try_element_at("more", F.col("pos") + 1), lambda k, v: ~k.isin(*NOT_EXTRA) & ~k.startswith("_") & (F.trim(v) != "") & ~F.trim(v).startswith("<"))
    link = F.trim("i.link")
    rows = rows.select("source", "channel", "kanal", "feed_id", "fetched_at", "unread", F.coalesce("pos", F.lit(0)).alias("pos"), link.alias("raw_link"), F.col("i.sent").alias("sent"), C.clean_text(strip_html("i.title")).alias("title"), C.clean_text(strip_html("i.summary")).alias("summary"), canonical_url(link).alias("canonical_url"), F.to_json(F.coalesce(other, F.expr("map()"))).alias("extra"))
    rows = rows.withColumns({"failure": F.when(F.col("unread"), "no XML").when(F.col("canonical_url").isNull() | (F.col("raw_link") == ""), "no link").when(F.coalesce("title", F.lit("")) == "", "no title"), "published_at": F.date_format(parse_time(F.col("sent")), "yyyy-MM-dd'T'HH:mm:ssXXX")})
    rows = rows.withColumns({"article_key": F.when(F.col("failure").isNull(), C.article_key(F.col("canonical_url"))), "title_fingerprint": C.fingerprint(F.col("title")), "schema_version": F.lit(1)})
    return rows.select(*(f.name for f in T.StructType.fromDDL(RECORD).fields), "failure", "pos")


def parse_feed(bodies: DataFrame) -> DataFrame:
    """The records of all bodies, the first of each key within its response, and the failures (`failure` set, no key)."""
    rows = entries(bodies)
    good = first_seen(rows.where("failure IS NULL").withColumn("_k", F.concat_ws("|", "feed_id", "article_key")), "_k", "pos")
    names = [n for n in rows.columns if n != "pos"]
    return good.select(*names).union(rows.where("failure IS NOT NULL").select(*names))


def parse_report(bodies: DataFrame) -> DataFrame:
    """feed_id, entries, failures, failure_rate and the first SAMPLES failures of each feed; a feed without items has zeros."""
    bad = F.col("failure").isNotNull()
    said = F.when(bad, F.struct("pos", F.substring(F.concat_ws(": ", "failure", F.coalesce(F.nullif("title", F.lit("")), "raw_link")), 1, 200).alias("text")))
    got = entries(bodies).groupBy("feed_id").agg(F.count(F.when(~F.col("failure").eqNullSafe("no XML"), 1)).alias("entries"), F.count(F.when(bad, 1)).alias("failures"), F.slice(F.array_sort(F.collect_list(said)), 1, SAMPLES).alias("s"))
    rows = bodies.select("feed_id").distinct().join(got, "feed_id", "left")
    count = lambda c: F.coalesce(c, F.lit(0))
    return rows.select("feed_id", count("entries").alias("entries"), count("failures").alias("failures"), F.coalesce(F.try_divide("failures", "entries"), F.lit(0.0)).alias("failure_rate"), F.coalesce("s.text", F.expr("array()")).alias("samples"))


def land(records: DataFrame, root: str, known: DataFrame | None = None) -> None:
    """Appends records that their source has not landed yet as JSON lines under source= and dt= (UTC day of the fetch)."""
    rows = records if known is None else records.join(known.select("source", "article_key"), ["source", "article_key"], "left_anti").select(records.columns)
    rows = rows.withColumns({"_s": F.col("source"), "_d": F.substring("fetched_at", 1, 10)})
    rows.withColumnsRenamed({"_s": "p_source", "_d": "dt"}).write.partitionBy("p_source", "dt").mode("append").json(root)


def landed(spark: SparkSession, root: str) -> DataFrame:
    """All records with the file they are in; lines that are no record go to _corrupt_record."""
    return spark.read.schema(RECORD + ", _corrupt_record string").option("recursiveFileLookup", True).option("columnNameOfCorruptRecord", "_corrupt_record").json(root).withColumn("_ingest_file", F.col("_metadata.file_path"))


def existing_keys(spark: SparkSession, root: str, source: str, day: str, lookback: int = 3) -> DataFrame:
    """Keys of one source on a day and the days before it: a scan of those partitions only."""
    parts = spark.read.schema(RECORD + ", p_source string, dt string").json(root)
    return parts.where((F.col("p_source") == source) & F.col("dt").cast("date").between(F.date_sub(F.lit(day).cast("date"), lookback), F.lit(day).cast("date"))).select("source", "article_key").distinct()


def typed(records: DataFrame) -> DataFrame:
    at = lambda c: F.expr(f"try_cast({c} AS timestamp)")
    return records.where("article_key IS NOT NULL").withColumns({"published_at": at("published_at"), "fetched_at": at("fetched_at")})


TABLE, LOG = "articles", "load_log"
LOG_SHAPE = "file_path string, rows_read long, loaded_at timestamp"


def load(spark: SparkSession, root: str, store: Snapshots, force: bool = False) -> dict:
    """Adds the files that the log has not (all, if forced): keys that the table has not, the first of each; returns how many files and rows were read and added.

    Table and log change in one transaction, and the counts are taken while they are written. Files that are read again have their log rows renewed.
    """
    with store.writer() as t:
        rows = landed(spark, root)
        if not force:
            rows = rows.join(t.read(LOG, LOG_SHAPE).select(F.col("file_path").alias("_ingest_file")).distinct(), "_ingest_file", "left_anti")
        batch = typed(rows).drop("_corrupt_record")
        files = rows.groupBy(F.col("_ingest_file").alias("file_path")).agg(F.count("*").alias("rows_read")).withColumn("loaded_at", F.current_timestamp())
        seen = t.merge(LOG, files, "file_path", read=F.coalesce(F.sum("rows_read"), F.lit(0)))
        if not seen["rows"]:
            t.cancel()
            return {"files_loaded": 0, "rows_read": 0, "rows_added": 0}
        added = t.append(TABLE, new_rows(batch, t.read(TABLE, batch.schema), "article_key", "_ingest_file"))
    return {"files_loaded": seen["rows"], "rows_read": seen["read"], "rows_added": added["rows"]}
