"""A synthetic landing zone, derived by expressions from row numbers: the same rows at every call, for trying the pipeline without a network."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.sources.cycle import Feed
from tidemark.sources.landing import RECORD, land

WORDS = ("harga", "pasar", "menteri", "gol", "hujan", "pajak", "film", "bank", "jalan", "siswa", "panen", "pemilu")


def records(spark: SparkSession, feeds: list[Feed], days: int = 3, articles: int = 20, first_day: str = "2026-07-29") -> DataFrame:
    """`articles` records (RECORD) of each feed and day. Every fifth repeats the title of the day before, every seventh has no date, every eleventh is
    months old, every thirteenth is dated an hour ahead of its fetch; a link holds the channel, the label or neither in turn."""
    if not feeds:
        raise ValueError("no feeds")
    of = F.from_json(F.lit("[" + ",".join(_json(f) for f in feeds) + "]"), "array<struct<source: string, channel: string, kanal: string>>")
    n = spark.range(len(feeds) * days * articles).withColumn("f", F.element_at(of, (F.col("id") % len(feeds) + 1).cast("int")))
    n = n.withColumns({"k": F.floor(F.col("id") / len(feeds)) % articles, "day": F.floor(F.col("id") / (len(feeds) * articles)).cast("int")})
    story = F.when(F.col("k") % 5 == 0, F.greatest(F.col("day") - 1, F.lit(0))).otherwise(F.col("day"))
    word = lambda j: F.element_at(F.array(*map(F.lit, WORDS)), (F.pmod(F.xxhash64("id", F.lit(j)), F.lit(len(WORDS))) + 1).cast("int"))
    title = F.when(F.col("k") % 5 == 0, F.concat_ws(" ", F.lit("Kabar"), "f.channel", F.lit("edisi"), F.col("k").cast("string"), story.cast("string"))).otherwise(F.concat_ws(" ", word(1), word(2), word(3), F.col("id").cast("string")))
    fetched = F.to_timestamp(F.concat(F.date_add(F.lit(first_day).cast("date"), F.col("day")).cast("string"), F.lit(" 06:00:00"))) + F.make_dt_interval(F.lit(0), F.col("k").cast("int") % 12)
    age = F.when(F.col("k") % 13 == 12, F.lit(-1)).when(F.col("k") % 11 == 10, F.lit(24 * 100)).otherwise(F.col("k").cast("int"))
    published = F.when(F.col("k") % 7 != 6, fetched - F.make_dt_interval(F.lit(0), age))
    part = F.when(F.col("k") % 3 == 0, F.col("f.channel")).when(F.col("k") % 3 == 1, F.split_part("f.kanal", F.lit("-"), F.lit(1))).otherwise("baca")
    at = lambda x: F.date_format(x, "yyyy-MM-dd'T'HH:mm:ssXXX")
    rows = n.select("f.*", title.alias("title"), F.concat_ws(" ", word(4), word(5), word(6)).alias("summary"), F.concat(F.lit("https://www."), "f.source", F.lit(".example/"), part, F.lit("/"), F.col("id").cast("string"), F.lit("?utm_source=rss")).alias("raw_link"), at(published).alias("published_at"), at(fetched).alias("fetched_at"))
    rows = rows.withColumn("canonical_url", C.canonical_url(F.col("raw_link")))
    rows = rows.withColumns({"article_key": C.article_key(F.col("canonical_url")), "title_fingerprint": C.fingerprint(F.col("title")), "feed_id": F.concat_ws(":", "source", "channel"), "schema_version": F.lit(1), "extra": F.lit("{}")})
    return rows.select(*[x.strip().split(" ")[0] for x in RECORD.split(",")])


def _json(feed: Feed) -> str:
    import json

    return json.dumps({"source": feed.source, "channel": feed.channel, "kanal": feed.kanal})


def build(spark: SparkSession, root: str, feeds: list[Feed], days: int = 3, articles: int = 20) -> int:
    """Lands the records under root; returns how many."""
    rows = records(spark, feeds, days, articles)
    land(rows, root)
    return len(feeds) * days * articles
