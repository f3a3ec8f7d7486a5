"""The relations of a news corpus, from the tables at hand: the same expressions as in tidemark.plans.oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEVELS = ("high", "medium", "low")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as an article, with what its event tells, if it has one; some titles are blank and dates are spread over four weeks."""
    d, e = read(spark, sf_dir, "documents"), read(spark, sf_dir, "events")
    j = d.join(e, e.event_id == d.doc_id, "left")
    sent = F.expr("ts + make_dt_interval(CAST(doc_id * 13 % 28 AS INT))")
    lang = F.when(F.col("doc_id") % 7 == 0, "ekonomi").when(F.col("lang") == "en", "politik").when(F.col("lang") == "de", "hukum-kriminal").when(F.col("lang") == "fr", "gaya-hidup-kesehatan").otherwise("ekonomi")
    first = F.substring_index("text", "\n", 1)
    j = j.select(
        "doc_id",
        F.sha2(F.col("doc_id").cast("string"), 256).alias("article_key"),
        F.when(F.col("doc_id") % 83 == 0, "  ").otherwise(first).alias("title"),
        F.when(F.col("doc_id") % 11 != 0, F.expr("substring(text, length(substring_index(text, '\n', 1)) + 2)")).alias("summary"),
        lang.alias("kanal"),
        "source",
        F.col("event_type").alias("channel"),
        F.concat("source", F.lit(":"), "event_type").alias("feed_id"),
        F.when(F.col("doc_id") % 97 != 0, sent).alias("published_at"),
        F.when(F.col("doc_id") % 89 == 0, (sent - F.expr("INTERVAL '2' HOUR"))).otherwise((sent + F.expr("make_dt_interval(0, CAST(doc_id * 37 % 1500 AS INT))"))).alias("fetched_at"),
        F.lit(1).alias("schema_version"),
        F.col("props").alias("extra"),
        F.concat(F.lit("f"), (F.col("doc_id") % 8).cast("string")).alias("_ingest_file"),
    )
    place = F.when(F.col("doc_id") % 3 == 0, F.col("channel")).when(F.col("doc_id") % 3 == 1, F.split_part("kanal", F.lit("-"), F.lit(1))).otherwise("news")
    link = F.concat(F.lit("https://"), F.col("source"), F.lit(".example/"), place, F.lit("/"), F.col("doc_id").cast("string"))
    folded = F.trim(F.regexp_replace(F.lower("title"), "[^a-z0-9]+", " "))
    return j.withColumns({"raw_link": link, "canonical_url": link, "title_fingerprint": F.sha2(folded, 256)})


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seed table: each source and channel with a label and how sure it is; one channel of src0 is missing, src1's are wrong."""
    pairs = articles(spark, sf_dir).select("source", "channel").distinct()
    rank = F.when(F.col("channel") == "click", 0).when(F.col("channel") == "error", 1).when(F.col("channel") == "purchase", 2).when(F.col("channel") == "signup", 3).otherwise(4)
    level = F.when(rank % 3 == 0, LEVELS[0]).when(rank % 3 == 1, LEVELS[1]).otherwise(LEVELS[2])
    return pairs.where("NOT (source = 'src0' AND channel = 'click')").select("source", "channel", F.when(F.col("source") == "src1", "olahraga").otherwise("ekonomi").alias("kanal"), level.alias("confidence"), F.lit("generated").alias("notes"))


def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", F.col("url").alias("raw_link"), F.regexp_extract("html", 'lang="([a-z]+)"', 1).alias("label"), F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"), "html")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents"), "doc_id")
    flip = lambda m: F.when(F.col("n_chars") % m == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    folded = F.trim(F.regexp_replace(F.lower(F.substring_index("text", "\n", 1)), "[^a-z0-9]+", " "))
    named = lambda c: F.when(c == 1, "good").otherwise("bad")
    return j.select("doc_id", named(F.col("quality")).alias("y_true"), named(flip(3)).alias("champion"), named(flip(5)).alias("challenger"), (F.col("n_chars") % 1000 / F.lit(1000.0)).alias("confidence"), F.sha2(folded, 256).alias("cluster"))
