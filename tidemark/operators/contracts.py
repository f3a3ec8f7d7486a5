"""Data contracts: each gives the rows that break it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import rate, units_between


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def not_empty_string(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.trim(col) == "")


def accepted_range(df: DataFrame, col: str, low=None, high=None, inclusive: bool = True) -> DataFrame:
    """Nulls pass."""
    c, bad = F.col(col), F.lit(False)
    if low is not None:
        bad = bad | (c < low if inclusive else c <= low)
    if high is not None:
        bad = bad | (c > high if inclusive else c >= high)
    return df.where(bad)


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.where(~F.col(col).isin(*values)).groupBy(col).agg(F.count("*").alias("n"))


def expression_is_true(df: DataFrame, expression: str) -> DataFrame:
    return df.where(f"NOT ({expression})")


def unique_combination(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count("*").alias("n")).where("n > 1")


def taxonomy_coverage(labelled: DataFrame) -> DataFrame:
    return labelled.where("taxonomy_missing").groupBy("source", "channel").agg(F.count("*").alias("orphaned_articles"))


def taxonomy_conflict(labelled: DataFrame) -> DataFrame:
    return labelled.where("taxonomy_conflict").groupBy("source", "channel", F.col("kanal").alias("label_from_ingestion"), F.col("mapped_kanal").alias("label_from_seed")).agg(F.count("*").alias("affected_articles"))


def future_publication(staged: DataFrame, minutes: int = 5) -> DataFrame:
    late = F.col("published_at") > F.col("fetched_at") + F.expr(f"INTERVAL '{minutes}' MINUTE")
    return staged.where(late).select("article_key", "source", "feed_id", "published_at", "fetched_at", units_between("MINUTE", F.col("fetched_at"), F.col("published_at")).alias("minutes_into_the_future"))


def silent_sources(health: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Expected sources without rows on the latest day."""
    spark, last = health.sparkSession, health.agg(F.max("ingest_date").alias("on_date"))
    there = health.join(F.broadcast(last), health["ingest_date"] == last["on_date"]).select("source")
    return spark.createDataFrame([(s,) for s in expected], "source string").join(there, "source", "left_anti").crossJoin(last).select(F.col("source").alias("silent_source"), "on_date")


def abandoned_feeds(feeds: DataFrame) -> DataFrame:
    """The longest abandoned first."""
    return feeds.where("looks_abandoned").orderBy(F.col("freshest_age_hours").desc_nulls_last(), "feed_id").select("feed_id", "kanal", "articles", F.round(F.col("freshest_age_hours") / F.lit(24.0), 1).alias("freshest_age_days"), "newest_published")


def clean_control(fct: DataFrame, source: str, most: float = 0.25) -> DataFrame:
    out = fct.where(F.col("source") == source).groupBy("source").agg(F.count("*").alias("articles"), rate(F.col("url_leaks_label")).alias("leak"))
    return out.where(F.col("leak") > most).select("source", "articles", F.round(F.col("leak") * 100, 1).alias("leak_pct"))


def freshness(fct: DataFrame, now, warn_hours: int = 2, error_hours: int = 6) -> DataFrame:
    """Hours since each source was fetched last, and pass, warn or error."""
    age = F.timestamp_diff("MINUTE", F.max("fetched_at"), F.lit(now).cast("timestamp_ntz")) / F.lit(60.0)
    return fct.groupBy("source").agg(age.alias("age_hours")).withColumn("status", F.when(F.col("age_hours") > error_hours, "error").when(F.col("age_hours") > warn_hours, "warn").otherwise("pass"))


def reported_since(fct: DataFrame, now, hours: int = 2) -> DataFrame:
    return fct.where(F.col("fetched_at") > F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL '{hours}' HOUR")).select("source").distinct()


def unregistered_sources(fct: DataFrame, registered: Sequence[str]) -> DataFrame:
    known = fct.sparkSession.createDataFrame([(s,) for s in registered], "source string")
    return fct.join(F.broadcast(known), "source", "left_anti").groupBy("source").agg(F.count("*").alias("articles"))
