"""Facts and marts kept up by day: a load rebuilds the days that it changes, and no others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import articles as A
from tidemark.sources.landing import TABLE
from tidemark.sources.tables import Snapshots

FACTS, SOURCE_HEALTH, FEED_HEALTH, MARK = "fct_articles", "mart_source_health", "mart_feed_health", "daily"


def _day() -> Column:
    """The day of fetching as its folder has it."""
    return F.coalesce(F.to_date("fetched_at").cast("string"), F.lit("none"))


def changed_days(raw: DataFrame, added: DataFrame) -> list[str]:
    """Days of fetching on which a fact changes by the added rows: their own, and those of all articles of the same stories, whose clusters grow."""
    stories = added.select("title_fingerprint").distinct()
    days = raw.join(stories, "title_fingerprint", "left_semi").select("fetched_at").union(added.where("title_fingerprint IS NULL").select("fetched_at")).select(_day().alias("_day")).distinct()
    return sorted(r["_day"] for r in days.collect())  # a row a day


def facts_of(raw: DataFrame, taxonomy: DataFrame, days: list[str]) -> DataFrame:
    """The facts of some days, from the articles of these days and the others of their stories."""
    own = raw.withColumn("_day", _day()).where(F.col("_day").isin(days)).drop("_day")
    members = raw.join(own.select("title_fingerprint").distinct(), "title_fingerprint", "left_semi").select(raw.columns)
    return A.facts(A.labelled(A.deduped(A.staging(members)), taxonomy)).withColumn("_day", _day()).where(F.col("_day").isin(days)).drop("_day")


def refresh(store: Snapshots, taxonomy: DataFrame, full: bool = False) -> list[str]:
    """Brings facts and marts up to the articles in the warehouse, in one transaction; returns the days that were rebuilt.

    The manifest notes which folders of articles the marts rest on: those that came since are what was added. If some of them are gone (a table
    that was written anew), or if asked to, all days are rebuilt.
    """
    with store.writer() as t:
        folders = t.now["tables"].get(TABLE, {"folders": []})["folders"]
        done = t.now["marks"].get(MARK, [])
        raw = t.read(TABLE)
        full = full or not set(done) <= set(folders)
        fresh = [f for f in folders if full or f not in done]
        if not fresh:
            return []
        added = store.spark.read.schema(raw.schema).parquet(*[f"{store.root}/{f}" for f in fresh])
        days = changed_days(raw, added)
        gone = sorted({f.split("_day=")[-1] for name in (FACTS, SOURCE_HEALTH) for f in t.now["tables"].get(name, {"folders": []})["folders"]}) if full else []
        t.overwrite_days(FACTS, facts_of(raw, taxonomy, days).withColumn("_fetched", F.to_date("fetched_at")), "_fetched", [*days, *gone])
        fct = t.read(FACTS).drop("_fetched")
        today = fct.withColumn("_day", _day()).where(F.col("_day").isin(days)).drop("_day")
        t.overwrite_days(SOURCE_HEALTH, A.source_health(today), "ingest_date", [*days, *gone])
        t.replace(FEED_HEALTH, A.feed_health(fct))
        t.mark(MARK, folders)
    return days


def facts(store: Snapshots) -> DataFrame:
    return store.read(FACTS).drop("_fetched")
