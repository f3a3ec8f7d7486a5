"""Named checks over the fact table: each passes or not, with what it found; a blocking one stops what comes after it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import rate, units_between
from tidemark.operators import contracts

SAMPLES = 20


class Blocked(RuntimeError):
    pass


@dataclass
class Check:
    name: str
    passed: bool
    blocking: bool
    metadata: dict


def expected_sources(fct: DataFrame, expected: Sequence[str], now, hours: int = 2) -> DataFrame:
    """source, reported: whether each expected source was fetched in the last hours."""
    there = contracts.reported_since(fct, now, hours).withColumn("_there", F.lit(True))
    known = fct.sparkSession.createDataFrame([(s,) for s in expected], "source string")
    return known.join(there, "source", "left").select("source", F.coalesce("_there", F.lit(False)).alias("reported"))


def key_counts(fct: DataFrame, key: str = "article_key") -> DataFrame:
    """One row: total, distinct."""
    return fct.agg(F.count("*").alias("total"), F.count_distinct(key).alias("distinct"))


def feed_silence(fct: DataFrame, feeds: Sequence[str], most_hours: int = 720) -> DataFrame:
    """feed_id, freshest_age_hours, state (fresh, abandoned or absent) of each declared feed."""
    age = F.min(units_between("HOUR", F.col("published_at"), F.col("fetched_at")))
    known = fct.sparkSession.createDataFrame([(f,) for f in feeds], "feed_id string")
    ages = known.join(fct.groupBy("feed_id").agg(age.alias("freshest_age_hours"), F.count("*").alias("_n")), "feed_id", "left")
    state = F.when(F.col("_n").isNull(), "absent").when(F.col("freshest_age_hours") > most_hours, "abandoned").otherwise("fresh")
    return ages.select("feed_id", "freshest_age_hours", state.alias("state"))


def low_leakage(fct: DataFrame, most: float = 0.25) -> DataFrame:
    """source, leak: the sources whose URLs seldom tell the label."""
    return fct.groupBy("source").agg(rate(F.col("url_leaks_label")).alias("leak")).where(F.col("leak") < most)


def _rows(df: DataFrame) -> list[dict]:
    return [r.asDict() for r in df.limit(SAMPLES).collect()]


def run(fct: DataFrame, labelled: DataFrame, expected: Sequence[str], feeds: Sequence[str], now) -> list[Check]:
    """All checks. Metadata hold at most SAMPLES rows of what is wrong."""
    missing = _rows(expected_sources(fct, expected, now).where("NOT reported").orderBy("source"))
    keys = key_counts(fct).first().asDict()
    silent = _rows(feed_silence(fct, feeds).where("state <> 'fresh'").orderBy("feed_id"))
    clean = _rows(low_leakage(fct).orderBy("leak", "source"))
    orphans = _rows(contracts.taxonomy_coverage(labelled).orderBy("source", "channel"))
    future = _rows(contracts.future_publication(fct).orderBy("article_key"))
    unknown = _rows(contracts.unregistered_sources(fct, expected).orderBy("source"))
    return [
        Check("every_expected_source_reported", not missing, False, {"missing": [r["source"] for r in missing]}),
        Check("article_keys_are_unique", keys["total"] == keys["distinct"], True, keys),
        Check("no_feed_has_gone_silent", not silent, False, {s: [r["feed_id"] for r in silent if r["state"] == s] for s in ("absent", "abandoned")}),
        Check("at_least_one_low_leakage_source", bool(clean), False, {"sources": {r["source"]: r["leak"] for r in clean}}),
        Check("taxonomy_covers_every_channel", not orphans, True, {"orphans": orphans}),
        Check("no_future_publication_dates", not future, False, {"articles": future}),
        Check("sources_are_all_registered", not unknown, True, {"sources": [r["source"] for r in unknown]}),
    ]


def enforce(found: Sequence[Check]) -> Sequence[Check]:
    """The checks, or Blocked where a blocking one failed."""
    bad = [c.name for c in found if c.blocking and not c.passed]
    if bad:
        raise Blocked(", ".join(bad))
    return found
