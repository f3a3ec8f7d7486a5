"""Staging, duplicate clusters, labels, facts and health marts over news articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import days_between, rate, trim_spaces, units_between


def staging(raw: DataFrame) -> DataFrame:
    """Typed columns and what follows from them; never filters."""
    typed = raw.withColumns({"title": trim_spaces(F.col("title")), "summary": F.coalesce(trim_spaces(F.col("summary")), F.lit(""))})
    link, published, fetched = F.lower("raw_link"), F.col("published_at"), F.col("fetched_at")
    by_channel, by_label = F.contains(link, F.lower("channel")), F.contains(link, F.split_part("kanal", F.lit("-"), F.lit(1)))
    return typed.withColumns({
        "title_chars": F.length("title").cast("long"),
        "title_words": F.size(F.split("title", " ")).cast("long"),
        "summary_chars": F.length("summary").cast("long"),
        "age_hours_at_fetch": units_between("HOUR", published, fetched),
        "missing_published_at": published.isNull(),
        "is_evergreen": F.coalesce(days_between(published, fetched) > 30, F.lit(False)),
        "published_date": F.to_date(published),
        "url_leaks_channel": by_channel,
        "url_leaks_canonical": by_label,
        "url_leaks_label": by_channel | by_label,
    })


def clusters(staged: DataFrame) -> DataFrame:
    """One row per title fingerprint. The origin is the source of the first dated article, ties by key."""
    origin = F.min(F.when(F.col("published_at").isNotNull() & F.col("source").isNotNull(), F.struct("published_at", "article_key", "source")))
    return staged.groupBy(F.col("title_fingerprint").alias("cluster_id")).agg(
        F.count("*").alias("cluster_size"), F.count_distinct("source").alias("cluster_sources"), F.count_distinct("kanal").alias("cluster_labels"),
        F.min("published_at").alias("cluster_first_seen"), origin["source"].alias("cluster_origin_source"),
    )


def deduped(staged: DataFrame) -> DataFrame:
    """Articles with their cluster. The representative comes from an aggregate too, so a cluster of any size meets in no task."""
    first = staged.groupBy(F.col("title_fingerprint").alias("cluster_id")).agg(F.min(F.struct(F.col("published_at").isNull().alias("undated"), "published_at", "article_key")).alias("_first"))
    c = clusters(staged).join(first, "cluster_id")
    joined = staged.join(c, staged["title_fingerprint"] == c["cluster_id"])
    return joined.withColumns({
        "is_exact_duplicate_group": F.col("cluster_size") > 1,
        "is_cross_source_duplicate": F.col("cluster_sources") > 1,
        "has_label_disagreement": F.col("cluster_labels") > 1,
        "is_cluster_representative": F.col("_first.article_key") == F.col("article_key"),
    }).drop("_first")


def labelled(articles: DataFrame, taxonomy: DataFrame) -> DataFrame:
    t = taxonomy.select("source", "channel", F.col("kanal").alias("mapped_kanal"), F.col("confidence").alias("mapping_confidence"), F.col("notes").alias("mapping_notes"))
    return articles.join(t, ["source", "channel"], "left").withColumns({
        "taxonomy_missing": F.col("mapped_kanal").isNull(),
        "taxonomy_conflict": F.coalesce(F.col("mapped_kanal") != F.col("kanal"), F.lit(False)),
        "label_is_judgement_call": F.coalesce(F.col("mapping_confidence") != "high", F.lit(False)),
    })


FACTS = (
    "article_key cluster_id title summary kanal label_is_judgement_call has_label_disagreement source channel feed_id canonical_url published_at published_date fetched_at age_hours_at_fetch "
    "missing_published_at is_evergreen is_cross_source_duplicate is_cluster_representative cluster_size url_leaks_label url_leaks_channel url_leaks_canonical title_chars title_words summary_chars _ingest_file"
).split()


def facts(labelled_articles: DataFrame) -> DataFrame:
    return labelled_articles.select(*FACTS)


def feed_health(fct: DataFrame) -> DataFrame:
    age = units_between("HOUR", F.col("published_at"), F.col("fetched_at"))
    out = fct.groupBy("source", "channel", "feed_id", "kanal").agg(
        F.count("*").alias("articles"), F.count_distinct("cluster_id").alias("distinct_stories"), F.min("published_at").alias("oldest_published"), F.max("published_at").alias("newest_published"),
        F.max("fetched_at").alias("last_fetched"), F.min(age).alias("freshest_age_hours"), F.median(age).alias("median_age_hours"), rate(F.col("is_evergreen")).alias("evergreen_rate"),
        rate(F.col("url_leaks_label")).alias("url_leak_rate"), rate(F.col("missing_published_at")).alias("missing_timestamp_rate"),
    )
    return out.withColumns({"looks_dormant": F.col("freshest_age_hours") > 48, "looks_abandoned": F.col("freshest_age_hours") > 720})


def source_health(fct: DataFrame) -> DataFrame:
    out = fct.groupBy("source", F.to_date("fetched_at").alias("ingest_date")).agg(
        F.count("*").alias("articles"), F.count_distinct("feed_id").alias("feeds_seen"), F.count_distinct("kanal").alias("labels_seen"), F.count_distinct("cluster_id").alias("distinct_stories"),
        F.min("fetched_at").alias("first_fetch"), F.max("fetched_at").alias("last_fetch"), F.count_distinct(F.date_trunc("HOUR", "fetched_at")).alias("hours_with_data"),
        *[rate(F.col(c)).alias(n) for c, n in (("url_leaks_label", "url_leak_rate"), ("is_evergreen", "evergreen_rate"), ("is_cross_source_duplicate", "cross_source_dup_rate"), ("missing_published_at", "missing_timestamp_rate"), ("label_is_judgement_call", "judgement_call_rate"))],
        F.round(F.avg("title_words"), 2).alias("mean_title_words"), F.round(F.avg("summary_chars"), 1).alias("mean_summary_chars"),
    )
    return out.withColumns({"_hours_covered": F.col("hours_with_data"), "has_ingestion_gap": F.col("hours_with_data") < 20})


def first_seen(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """One row of each key, the first in the given order."""
    names = [c for c in rows.columns if c != key]
    least = F.min(F.struct(*order, *[c for c in names if c not in order])).alias("_r")
    return rows.groupBy(key).agg(least).select(key, *[F.col(f"_r.{c}").alias(c) for c in names]).select(rows.columns)


def new_rows(batch: DataFrame, known: DataFrame, key: str, *order: str) -> DataFrame:
    """What a load adds: the batch's first row of each key that the table has not."""
    return first_seen(batch.join(known.select(key), key, "left_anti").select(batch.columns), key, *order)


def export_stats(fct: DataFrame) -> DataFrame:
    return fct.agg(F.count("*").alias("articles"), F.count_distinct("source").alias("sources"), F.count_distinct("kanal").alias("labels"), F.count_distinct("cluster_id").alias("stories"), F.min("published_at").alias("oldest"), F.max("published_at").alias("newest"), F.count_if(~F.col("url_leaks_label")).alias("clean_rows"))


def source_rates(fct: DataFrame) -> DataFrame:
    return fct.groupBy("source").agg(F.count("*").alias("articles"), F.round(rate(F.col("url_leaks_label")), 4).alias("leak_rate"), F.round(rate(F.col("is_evergreen")), 4).alias("evergreen_rate")).withColumn("is_clean", F.col("leak_rate") < 0.25)


def top_label(fct: DataFrame, k: int = 3) -> DataFrame:
    """The k most frequent labels, ties by name."""
    w = Window.orderBy(F.col("articles").desc(), "kanal")
    return fct.groupBy("kanal").agg(F.count("*").alias("articles")).withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


PUBLISHED = "article_key title summary kanal source channel canonical_url published_at fetched_at is_evergreen url_leaks_label cluster_id cluster_size is_cross_source_duplicate has_label_disagreement label_is_judgement_call title_words".split()


def export(fct: DataFrame, folder: str) -> dict:
    """Writes the published columns in order of publication, range by range, and returns the figures; an empty table is an error."""
    import json

    stats = export_stats(fct).first().asDict()
    if not stats["articles"]:
        raise ValueError("nothing to export: the fact table is empty")
    stats |= {"by_source": {r["source"]: {k: r[k] for k in ("articles", "leak_rate", "evergreen_rate")} for r in source_rates(fct).collect()}, "by_label": {r["kanal"]: r["n"] for r in fct.groupBy("kanal").agg(F.count("*").alias("n")).collect()}}
    fct.select(*PUBLISHED).orderBy(F.col("published_at").asc_nulls_last(), "article_key").write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/articles.parquet")
    fct.sparkSession.createDataFrame([(json.dumps(stats, default=str, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/stats")
    return stats


def card(stats: dict) -> str:
    """A dataset card from the export's figures."""
    rows = [f"| {s} | {v['articles']} | {v['leak_rate']:.4f} | {v['evergreen_rate']:.4f} |" for s, v in sorted(stats["by_source"].items())]
    clean = [s for s, v in sorted(stats["by_source"].items()) if v["leak_rate"] < 0.25]
    return "\n".join(["---", "task_categories: [text-classification]", "---", f"# {stats['articles']} articles, {stats['stories']} stories", "", f"Published {stats['oldest']} to {stats['newest']}; {stats['clean_rows']} rows whose URL does not give the label away.", "", "| source | articles | leak rate | evergreen rate |", "|-|-|-|-|", *rows, "", f"Clean sources: {', '.join(clean) or 'none'}.", ""])
