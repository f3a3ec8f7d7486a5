"""All queries of the reference's operators by name."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.functions import python as P
from tidemark.operators import articles as A
from tidemark.operators import contracts as K
from tidemark.operators import evaluation as E
from tidemark.operators import checks, linear, similar, splits
from tidemark.operators.graph import components, written
from tidemark.operators.models import Majority, TfIdfMargins
from tidemark.operators.quantiles import exact_quantiles
from tidemark.plans import daily
from tidemark.plans.dag import build
from tidemark.plans.oracle import ORACLE_SQL
from tidemark.session import bounded_batches, shared_dir
from tidemark.sources import adapters
from tidemark.sources.tables import Snapshots

__all__ = ["ORACLE_SQL", "QUERIES"]

KANAL = ["politik", "hukum-kriminal", "gaya-hidup-kesehatan"]
EXPECTED = ["src0", "src1", "src2", "srcX"]
FEEDS = ["src0:click", "src0:view", "src1:view", "src2:error", "src3:signup", "src4:purchase", "srcX:view"]
Query = Callable[[SparkSession, str], DataFrame]


def _model(name: str) -> Query:
    return lambda s, d: build(s, d, name)[name]


def _on(name: str, f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda s, d: f(build(s, d, name)[name])


def _predictions(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda s, d: f(adapters.predictions(s, d))


def _split(s, d):
    return splits.temporal_split(build(s, d, "fct_articles")["fct_articles"].select("article_key", "cluster_id", "published_at", "source", "kanal"))


def _load(s, d):
    """Files f0 to f3 are loaded; what the others add."""
    raw = adapters.articles(s, d)
    loaded = raw.where("_ingest_file < 'f4'").select(F.col("title_fingerprint").alias("article_key"))
    batch = raw.where("_ingest_file >= 'f4'").select(F.col("title_fingerprint").alias("article_key"), "_ingest_file", F.col("article_key").alias("doc_key"), "source")
    return A.new_rows(batch, loaded, "article_key", "_ingest_file", "doc_key")


def _first(s, d):
    return A.first_seen(adapters.articles(s, d).select("title_fingerprint", "_ingest_file", "article_key", "source"), "title_fingerprint", "_ingest_file", "article_key")


def _urls(s, d):
    u = adapters.page_urls(s, d)
    return u.select("page_id", C.canonical_url(F.col("raw_link")).alias("canonical_url"), C.article_key(C.canonical_url(F.col("raw_link"))).alias("article_key"))


def _url_udf(s, d):
    return adapters.page_urls(s, d).select("page_id", P.canonical_url("raw_link").alias("canonical_url"))


def _html(s, d):
    return adapters.page_urls(s, d).select("page_id", P.strip_html("html").alias("plain"), P.to_text("title", "html").alias("model_text"))


def _nfkc(s, d):
    return adapters.read(s, d, "documents").select("doc_id", F.sha2(P.to_text(F.substring_index("text", "\n", 1), "text"), 256).alias("text_hash"))


def _shingles(s, d):
    t = adapters.articles(s, d)
    folded = F.trim(F.regexp_replace(F.lower("title"), "[^a-z0-9]+", " "))
    return t.select("doc_id", F.size(C.shingles(folded)).cast("long").alias("n_shingles"))


def _clean(s, d):
    return adapters.articles(s, d).select("doc_id", C.clean_text(F.concat(F.lit("ANTARA -  Jakarta - "), F.coalesce("summary", F.lit("")), F.lit(" Baca juga: more\nthings"))).alias("cleaned"))


def _lsh(s, d):
    return similar.cluster(adapters.articles(s, d).select(F.col("article_key").alias("key"), "title")).withColumnRenamed("key", "article_key")


def _components(s, d):
    """Articles of one story are one component."""
    a = adapters.articles(s, d).select("title_fingerprint", "article_key").distinct()
    least = a.groupBy("title_fingerprint").agg(F.min("article_key").alias("b"))
    found = components(a.join(least, "title_fingerprint").select(F.col("article_key").alias("a"), "b"))
    return a.join(found, a["article_key"] == found["node"], "left").select("article_key", F.coalesce("component", "article_key").alias("component"))


def _scores(s, d):
    return E.class_scores(E.confusion(adapters.predictions(s, d), "champion"))


def _macro(s, d):
    p, out = adapters.predictions(s, d), None
    for name in ("champion", "challenger"):
        one = E.summary(E.confusion(p, name), 3).withColumn("model", F.lit(name))
        out = one if out is None else out.union(one)
    return out


def _ece(s, d):
    return E.calibration_bins(adapters.predictions(s, d).withColumn("correct", F.col("champion") == F.col("y_true")))


def _bootstrap(s, d):
    r = E.paired_bootstrap(adapters.predictions(s, d))
    return s.createDataFrame([(r["delta"], r["lower"], r["upper"], r["resamples"])], "delta double, lower double, upper double, resamples long")


def _mcnemar_p(s, d):
    r = E.mcnemar_counts(adapters.predictions(s, d)).first()
    return s.createDataFrame([(r["only_champion"], r["only_challenger"], round(E.mcnemar_p(r["only_champion"], r["only_challenger"]), 12))], "only_champion long, only_challenger long, p double")


def _gap(s, d):
    bins = E.calibration_bins(adapters.predictions(s, d).withColumn("correct", F.col("champion") == F.col("y_true")))
    return s.createDataFrame([(round(E.overconfidence(bins), 9),)], "overconfident_by double")


def _gate(s, d):
    p = adapters.predictions(s, d)
    counts, boot = E.mcnemar_counts(p).first(), E.paired_bootstrap(p)
    f1 = {m: {r["label"]: r["f1"] for r in E.class_scores(E.confusion(p, m)).collect()} for m in ("champion", "challenger")}
    ece = E.calibration_error(E.calibration_bins(p.withColumn("correct", F.col("challenger") == F.col("y_true"))))
    verdict, why = E.gate({"ece": ece, "p95_ms": 10, "cost_per_1k": 0.01, "f1": f1["challenger"]}, {"lower": boot["lower"], "p": E.mcnemar_p(counts["only_champion"], counts["only_challenger"])}, {"cost_per_1k": 0.01, "f1": f1["champion"]}, "hash", counts["rows"], 0)
    return s.createDataFrame([(verdict, why)], "verdict string, reasons array<string>")


def _majority(s, d):
    rows = adapters.predictions(s, d).select("doc_id", F.col("y_true").alias("label"))
    m = Majority()
    m.fit(rows)
    return m.predict(rows)


def _tfidf(s, d):
    rows = build(s, d, "fct_articles")["fct_articles"].where("published_at IS NOT NULL AND title <> ''").select("article_key", F.concat_ws(". ", "title", "summary").alias("text"), F.col("kanal").alias("label"))
    rows = written(linear.spread(rows, rows.count()), "corpus")
    m = TfIdfMargins(min_df=2)
    m.fit(rows)
    with bounded_batches(s):
        return written(m.predict(rows).select("article_key", "label", "prediction", "confidence"), "predictions")


def _latency(s, d):
    e = adapters.read(s, d, "events")
    q = exact_quantiles(e, ["event_type"], "value", [0.5, 0.95])
    return q.join(e.groupBy("event_type").agg(F.avg("value").alias("mean")), "event_type").select("event_type", F.col("q")[0].alias("p50"), F.col("q")[1].alias("p95"), "mean")


def _feed_ages(s, d):
    """Median and 95th percentile of the articles' age in hours by source, channel and label."""
    fct = build(s, d, "fct_articles")["fct_articles"]
    q = exact_quantiles(fct, ["source", "channel", "kanal"], "age_hours_at_fetch", [0.5, 0.95])
    return q.select("source", "channel", "kanal", F.col("q")[0].alias("median_age_hours"), F.round(F.col("q")[1], 6).alias("p95_age_hours"))


def _daily(s, d):
    """Source health by day, kept up over two loads: all files but the last, then the last one."""
    store, raw = Snapshots(s, f"{shared_dir(s)}/daily-{uuid.uuid4().hex}"), adapters.articles(s, d)
    for part in ("_ingest_file < 'f7'", "_ingest_file >= 'f7'"):
        with store.writer() as t:
            t.append("articles", raw.where(part))
        daily.refresh(store, adapters.taxonomy(s, d))
    return store.read(daily.SOURCE_HEALTH)


def _softmax(s, d):
    return adapters.read(s, d, "documents").select("doc_id", F.round(C.softmax(F.array(F.col("n_chars") / 1000.0, F.length("lang") / F.lit(1.0), F.lit(0.5)), 2.0)[0], 9).alias("p"))


def _backoff(s, d):
    return adapters.read(s, d, "events").select("event_id", C.backoff_seconds(F.lit(1.0), F.col("event_id") % 8, F.when(F.col("event_id") % 3 == 0, F.col("value"))).alias("seconds"))


QUERIES: dict[str, Query] = {
    "stg_articles": _model("stg_articles"),
    "cluster_agg": _on("stg_articles", A.clusters),
    "cluster_representative": _on("int_articles_deduped", lambda x: x.where("is_cluster_representative").select("cluster_id", "article_key", "cluster_size", "is_exact_duplicate_group", "is_cross_source_duplicate", "has_label_disagreement")),
    "label_join": _on("int_articles_labelled", lambda x: x.select("article_key", "mapped_kanal", "mapping_confidence", "taxonomy_missing", "taxonomy_conflict", "label_is_judgement_call")),
    "fct_articles": _model("fct_articles"),
    "mart_source_health": _model("mart_source_health"),
    "mart_feed_health": _model("mart_feed_health"),
    "export_stats": _on("fct_articles", A.export_stats),
    "source_rates": _on("fct_articles", A.source_rates),
    "top_label": _on("fct_articles", A.top_label),
    "published_columns": _on("fct_articles", lambda x: x.select(*A.PUBLISHED)),
    "training_corpus": _on("fct_articles", lambda x: x.where("published_at IS NOT NULL AND title IS NOT NULL AND title <> ''").select("article_key", "title", F.coalesce("summary", F.lit("")).alias("summary"), "kanal")),
    "contract_not_empty_title": _on("stg_articles", lambda x: K.not_empty_string(x, "title").select("article_key")),
    "contract_not_null_published": _on("stg_articles", lambda x: K.not_null(x, "published_at").select("article_key")),
    "contract_unique_key": _on("stg_articles", lambda x: K.unique_combination(x, "title_fingerprint", "source")),
    "contract_range": _on("stg_articles", lambda x: K.accepted_range(x, "age_hours_at_fetch", 0, 1000).select("article_key", "age_hours_at_fetch")),
    "contract_values": _on("stg_articles", lambda x: K.accepted_values(x, "kanal", KANAL)),
    "contract_expression": _on("stg_articles", lambda x: K.expression_is_true(x, "fetched_at >= published_at").select("article_key")),
    "contract_taxonomy_coverage": _on("int_articles_labelled", K.taxonomy_coverage),
    "contract_taxonomy_conflict": _on("int_articles_labelled", K.taxonomy_conflict),
    "contract_future_publication": _on("stg_articles", K.future_publication),
    "contract_silent_source": _on("mart_source_health", lambda x: K.silent_sources(x, EXPECTED)),
    "contract_abandoned_feed": _on("mart_feed_health", K.abandoned_feeds),
    "contract_clean_control": _on("fct_articles", lambda x: K.clean_control(x, "src3")),
    "contract_freshness": _on("fct_articles", lambda x: K.freshness(x, "2024-03-01 00:00:00")),
    "contract_reported_recently": _on("fct_articles", lambda x: K.reported_since(x, "2024-03-01 00:00:00", 480)),
    "contract_unregistered_source": _on("fct_articles", lambda x: K.unregistered_sources(x, EXPECTED)),
    "anti_join_load": _load,
    "first_file_wins": _first,
    "canonical_url": _urls,
    "clean_text": _clean,
    "shingle_count": _shingles,
    "dup_components": _components,
    "split_temporal": lambda s, d: _split(s, d).select("article_key", "row_split", "split"),
    "split_composition": lambda s, d: splits.composition(_split(s, d), "source", "kanal"),
    "split_compositions": lambda s, d: splits.compositions(_split(s, d), "source", "kanal"),
    "split_exact": lambda s, d: splits.exact_random_split(_split(s, d)).select("article_key", "split"),
    "feed_age_quantiles": _feed_ages,
    "source_health_by_day": _daily,
    "split_spanning": lambda s, d: splits.spanning(_split(s, d)),
    "cluster_leak": lambda s, d: splits.cluster_leaks(_split(s, d).withColumn("split", F.col("row_split"))),  # a split by rows, which must be found out
    "check_keys": _on("fct_articles", checks.key_counts),
    "check_expected_sources": _on("fct_articles", lambda x: checks.expected_sources(x, EXPECTED, "2024-03-20 00:00:00", 480)),
    "check_feed_silence": _on("fct_articles", lambda x: checks.feed_silence(x, FEEDS, 300)),
    "check_low_leakage": _on("fct_articles", lambda x: checks.low_leakage(x, 0.67)),
    "confidence_gap": _gap,
    "lsh_report": lambda s, d: similar.cluster_report(adapters.articles(s, d).select(F.col("article_key").alias("key"), "title")),
    "confusion": _predictions(lambda p: E.confusion(p, "challenger")),
    "class_scores": _scores,
    "macro_f1": _macro,
    "ece_bins": _ece,
    "mcnemar_counts": _predictions(E.mcnemar_counts),
    "majority_baseline": _majority,
    "latency_percentiles": _latency,
    "softmax": _softmax,
    "retry_backoff": _backoff,
    "canonical_url_exact": _url_udf,
    "html_text": _html,
    "nfkc_text": _nfkc,
    "lsh_clusters": _lsh,
    "split_random": lambda s, d: splits.random_split(_split(s, d)).select("article_key", "split"),
    "mcnemar_p": _mcnemar_p,
    "paired_bootstrap": _bootstrap,
    "tfidf_predictions": _tfidf,
    "gate_decision": _gate,
}
