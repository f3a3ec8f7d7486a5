"""DuckDB SQL for the queries, over the same adapter relations."""

from __future__ import annotations

from tidemark.functions.columns import PREFIXES

_CTE = {
    "articles": r"""SELECT *, 'https://' || source || '.example/' || CASE doc_id % 3 WHEN 0 THEN channel WHEN 1 THEN split_part(kanal, '-', 1) ELSE 'news' END || '/' || doc_id AS raw_link,
 'https://' || source || '.example/' || CASE doc_id % 3 WHEN 0 THEN channel WHEN 1 THEN split_part(kanal, '-', 1) ELSE 'news' END || '/' || doc_id AS canonical_url,
 sha256(trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g'))) AS title_fingerprint
FROM (SELECT d.doc_id, sha256(CAST(d.doc_id AS VARCHAR)) AS article_key, CASE WHEN d.doc_id % 83 = 0 THEN '  ' ELSE split_part(d.text, chr(10), 1) END AS title,
 CASE WHEN d.doc_id % 11 <> 0 THEN substr(d.text, length(split_part(d.text, chr(10), 1)) + 2) END AS summary,
 CASE WHEN d.doc_id % 7 = 0 THEN 'ekonomi' WHEN d.lang = 'en' THEN 'politik' WHEN d.lang = 'de' THEN 'hukum-kriminal' WHEN d.lang = 'fr' THEN 'gaya-hidup-kesehatan' ELSE 'ekonomi' END AS kanal,
 d.source, e.event_type AS channel, d.source || ':' || e.event_type AS feed_id, CASE WHEN d.doc_id % 97 <> 0 THEN e.sent END AS published_at,
 CASE WHEN d.doc_id % 89 = 0 THEN e.sent - INTERVAL 2 HOUR ELSE e.sent + to_hours(CAST(d.doc_id * 37 % 1500 AS INTEGER)) END AS fetched_at,
 CAST(1 AS INTEGER) AS schema_version, e.props AS extra, 'f' || (d.doc_id % 8) AS _ingest_file
 FROM documents d LEFT JOIN (SELECT *, ts + to_days(CAST(event_id * 13 % 28 AS INTEGER)) AS sent FROM events) e ON e.event_id = d.doc_id)""",
    "taxonomy": """SELECT source, channel, CASE WHEN source = 'src1' THEN 'olahraga' ELSE 'ekonomi' END AS mapped_kanal,
 CASE (CASE channel WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END) % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS mapping_confidence, 'generated' AS mapping_notes
FROM (SELECT DISTINCT source, channel FROM articles) WHERE NOT (source = 'src0' AND channel = 'click')""",
    "stg": """SELECT * REPLACE (trim(title) AS title, coalesce(trim(summary), '') AS summary), length(trim(title)) AS title_chars, len(string_split(trim(title), ' ')) AS title_words, length(coalesce(trim(summary), '')) AS summary_chars,
 date_diff('hour', published_at, fetched_at) AS age_hours_at_fetch, published_at IS NULL AS missing_published_at, coalesce(date_diff('day', published_at, fetched_at) > 30, false) AS is_evergreen, CAST(published_at AS DATE) AS published_date,
 contains(lower(raw_link), lower(channel)) AS url_leaks_channel, contains(lower(raw_link), split_part(kanal, '-', 1)) AS url_leaks_canonical, contains(lower(raw_link), lower(channel)) OR contains(lower(raw_link), split_part(kanal, '-', 1)) AS url_leaks_label FROM articles""",
    "clusters": """SELECT title_fingerprint AS cluster_id, count(*) AS cluster_size, count(DISTINCT source) AS cluster_sources, count(DISTINCT kanal) AS cluster_labels, min(published_at) AS cluster_first_seen,
 min({'p': published_at, 'k': article_key, 's': source}) FILTER (WHERE published_at IS NOT NULL).s AS cluster_origin_source FROM stg GROUP BY 1""",
    "deduped": """SELECT a.*, c.*, c.cluster_size > 1 AS is_exact_duplicate_group, c.cluster_sources > 1 AS is_cross_source_duplicate, c.cluster_labels > 1 AS has_label_disagreement,
 row_number() OVER (PARTITION BY c.cluster_id ORDER BY a.published_at ASC NULLS LAST, a.article_key) = 1 AS is_cluster_representative FROM stg a JOIN clusters c ON c.cluster_id = a.title_fingerprint""",
    "labelled": """SELECT a.*, t.mapped_kanal, t.mapping_confidence, t.mapping_notes, t.mapped_kanal IS NULL AS taxonomy_missing, coalesce(t.mapped_kanal <> a.kanal, false) AS taxonomy_conflict,
 coalesce(t.mapping_confidence <> 'high', false) AS label_is_judgement_call FROM deduped a LEFT JOIN taxonomy t ON t.source = a.source AND t.channel = a.channel""",
    "fct": """SELECT article_key, cluster_id, title, summary, kanal, label_is_judgement_call, has_label_disagreement, source, channel, feed_id, canonical_url, published_at, published_date, fetched_at, age_hours_at_fetch, missing_published_at,
 is_evergreen, is_cross_source_duplicate, is_cluster_representative, cluster_size, url_leaks_label, url_leaks_channel, url_leaks_canonical, title_chars, title_words, summary_chars, _ingest_file FROM labelled""",
    "source_health": """SELECT *, hours_with_data AS _hours_covered, hours_with_data < 20 AS has_ingestion_gap FROM (SELECT source, CAST(fetched_at AS DATE) AS ingest_date, count(*) AS articles, count(DISTINCT feed_id) AS feeds_seen,
 count(DISTINCT kanal) AS labels_seen, count(DISTINCT cluster_id) AS distinct_stories, min(fetched_at) AS first_fetch, max(fetched_at) AS last_fetch, count(DISTINCT date_trunc('hour', fetched_at)) AS hours_with_data,
 avg(CASE WHEN url_leaks_label THEN 1.0::DOUBLE ELSE 0 END) AS url_leak_rate, avg(CASE WHEN is_evergreen THEN 1.0::DOUBLE ELSE 0 END) AS evergreen_rate, avg(CASE WHEN is_cross_source_duplicate THEN 1.0::DOUBLE ELSE 0 END) AS cross_source_dup_rate,
 avg(CASE WHEN missing_published_at THEN 1.0::DOUBLE ELSE 0 END) AS missing_timestamp_rate, avg(CASE WHEN label_is_judgement_call THEN 1.0::DOUBLE ELSE 0 END) AS judgement_call_rate, round(avg(title_words), 2) AS mean_title_words,
 round(avg(summary_chars), 1) AS mean_summary_chars FROM fct GROUP BY 1, 2)""",
    "feed_health": """SELECT *, freshest_age_hours > 48 AS looks_dormant, freshest_age_hours > 720 AS looks_abandoned FROM (SELECT source, channel, feed_id, kanal, count(*) AS articles, count(DISTINCT cluster_id) AS distinct_stories,
 min(published_at) AS oldest_published, max(published_at) AS newest_published, max(fetched_at) AS last_fetched, min(date_diff('hour', published_at, fetched_at)) AS freshest_age_hours, median(date_diff('hour', published_at, fetched_at)) AS median_age_hours,
 avg(CASE WHEN is_evergreen THEN 1.0::DOUBLE ELSE 0 END) AS evergreen_rate, avg(CASE WHEN url_leaks_label THEN 1.0::DOUBLE ELSE 0 END) AS url_leak_rate, avg(CASE WHEN missing_published_at THEN 1.0::DOUBLE ELSE 0 END) AS missing_timestamp_rate FROM fct GROUP BY 1, 2, 3, 4)""",
    "split": """SELECT *, CASE WHEN published_at <= t - INTERVAL 14 DAY THEN 'train' WHEN published_at <= t - INTERVAL 7 DAY THEN 'val' ELSE 'test' END AS row_split,
 CASE WHEN last <= t - INTERVAL 14 DAY THEN 'train' WHEN last <= t - INTERVAL 7 DAY THEN 'val' ELSE 'test' END AS split FROM (SELECT *, max(published_at) OVER (PARTITION BY cluster_id) AS last, max(published_at) OVER () AS t FROM fct)""",
    "pred": """SELECT l.doc_id, CASE WHEN l.quality = 1 THEN 'good' ELSE 'bad' END AS y_true, CASE WHEN (CASE WHEN n_chars % 3 = 0 THEN 1 - quality ELSE quality END) = 1 THEN 'good' ELSE 'bad' END AS champion,
 CASE WHEN (CASE WHEN n_chars % 5 = 0 THEN 1 - quality ELSE quality END) = 1 THEN 'good' ELSE 'bad' END AS challenger, (n_chars % 1000) / 1000.0::DOUBLE AS confidence FROM labels l JOIN documents d ON d.doc_id = l.doc_id""",
}
_NEEDS = {"taxonomy": ["articles"], "stg": ["articles"], "clusters": ["stg"], "deduped": ["stg", "clusters"], "labelled": ["deduped", "taxonomy"], "fct": ["labelled"], "source_health": ["fct"], "feed_health": ["fct"], "split": ["fct"]}


def _with(*names: str, sql: str, recursive: str = "") -> str:
    order: list[str] = []

    def add(n):
        for m in _NEEDS.get(n, []):
            add(m)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + (recursive and "RECURSIVE ") + ",\n".join([f"{n} AS MATERIALIZED ({_CTE[n]})" for n in order] + [recursive] * bool(recursive)) + "\n" + sql


_SCORES = """SELECT label, CAST(support AS BIGINT) AS support, CAST(predicted AS BIGINT) AS predicted, CAST(hits AS BIGINT) AS hits, CASE WHEN predicted = 0 THEN 0.0::DOUBLE ELSE hits / predicted END AS precision, hits / support AS recall,
 CASE WHEN hits = 0 THEN 0.0::DOUBLE ELSE 2 * (hits / predicted) * (hits / support) / ((hits / predicted) + (hits / support)) END AS f1
FROM (SELECT label, count(*) FILTER (WHERE y_true = label) AS support, count(*) FILTER (WHERE {m} = label) AS predicted, count(*) FILTER (WHERE y_true = label AND {m} = label) AS hits
 FROM pred, (SELECT DISTINCT y_true AS label FROM pred) GROUP BY label)"""
_MACRO = "SELECT avg(f1) AS macro_f1, sum(hits) / sum(support) AS accuracy, CAST(sum(support) AS BIGINT) AS rows, count(*) AS classes_evaluated, 3 - count(*) AS classes_absent, '{m}' AS model FROM ({s})"
_PUBLISHED = "article_key, title, summary, kanal, source, channel, canonical_url, published_at, fetched_at, is_evergreen, url_leaks_label, cluster_id, cluster_size, is_cross_source_duplicate, has_label_disagreement, label_is_judgement_call, title_words"
_URL = r"""SELECT page_id, canonical_url, sha256(canonical_url) AS article_key FROM (SELECT page_id, 'https://' || host || port || CASE WHEN path IN ('', '/') THEN '/' ELSE regexp_replace(path, '/+$', '') END || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS canonical_url
FROM (SELECT page_id, regexp_replace(lower(regexp_extract(trim(url), '^(?i:https?:)?//([^/?#:]+)', 1)), '^www\.', '') AS host, CASE WHEN regexp_extract(trim(url), '^(?i:https?:)?//[^/?#:]+(:\d+)?', 1) IN (':80', ':443') THEN '' ELSE regexp_extract(trim(url), '^(?i:https?:)?//[^/?#:]+(:\d+)?', 1) END AS port,
 regexp_replace(regexp_extract(trim(url), '^(?i:https?:)?//[^/?#]+([^?#]*)', 1), '/{2,}', '/', 'g') AS path,
 list_sort(list_transform(list_filter(string_split(regexp_extract(trim(url), '^[^?#]*\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '(?i)^((utm_|pk_|mtm_|_ga).*|(fbclid|gclid|igshid|mc_cid|mc_eid|ref|source|medium|campaign|amp|spec)(=.*)?)$')), lambda p: CASE WHEN contains(p, '=') THEN p ELSE p || '=' END)) AS kept FROM pages))"""
_ECE = """c AS (SELECT confidence AS c, count(*) AS n, count(*) FILTER (WHERE champion = y_true) AS hits FROM pred GROUP BY 1),
r AS (SELECT *, sum(n) OVER (ORDER BY c) AS upto, sum(n) OVER () AS total FROM c),
ends AS (SELECT 0::BIGINT AS bin, min(upto) AS done, any_value(total) AS total FROM r WHERE upto >= least(greatest(1, total // 15), total)
 UNION ALL SELECT bin + 1, (SELECT min(upto) FROM r WHERE upto >= least(ends.done + greatest(1, r.total // 15), r.total)), total FROM ends WHERE done < total)"""

_CLEAN = "SELECT doc_id, trim(regexp_replace({x}, '(?is)\\s*(Baca juga\\s*:.*|Simak selengkapnya.*|\\(\\s*Baca\\s*:.*\\)|Artikel ini telah tayang.*)$', '')) AS cleaned FROM articles"
_x = "trim(regexp_replace('ANTARA -  Jakarta - ' || coalesce(summary, '') || ' Baca juga: more' || chr(10) || 'things', '\\s+', ' ', 'g'))"
for _prefix in PREFIXES * 2:
    _x = f"regexp_replace({_x}, '(?i){_prefix}', '')"
_CLEAN = _CLEAN.format(x=_x)

ORACLE_SQL: dict[str, str] = {
    "stg_articles": _with("stg", sql="SELECT * FROM stg"),
    "cluster_agg": _with("clusters", sql="SELECT * FROM clusters"),
    "cluster_representative": _with("deduped", sql="SELECT cluster_id, article_key, cluster_size, is_exact_duplicate_group, is_cross_source_duplicate, has_label_disagreement FROM deduped WHERE is_cluster_representative"),
    "label_join": _with("labelled", sql="SELECT article_key, mapped_kanal, mapping_confidence, taxonomy_missing, taxonomy_conflict, label_is_judgement_call FROM labelled"),
    "fct_articles": _with("fct", sql="SELECT * FROM fct"),
    "mart_source_health": _with("source_health", sql="SELECT * FROM source_health"),
    "mart_feed_health": _with("feed_health", sql="SELECT * FROM feed_health"),
    "export_stats": _with("fct", sql="SELECT count(*) AS articles, count(DISTINCT source) AS sources, count(DISTINCT kanal) AS labels, count(DISTINCT cluster_id) AS stories, min(published_at) AS oldest, max(published_at) AS newest, count(*) FILTER (WHERE NOT url_leaks_label) AS clean_rows FROM fct"),
    "source_rates": _with("fct", sql="SELECT *, leak_rate < 0.25 AS is_clean FROM (SELECT source, count(*) AS articles, round(avg(CASE WHEN url_leaks_label THEN 1.0::DOUBLE ELSE 0 END), 4) AS leak_rate, round(avg(CASE WHEN is_evergreen THEN 1.0::DOUBLE ELSE 0 END), 4) AS evergreen_rate FROM fct GROUP BY 1)"),
    "top_label": _with("fct", sql="SELECT * FROM (SELECT kanal, articles, row_number() OVER (ORDER BY articles DESC, kanal) AS rank FROM (SELECT kanal, count(*) AS articles FROM fct GROUP BY 1)) WHERE rank <= 3"),
    "published_columns": _with("fct", sql=f"SELECT {_PUBLISHED} FROM fct"),
    "training_corpus": _with("fct", sql="SELECT article_key, title, coalesce(summary, '') AS summary, kanal FROM fct WHERE published_at IS NOT NULL AND title IS NOT NULL AND title <> ''"),
    "contract_not_empty_title": _with("stg", sql="SELECT article_key FROM stg WHERE title IS NOT NULL AND trim(title) = ''"),
    "contract_not_null_published": _with("stg", sql="SELECT article_key FROM stg WHERE published_at IS NULL"),
    "contract_unique_key": _with("stg", sql="SELECT title_fingerprint, source, count(*) AS n FROM stg GROUP BY 1, 2 HAVING count(*) > 1"),
    "contract_range": _with("stg", sql="SELECT article_key, age_hours_at_fetch FROM stg WHERE age_hours_at_fetch < 0 OR age_hours_at_fetch > 1000"),
    "contract_values": _with("stg", sql="SELECT kanal, count(*) AS n FROM stg WHERE kanal NOT IN ('politik', 'hukum-kriminal', 'gaya-hidup-kesehatan') GROUP BY 1"),
    "contract_expression": _with("stg", sql="SELECT article_key FROM stg WHERE NOT (fetched_at >= published_at)"),
    "contract_taxonomy_coverage": _with("labelled", sql="SELECT source, channel, count(*) AS orphaned_articles FROM labelled WHERE taxonomy_missing GROUP BY 1, 2"),
    "contract_taxonomy_conflict": _with("labelled", sql="SELECT source, channel, kanal AS label_from_ingestion, mapped_kanal AS label_from_seed, count(*) AS affected_articles FROM labelled WHERE taxonomy_conflict GROUP BY 1, 2, 3, 4"),
    "contract_future_publication": _with("stg", sql="SELECT article_key, source, feed_id, published_at, fetched_at, date_diff('minute', fetched_at, published_at) AS minutes_into_the_future FROM stg WHERE published_at > fetched_at + INTERVAL 5 MINUTE"),
    "contract_silent_source": _with("source_health", sql="SELECT e.source AS silent_source, (SELECT max(ingest_date) FROM source_health) AS on_date FROM (SELECT unnest(['src0', 'src1', 'src2', 'srcX']) AS source) e WHERE e.source NOT IN (SELECT source FROM source_health WHERE ingest_date = (SELECT max(ingest_date) FROM source_health))"),
    "contract_abandoned_feed": _with("feed_health", sql="SELECT feed_id, kanal, articles, round(freshest_age_hours / 24.0::DOUBLE, 1) AS freshest_age_days, newest_published FROM feed_health WHERE looks_abandoned"),
    "contract_clean_control": _with("fct", sql="SELECT source, articles, round(leak * 100, 1) AS leak_pct FROM (SELECT source, count(*) AS articles, avg(CASE WHEN url_leaks_label THEN 1.0::DOUBLE ELSE 0 END) AS leak FROM fct WHERE source = 'src3' GROUP BY 1) WHERE leak > 0.25"),
    "contract_freshness": _with("fct", sql="SELECT source, age_hours, CASE WHEN age_hours > 6 THEN 'error' WHEN age_hours > 2 THEN 'warn' ELSE 'pass' END AS status FROM (SELECT source, date_sub('minute', max(fetched_at), TIMESTAMP '2024-03-01 00:00:00') / 60.0::DOUBLE AS age_hours FROM fct GROUP BY 1)"),
    "contract_reported_recently": _with("fct", sql="SELECT DISTINCT source FROM fct WHERE fetched_at > TIMESTAMP '2024-03-01 00:00:00' - INTERVAL 480 HOUR"),
    "contract_unregistered_source": _with("fct", sql="SELECT source, count(*) AS articles FROM fct WHERE source NOT IN ('src0', 'src1', 'src2', 'srcX') GROUP BY 1"),
    "anti_join_load": _with("articles", sql="SELECT title_fingerprint AS article_key, _ingest_file, article_key AS doc_key, source FROM articles a WHERE _ingest_file >= 'f4' AND NOT EXISTS (SELECT 1 FROM articles b WHERE b._ingest_file < 'f4' AND b.title_fingerprint = a.title_fingerprint) QUALIFY row_number() OVER (PARTITION BY title_fingerprint ORDER BY _ingest_file, a.article_key) = 1"),
    "first_file_wins": _with("articles", sql="SELECT title_fingerprint, _ingest_file, article_key, source FROM articles QUALIFY row_number() OVER (PARTITION BY title_fingerprint ORDER BY _ingest_file, article_key) = 1"),
    "canonical_url": _URL,
    "shingle_count": _with("articles", sql="SELECT doc_id, CASE WHEN length(f) = 0 THEN 0 ELSE len(list_distinct(list_transform(range(1, greatest(length(f) - 3, 1) + 1), lambda i: substr(f, i, 4)))) END AS n_shingles FROM (SELECT doc_id, trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g')) AS f FROM articles)"),
    "dup_components": _with("articles", sql="SELECT article_key, min(article_key) OVER (PARTITION BY title_fingerprint) AS component FROM articles"),
    "split_temporal": _with("split", sql="SELECT article_key, row_split, split FROM split"),
    "split_composition": _with("split", sql="SELECT split, source, kanal, count(*) AS articles FROM split GROUP BY 1, 2, 3"),
    "split_compositions": _with("split", sql="SELECT split, CASE WHEN grouping(source) = 0 THEN 'source' WHEN grouping(kanal) = 0 THEN 'kanal' END AS by, CASE WHEN grouping(source) = 0 THEN source WHEN grouping(kanal) = 0 THEN kanal END AS value, count(*) AS articles FROM split GROUP BY GROUPING SETS ((split), (split, source), (split, kanal))"),
    "split_exact": _with("fct", sql="SELECT article_key, CASE WHEN k <= CAST(floor(n * 0.7) AS BIGINT) THEN 'train' WHEN k <= CAST(floor(n * 0.7) AS BIGINT) + CAST(floor(n * 0.15) AS BIGINT) THEN 'val' ELSE 'test' END AS split FROM fct JOIN (SELECT cluster_id, row_number() OVER (ORDER BY sha256('42:' || cluster_id), cluster_id) AS k, count(*) OVER () AS n FROM (SELECT DISTINCT cluster_id FROM fct)) USING (cluster_id)"),
    "feed_age_quantiles": _with("fct", sql="SELECT source, channel, kanal, quantile_cont(age_hours_at_fetch, 0.5) AS median_age_hours, round(quantile_cont(age_hours_at_fetch, 0.95), 6) AS p95_age_hours FROM fct GROUP BY 1, 2, 3"),
    "source_health_by_day": _with("source_health", sql="SELECT * FROM source_health"),
    "split_spanning": _with("split", sql="SELECT cluster_id, count(DISTINCT row_split) AS splits FROM split GROUP BY 1 HAVING count(DISTINCT row_split) > 1"),
    "cluster_leak": _with("split", sql="SELECT cluster_id, count(DISTINCT row_split) AS splits FROM split GROUP BY 1 HAVING count(DISTINCT row_split) > 1"),
    "split_random": _with("fct", sql="SELECT article_key, CASE WHEN u < 0.7 THEN 'train' WHEN u < 0.85 THEN 'val' ELSE 'test' END AS split FROM (SELECT article_key, CAST('0x' || substr(sha256('42:' || cluster_id), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u FROM fct)"),
    "clean_text": _with("articles", sql=_CLEAN),
    "check_keys": _with("fct", sql="SELECT count(*) AS total, count(DISTINCT article_key) AS \"distinct\" FROM fct"),
    "check_expected_sources": _with("fct", sql="SELECT e.source, coalesce((SELECT bool_or(fetched_at > TIMESTAMP '2024-03-20 00:00:00' - INTERVAL 480 HOUR) FROM fct WHERE fct.source = e.source), false) AS reported FROM (SELECT unnest(['src0', 'src1', 'src2', 'srcX']) AS source) e"),
    "check_feed_silence": _with("fct", sql="SELECT f.feed_id, a.age AS freshest_age_hours, CASE WHEN a.n IS NULL THEN 'absent' WHEN a.age > 300 THEN 'abandoned' ELSE 'fresh' END AS state FROM (SELECT unnest(['src0:click', 'src0:view', 'src1:view', 'src2:error', 'src3:signup', 'src4:purchase', 'srcX:view']) AS feed_id) f LEFT JOIN (SELECT feed_id, min(date_diff('hour', published_at, fetched_at)) AS age, count(*) AS n FROM fct GROUP BY 1) a USING (feed_id)"),
    "check_low_leakage": _with("fct", sql="SELECT source, avg(CASE WHEN url_leaks_label THEN 1.0::DOUBLE ELSE 0 END) AS leak FROM fct GROUP BY 1 HAVING avg(CASE WHEN url_leaks_label THEN 1.0::DOUBLE ELSE 0 END) < 0.67"),
    "mcnemar_p": _with("pred", sql="SELECT b AS only_champion, c AS only_challenger, CASE WHEN b + c = 0 THEN 1.0::DOUBLE ELSE round(least(1.0::DOUBLE, 2 * (SELECT sum(exp(lgamma(b + c + 1.0::DOUBLE) - lgamma(i + 1.0::DOUBLE) - lgamma(b + c - i + 1.0::DOUBLE) - (b + c) * ln(2.0::DOUBLE))) FROM range(0, least(b, c) + 1) AS r(i))), 12) END AS p FROM (SELECT count(*) FILTER (WHERE champion = y_true AND challenger <> y_true) AS b, count(*) FILTER (WHERE champion <> y_true AND challenger = y_true) AS c FROM pred)"),
    "confidence_gap": _with("pred", sql="SELECT round(avg(confidence) - avg(CASE WHEN champion = y_true THEN 1.0::DOUBLE ELSE 0 END), 9) AS overconfident_by FROM pred"),
    "confusion": _with("pred", sql="SELECT y_true, challenger AS y_pred, count(*) AS n FROM pred GROUP BY 1, 2"),
    "class_scores": _with("pred", sql=_SCORES.format(m="champion")),
    "macro_f1": _with("pred", sql=" UNION ALL ".join(_MACRO.format(m=m, s=_SCORES.format(m=m)) for m in ("champion", "challenger"))),
    "ece_bins": _with("pred", recursive=_ECE, sql="SELECT e.bin, min(r.c) AS lower, max(r.c) AS upper, CAST(sum(r.n) AS BIGINT) AS n, sum(r.hits) / sum(r.n) AS accuracy, sum(r.c * r.n) / sum(r.n) AS mean_confidence FROM (SELECT bin, done, coalesce(lag(done) OVER (ORDER BY bin), 0) AS before FROM ends) e JOIN r ON r.upto > e.before AND r.upto <= e.done GROUP BY e.bin"),
    "mcnemar_counts": _with("pred", sql="SELECT count(*) AS rows, count(*) FILTER (WHERE champion = y_true AND challenger = y_true) AS both_right, count(*) FILTER (WHERE champion = y_true AND challenger <> y_true) AS only_champion, count(*) FILTER (WHERE champion <> y_true AND challenger = y_true) AS only_challenger, count(*) FILTER (WHERE champion <> y_true AND challenger <> y_true) AS both_wrong FROM pred"),
    "majority_baseline": _with("pred", sql="SELECT p.doc_id, p.y_true AS label, m.label AS prediction, m.n / m.total AS confidence FROM pred p, (SELECT y_true AS label, count(*) AS n, sum(count(*)) OVER () AS total FROM pred GROUP BY 1 ORDER BY n DESC, label LIMIT 1) m"),
    "latency_percentiles": "SELECT event_type, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.95) AS p95, avg(value) AS mean FROM events GROUP BY 1",
    "softmax": "SELECT doc_id, round(exp((a - t) / 2.0) / (exp((a - t) / 2.0) + exp((b - t) / 2.0) + exp((0.5 - t) / 2.0)), 9) AS p FROM (SELECT doc_id, n_chars / 1000.0::DOUBLE AS a, length(lang)::DOUBLE AS b, greatest(n_chars / 1000.0::DOUBLE, length(lang)::DOUBLE, 0.5::DOUBLE) AS t FROM documents)",
    "retry_backoff": "SELECT event_id, least(greatest(pow(2.0::DOUBLE, event_id % 8), coalesce(CASE WHEN event_id % 3 = 0 THEN value END, 0.0::DOUBLE)), 60.0::DOUBLE) AS seconds FROM events",
}
