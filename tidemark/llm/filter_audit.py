"""Operator 11, an audit of how filters interact: what each of five filters removes in each of their 120 orders.

Method. Each document's failures are found once and written. The orders form a trie; what a prefix leaves does not depend on its order, so each
unordered prefix is one state. The walk goes down depth first: a state's survivors are a persisted DataFrame, made from its parent's by applying
one filter; an aggregate over them counts what each further filter really removes there; a state seen before is not entered again. So 31 states
and 80 edges stand for 120 orders of five steps, and at most five survivor frames are persisted at a time.

Scale. Texts are read once; behind that a row is a few flags, an id and, for the search for copies, a digest. Copies are found by an aggregate
over digests; the smallest ids of the HOT largest groups of copies are broadcast, those of the others joined, so a group of any size is split
over the tasks. Counts are partial sums by part; only rows of (part, edge) leave a state. Survivors lost with an executor are filtered anew.

Defined cases. Null text: empty (no words, fails A; identical to other null or empty texts). Null source: part ''. A null doc_id is neither a
copy nor a smaller original. Rows of equal doc_id and text are not smaller than one another: neither fails E for the other. Labels of a doc_id that come
several times count if any says so; documents without labels are never lost as good or toxic. Texts are equal if their SHA-256 is. Empty and very
long texts are as others, an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common

FILTERS = "ABCDE"
LEAST_WORDS = 200
HOT = 1000


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text, and A to D: whether the document fails that filter."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = plain.withColumn("words", F.expr(r"filter(split(text, '[ \\t-\\r]+'), w -> w <> '')"))
    counted = words.select("doc_id", "part", "text", F.size("words").alias("n"), F.size(F.array_distinct("words")).alias("distinct"))
    capitals = F.length("text") - F.length(F.regexp_replace("text", "[A-Z]+", ""))
    return counted.select(
        "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), (F.col("n") < LEAST_WORDS).alias("A"), (100 * F.col("distinct").cast("long") < 50 * F.col("n").cast("long")).alias("B"),
        (100 * capitals.cast("long") > 2 * F.length("text").cast("long")).alias("C"), F.col("text").rlike("[#$%&*|]").alias("D"),
    )


def marked_copies(rows: DataFrame) -> DataFrame:
    """rows without digest, with E: whether a row of a smaller doc_id has the same digest. rows must be a written table."""
    groups = common.materialize(rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1"), "copies")
    hot = common.materialize(groups.orderBy(F.col("n").desc(), "digest").limit(HOT), "hot")  # at most HOT rows
    late = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).alias("E")
    names = [c for c in rows.columns if c != "digest"]
    is_hot = F.broadcast(hot.select("digest"))
    among_hot = rows.join(F.broadcast(hot.select("digest", "first")), "digest").select(*names, late)
    others = rows.join(is_hot, "digest", "left_anti").join(groups.join(is_hot, "digest", "left_anti").select("digest", "first"), "digest", "left").select(*names, late)
    return among_hot.unionByName(others)


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, A to E (fails that filter), good and toxic, a row for each document; written."""
    rows = marked_copies(common.materialize(failures(docs), "failures"))
    of = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    no = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return common.materialize(rows.join(of, "doc_id", "left").select("part", *FILTERS, no("good"), no("toxic")), "verdicts")


def walk(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Of each edge of the trie: state (the filters before it, in order of name), filter, part, n (documents that come to it), removed, good_lost, toxic_lost.

    Parts of which nothing comes to an edge have no row for it.
    """
    spark, path, seen = rows.sparkSession, common.fresh_path(rows.sparkSession, "edges"), set()
    shape = "state string, filter string, part string, n long, removed long, good_lost long, toxic_lost long"

    def visit(state: str, survivors: DataFrame) -> None:
        seen.add(state)
        rest = [f for f in filters if f not in state]
        survivors = survivors.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counts = [F.struct(F.lit(f).alias("filter"), F.count_if(f).alias("removed"), F.count_if(F.col(f) & F.col("good")).alias("good_lost"), F.count_if(F.col(f) & F.col("toxic")).alias("toxic_lost")) for f in rest]
            got = survivors.groupBy("part").agg(F.count("*").alias("n"), F.array(*counts).alias("edges"))
            got.select(F.lit(state).alias("state"), "part", "n", F.inline("edges")).select("state", "filter", "part", "n", "removed", "good_lost", "toxic_lost").coalesce(8).write.mode("append").parquet(path)
            for f in rest:
                after = "".join(sorted(state + f))
                if after not in seen and len(after) < len(filters):
                    visit(after, survivors.where(~F.col(f)))
        finally:
            survivors.unpersist()

    visit("", rows)
    return spark.read.schema(shape).parquet(path)


def _plan(filters: str) -> tuple[str, str]:
    """JSON of all edges, with the number of orders that use each, and of all steps of all orders."""
    n = len(filters)
    orders = ["".join(p) for p in permutations(filters)]
    steps = [{"filter_order": o, "step": k + 1, "filter": f, "state": "".join(sorted(o[:k]))} for o in orders for k, f in enumerate(o)]
    edges = {(s["state"], s["filter"]): factorial(len(s["state"])) * factorial(n - 1 - len(s["state"])) for s in steps}
    return json.dumps([{"state": s, "filter": f, "orders": k} for (s, f), k in sorted(edges.items())]), json.dumps(steps)


def audit(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley; rows: written verdicts."""
    edges, steps = _plan(filters)
    spread = walk(rows, filters)
    failed = [F.count_if(f).alias(f"all_{f}") for f in filters]
    alone = [F.count_if(F.col(f) & ~F.expr(" OR ".join(g for g in filters if g != f))).alias(f"only_{f}") for f in filters]
    of = F.array(*[F.struct(F.lit(f).alias("filter"), F.col(f"all_{f}").alias("failed"), F.col(f"only_{f}").alias("unique_fails")) for f in filters])
    parts = rows.groupBy("part").agg(*failed, *alone).select("part", F.inline(of))
    every = F.inline(F.filter(F.from_json(F.lit(edges), "array<struct<state: string, filter: string, orders: long>>"), lambda e: e["filter"] == F.col("filter")))
    dense = parts.select("part", "failed", "unique_fails", every)
    dense = dense.join(spread, ["part", "state", "filter"], "left").na.fill(0, ["n", "removed", "good_lost", "toxic_lost"])
    dense = common.materialize(dense, "dense")
    value = dense.groupBy("part", "filter").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    spark = rows.sparkSession
    plan = spark.range(1).select(F.inline(F.from_json(F.lit(steps), "array<struct<filter_order: string, step: int, filter: string, state: string>>")))  # 120 orders of 5 steps
    return dense.join(value, ["part", "filter"]).join(F.broadcast(plan), ["state", "filter"]).select(
        "part", "filter_order", "step", (F.col("n") - F.col("removed")).alias("kept"), "removed", (F.col("failed") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(verdicts(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")))


OP11_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM t),
firsts AS (SELECT text, min(doc_id) AS first FROM t GROUP BY text),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) = 1 AS good, max(CAST(toxic = 1 AS INTEGER)) = 1 AS toxic FROM labels GROUP BY doc_id),
v AS (SELECT part, [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text), regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > first, false)] AS f,
  coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM w JOIN firsts USING (text) LEFT JOIN l USING (doc_id)),
cells AS (SELECT part, f, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM v GROUP BY part, f),
x AS (SELECT unnest([1, 2, 3, 4, 5]) AS k),
orders AS (SELECT [a.k, b.k, c.k, d.k, e.k] AS o FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
steps AS (SELECT o, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, s.k AS step, o[s.k] AS own FROM orders, x s),
counted AS (SELECT part, filter_order, step, any_value(own) AS own,
  coalesce(sum(n) FILTER (WHERE NOT list_bool_or(list_transform(o[1:step], lambda i: f[i]))), 0) AS kept,
  coalesce(sum(n) FILTER (WHERE f[own] AND NOT coalesce(list_bool_or(list_transform(o[1:step - 1], lambda i: f[i])), false)), 0) AS removed,
  coalesce(sum(n) FILTER (WHERE f[own] AND coalesce(list_bool_or(list_transform(o[1:step - 1], lambda i: f[i])), false)), 0) AS redundant,
  coalesce(sum(n) FILTER (WHERE f[own] AND len(list_filter(f, lambda b: b)) = 1), 0) AS unique_fails,
  coalesce(sum(good) FILTER (WHERE f[own] AND NOT coalesce(list_bool_or(list_transform(o[1:step - 1], lambda i: f[i])), false)), 0) AS good_lost,
  coalesce(sum(toxic) FILTER (WHERE f[own] AND NOT coalesce(list_bool_or(list_transform(o[1:step - 1], lambda i: f[i])), false)), 0) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""
