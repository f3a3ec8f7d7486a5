"""Exact order statistics of groups of any size: selection by refining brackets, without sorting a group or holding it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.graph import written

SPLITS = 64  # parts into which a round cuts a bracket
FEW = 2048  # distinct values of a bracket that are looked at one by one
BROADCAST_TARGETS = 50_000


def _meet(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join on equal names, nulls being equal; the names come once."""
    other = right.withColumnsRenamed({c: f"_r_{c}" for c in names})
    return left.join(other, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in names], how).drop(*[f"_r_{c}" for c in names])


def _bracketed(cells: DataFrame, targets: DataFrame, by: list[str], small: bool) -> DataFrame:
    """Cells with each target in whose bracket they lie. Few targets are broadcast; many go by a merge join, whose hot groups Spark splits at run time."""
    inside = (F.col("low").isNull() | (F.col("v") >= F.col("low"))) & (F.col("high").isNull() | (F.col("v") <= F.col("high")))
    return _meet(cells, F.broadcast(targets) if small else targets.hint("merge"), by).where(inside)


def order_statistics(cells: DataFrame, targets: DataFrame, by: list[str]) -> DataFrame:
    """by, rank, value: of each target (by, rank from 0) the value at that rank. cells: by, v, n (rows of that value), written; ranks lie within the group.

    A round takes the approximate quantiles of the distinct values in each bracket as new bounds, counts what lies between them, and goes on with the part that holds the
    rank. Both are partial aggregates: a task sends a sketch and SPLITS counts a target. Brackets of FEW values are then read off.
    """
    key = [*by, "rank"]
    targets = written(targets.select(*key, F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"), F.lit(0).cast("long").alias("below")), "targets")
    small = targets.limit(BROADCAST_TARGETS + 1).count() <= BROADCAST_TARGETS
    shares = F.array(*[F.lit(k / SPLITS) for k in range(1, SPLITS)])
    while True:
        held = _bracketed(cells, targets, by, small)
        stats = written(held.groupBy(*key, "low", "high", "below").agg(F.count("*").alias("k"), F.min("v").alias("_min"), F.max("v").alias("_max"), F.percentile_approx("v", shares, SPLITS * 16).alias("cuts")), "brackets")
        if not stats.where(F.col("k") > FEW).limit(1).count():
            break
        # Part p holds the values above cuts[p - 1] up to cuts[p]; brackets that are small already stay as they are.
        cuts = stats.select(*key, "low", "high", "below", F.when(F.col("k") > FEW, F.array_distinct("cuts")).otherwise(F.array(F.col("_max"))).alias("cuts"))
        held = _bracketed(cells, cuts, by, small).withColumn("part", F.expr("size(filter(cuts, c -> c < v))"))
        parts = held.groupBy(*key, "below", "part").agg(F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        chosen = parts.groupBy(*key, "below").agg(F.array_sort(F.collect_list(F.struct("part", "n", "low", "high"))).alias("parts"))  # at most SPLITS parts
        run = F.expr("aggregate(parts, named_struct('at', below, 'hit', cast(null as struct<low: double, high: double, below: bigint>)), (s, p) -> named_struct('at', s.at + p.n, 'hit', coalesce(s.hit, if(rank < s.at + p.n, named_struct('low', p.low, 'high', p.high, 'below', s.at), null))))")
        targets = written(chosen.select(*key, run.alias("r")).select(*key, "r.hit.low", "r.hit.high", "r.hit.below"), "targets")
    last = _bracketed(cells, targets, by, small).groupBy(*key, "below").agg(F.array_sort(F.collect_list(F.struct("v", "n"))).alias("own"))
    found = F.expr("aggregate(own, named_struct('at', below, 'v', cast(null as double)), (s, p) -> named_struct('at', s.at + p.n, 'v', coalesce(s.v, if(rank < s.at + p.n, p.v, null)))).v")
    return last.select(*key, found.alias("value"))


def exact_quantiles(rows: DataFrame, by: list[str], value: str, shares: list[float]) -> DataFrame:
    """by, q (an array, a value for each share, linear between neighbouring ranks): what `percentile` gives, for groups of any size. Nulls don't count; groups of nulls alone have null."""
    if not by:
        return exact_quantiles(rows.select(F.lit(0).alias("_all"), value), ["_all"], value, shares).select("q")
    plain = rows.select(*by, F.col(value).cast("double").alias("v"))
    cells = written(plain.where("v IS NOT NULL").groupBy(*by, "v").agg(F.count("*").alias("n")), "cells")
    groups = written(plain.groupBy(*by).agg(F.count("v").alias("n")), "groups")
    place = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), (F.lit(s) * (F.col("n") - 1)).alias("at")) for k, s in enumerate(shares)])).alias("p")
    asked = groups.where("n > 0").select(*by, place).select(*by, "p.k", "p.at").withColumns({"first": F.floor("at"), "second": F.ceil("at")})
    targets = asked.select(*by, F.explode(F.array_distinct(F.array("first", "second"))).alias("rank")).distinct()
    values = order_statistics(cells, targets, by)
    got = asked.select(*by, "k", "at", "first", F.explode(F.array_distinct(F.array("first", "second"))).alias("rank"))
    got = _meet(got, values, [*by, "rank"])
    weight = F.when(F.col("rank") == F.col("first"), 1 - (F.col("at") - F.col("first"))).otherwise(F.col("at") - F.col("first"))
    each = got.groupBy(*by, "k").agg(F.sum(weight * F.col("value")).alias("value"))
    each = each.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "value"))), lambda x: x["value"]).alias("q"))
    return _meet(groups.drop("n"), each, by, "left")
