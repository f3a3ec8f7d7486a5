"""Scores, calibration and significance of classifiers. Rows are reduced by aggregates; the last arithmetic is on a few numbers."""

from __future__ import annotations

import math
from bisect import bisect_left
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.graph import written


def confusion(rows: DataFrame, pred: str = "y_pred", true: str = "y_true") -> DataFrame:
    return rows.groupBy(F.col(true).alias("y_true"), F.col(pred).alias("y_pred")).agg(F.count("*").alias("n"))


def class_scores(cells: DataFrame) -> DataFrame:
    """label, support, predicted, hits, precision, recall, f1 for each label that occurs in y_true; a label never predicted scores 0."""
    one = cells.select(F.col("y_true").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"), F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0).alias("hits"))
    two = cells.select(F.col("y_pred"), F.lit(0).cast("long"), F.col("n"), F.lit(0).cast("long"))
    s = one.union(two).groupBy("label").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")]).where("support > 0")
    s = s.withColumns({"precision": F.when(F.col("predicted") == 0, F.lit(0.0)).otherwise(F.col("hits") / F.col("predicted")), "recall": F.col("hits") / F.col("support")})
    both = F.col("precision") + F.col("recall")
    return s.withColumn("f1", F.when(both == 0, F.lit(0.0)).otherwise(2 * F.col("precision") * F.col("recall") / both))


def summary(cells: DataFrame, labels: int | None = None) -> DataFrame:
    """macro_f1 over the labels present, accuracy, rows, and how many labels are present and absent."""
    s = class_scores(cells).agg(F.avg("f1").alias("macro_f1"), (F.sum("hits") / F.sum("support")).alias("accuracy"), F.sum("support").alias("rows"), F.count("*").alias("classes_evaluated"))
    return s if labels is None else s.withColumn("classes_absent", F.lit(labels) - F.col("classes_evaluated"))


def checked(rows: DataFrame) -> DataFrame:
    if rows.limit(1).count() == 0:
        raise ValueError("nothing to evaluate")
    return rows


NEAR_ROWS = 200_000


def _ends(run: DataFrame, target: int, total: int, last: float, most: int) -> list[float]:
    """Last confidences of the bins, in order. run: c, upto (rows up to and with c); most: rows of the most frequent confidence.

    A bin ends with the first confidence at which it holds `target` rows, so it is over by less than `most`, and bin k ends within k * most rows behind k * target. Only
    confidences in these spans are fetched, all at once; where they could be more than NEAR_ROWS, each end is looked up on its own.
    """
    spans = [(k * target, k * (target + most)) for k in range(1, total // target + 1)]
    ends, done = [], 0
    if sum(high - low + 1 for low, high in spans) <= NEAR_ROWS:
        near = F.lit(False)
        for low, high in spans:
            near = near | F.col("upto").between(low, high)
        found = sorted((r["upto"], r["c"]) for r in run.where(near).select("c", "upto").collect())
        look = lambda least: next(x for x in found[bisect_left(found, (least, -math.inf)) :])
    else:
        look = lambda least: tuple(run.where(F.col("upto") >= least).agg(F.min(F.struct("upto", "c")).alias("e")).first()["e"])
    while done + target <= total:
        done, c = look(done + target)
        ends.append(c)
    return ends if done == total else [*ends, last]


def calibration_bins(rows: DataFrame, bins: int = 15, confidence: str = "confidence", correct: str = "correct") -> DataFrame:
    """Bins of equal mass, each extended over equal confidences: bin, lower, upper, n, accuracy, mean_confidence.

    Rows are first counted by distinct confidence, in ranges of it. One row for each range comes together, then what lies near the ends of bins.
    """
    by = rows.groupBy(F.col(confidence).alias("c")).agg(F.count("*").alias("n"), F.sum(F.col(correct).cast("long")).alias("hits"))
    by = written(by.repartitionByRange("c").withColumn("part", F.spark_partition_id()), "confidences")
    parts = sorted(tuple(r) for r in by.groupBy("part").agg(F.sum("n"), F.min("c"), F.max("c"), F.max("n")).collect())  # a row a range
    if not parts:
        raise ValueError("nothing to calibrate")
    if min(p[2] for p in parts) < 0 or max(p[3] for p in parts) > 1:
        raise ValueError("a confidence lies outside 0 to 1")
    total, base = 0, []
    for p in parts:
        base.append((p[0], total))
        total += p[1]
    spark = rows.sparkSession
    within = Window.partitionBy("part").orderBy("c").rowsBetween(Window.unboundedPreceding, 0)
    run = by.join(F.broadcast(spark.createDataFrame(base, "part int, base long")), "part").select("c", (F.col("base") + F.sum("n").over(within)).alias("upto"))
    ends = _ends(run, max(1, total // bins), total, max(p[3] for p in parts), max(p[4] for p in parts))
    edges = spark.createDataFrame([(k, ends[k - 1] if k else -1.0, c) for k, c in enumerate(ends)], "bin long, after double, upto_c double")  # at most bins + 1 rows
    placed = by.join(F.broadcast(edges), (by["c"] > edges["after"]) & (by["c"] <= edges["upto_c"]))
    return placed.groupBy("bin").agg(F.min("c").alias("lower"), F.max("c").alias("upper"), F.sum("n").alias("n"), (F.sum("hits") / F.sum("n")).alias("accuracy"), (F.sum(F.col("c") * F.col("n")) / F.sum("n")).alias("mean_confidence"))


def calibration_error(bins: DataFrame) -> float:
    r = bins.agg(F.sum(F.col("n") * F.abs(F.col("accuracy") - F.col("mean_confidence"))).alias("s"), F.sum("n").alias("n")).first()
    return r["s"] / r["n"]


def fit_temperature(logits: np.ndarray, truth: np.ndarray, rounds: int = 200, tolerance: float = 1e-6) -> float:
    """Temperature with the smallest log loss, by ternary search between 0.05 and 20 on a logarithmic scale."""
    if len(logits) != len(truth) or not len(truth):
        raise ValueError("need as many labels as rows of scores, and at least one")

    def loss(log_t):
        z = logits / math.exp(log_t)
        z = z - z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), truth]).mean())

    low, high = math.log(0.05), math.log(20)
    for _ in range(rounds):
        if high - low < tolerance:
            break
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return math.exp((low + high) / 2)


def mcnemar_counts(rows: DataFrame, a: str = "champion", b: str = "challenger") -> DataFrame:
    ra, rb = F.col(a) == F.col("y_true"), F.col(b) == F.col("y_true")
    return rows.agg(F.count("*").alias("rows"), F.count_if(ra & rb).alias("both_right"), F.count_if(ra & ~rb).alias("only_champion"), F.count_if(~ra & rb).alias("only_challenger"), F.count_if(~ra & ~rb).alias("both_wrong"))


def mcnemar_p(b: int, c: int) -> float:
    """Exact two-sided p of b against c discordant rows."""
    n, k = b + c, min(b, c)
    if not n:
        return 1.0
    log_choose = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(k + 1)]
    return min(1.0, 2 * sum(math.exp(x - n * math.log(2)) for x in log_choose))


def _macro(true: np.ndarray, pred: np.ndarray, hits: np.ndarray) -> np.ndarray:
    f1 = np.where(true + pred > 0, 2 * hits / np.maximum(true + pred, 1e-12), 0.0)
    return np.where(true > 0, f1, 0).sum(axis=1) / np.maximum((true > 0).sum(axis=1), 1)


_BUCKETS = 64


def paired_bootstrap(rows: DataFrame, a: str = "champion", b: str = "challenger", cluster: str = "cluster", resamples: int = 10_000, seed: int = 42, confidence: float = 0.95) -> dict:
    """Difference in macro-F1 (b - a) and its interval: as many clusters as there are, drawn with replacement, `resamples` times.

    Each cluster is reduced to its counts and clusters of equal counts to one type. A resample is a multinomial draw over the types: first how
    many clusters fall to each of _BUCKETS groups of types, drawn once, then within each group on its own, so partial sums of all resamples
    (as many rows as resamples, for each group) are all that is shuffled.
    """
    labels = sorted(r[0] for r in rows.select(F.explode(F.array("y_true", a, b))).distinct().collect())
    if not labels:
        raise ValueError("nothing to resample")
    cells = [F.count_if(F.col(c) == v) for v in labels for c in ("y_true", a, b)] + [F.count_if((F.col(p) == v) & (F.col("y_true") == v)) for v in labels for p in (a, b)]
    types = rows.groupBy(cluster).agg(F.array(*cells).alias("x")).groupBy("x").agg(F.count("*").alias("m"))
    types = written(types.withColumn("bucket", F.pmod(F.xxhash64("x"), F.lit(_BUCKETS)).cast("int")), "types")
    sizes = np.zeros(_BUCKETS, np.int64)
    for r in types.groupBy("bucket").agg(F.sum("m").alias("m")).collect():
        sizes[r["bucket"]] = r["m"]
    share = np.random.default_rng(seed).multinomial(sizes.sum(), sizes / sizes.sum(), resamples)
    width = len(cells)

    def draw(frame: pd.DataFrame) -> pd.DataFrame:
        bucket = int(frame["bucket"].iloc[0])
        own = sorted((tuple(map(int, x)), int(m)) for x, m in zip(frame["x"], frame["m"], strict=True))
        x, m = np.array([t for t, _ in own], float), np.array([k for _, k in own], float)
        rng, total, step = np.random.default_rng([seed, bucket]), np.empty((resamples + 1, width)), max(1, (1 << 22) // len(m))
        for k in range(0, resamples, step):
            total[k : k + step][: resamples - k] = rng.multinomial(share[k : k + step, bucket], m / m.sum()) @ x
        total[-1] = m @ x
        out = pd.DataFrame(total, columns=[f"x{k}" for k in range(width)])
        out.insert(0, "sample", np.arange(resamples + 1))
        return out

    names = ", ".join(f"x{k} double" for k in range(width))
    sums = types.groupBy("bucket").applyInPandas(draw, f"sample long, {names}").groupBy("sample").agg(*[F.sum(f"x{k}").alias(f"x{k}") for k in range(width)]).orderBy("sample").toPandas().to_numpy()[:, 1:]
    n = len(labels)
    true, pa_, pb = (sums[:, c : 3 * n : 3] for c in range(3))
    delta = _macro(true, pb, sums[:, 3 * n + 1 :: 2]) - _macro(true, pa_, sums[:, 3 * n :: 2])
    low, high = np.quantile(delta[:-1], [(1 - confidence) / 2, (1 + confidence) / 2])
    return {"delta": float(delta[-1]), "lower": float(low), "upper": float(high), "resamples": resamples}


class GateResult(NamedTuple):
    verdict: str
    reasons: list[str]

    def summary(self) -> str:
        return "\n".join([self.verdict, *(f"  - {r}" for r in self.reasons)])


def gate(challenger: dict, comparison: dict | None, incumbent: dict | None, split_hash: str | None, n_test: int, leaks: int, hours_since_promotion: float | None = None, slo_violated: bool = False) -> GateResult:
    """PROMOTE, HOLD or REJECT and why.

    challenger and incumbent: ece, p95_ms, cost_per_1k, f1 by label, split_hash. comparison: lower (of the interval), p.
    """
    if leaks:
        return GateResult("REJECT", ["clusters lie in several splits"])
    if not split_hash:
        return GateResult("HOLD", ["the split has no hash"])
    if challenger.get("split_hash", split_hash) != split_hash:
        return GateResult("REJECT", ["scored on another split"])
    hold, reject = [], []
    if n_test < 150:
        hold.append("under 150 test rows")
    if challenger["ece"] > 0.08:
        reject.append("calibration error over 0.08")
    if challenger["p95_ms"] > 300:
        reject.append("95th percentile over 300 ms")
    cheap = challenger["cost_per_1k"] <= 0.10
    if incumbent:
        cheap = cheap or challenger["cost_per_1k"] <= 1.2 * incumbent["cost_per_1k"]
        if not (comparison and comparison["lower"] > 0.01 and comparison["p"] < 0.05):
            hold.append("no significant gain of at least 0.01")
        reject += [f"{k} falls by more than 0.05" for k, v in incumbent["f1"].items() if v - challenger["f1"].get(k, 0.0) > 0.05]
        if hours_since_promotion is not None and hours_since_promotion < 72 and not slo_violated:
            hold.append("under 72 hours since the last promotion")
    if not cheap:
        reject.append("too dear")
    return GateResult("REJECT", reject + hold) if reject else GateResult("HOLD", hold) if hold else GateResult("PROMOTE", [])


def overconfidence(bins: DataFrame) -> float:
    """Mean confidence less accuracy, over all rows of the bins."""
    r = bins.agg(F.sum(F.col("n") * (F.col("mean_confidence") - F.col("accuracy"))).alias("s"), F.sum("n").alias("n")).first()
    return r["s"] / r["n"]
