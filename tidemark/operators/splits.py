"""Splits that keep clusters whole."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.graph import running_total, written


def temporal_split(rows: DataFrame, anchor=None, train_days: float = 14, val_days: float = 7) -> DataFrame:
    """Adds row_split and split: by age at the anchor (the latest publication if none is given), the whole cluster with its latest member.

    rows: article_key, cluster_id, published_at and others. A cluster's latest date is an aggregate joined back. Empty input is an error.
    """
    if anchor is None:
        anchor = rows.agg(F.max("published_at")).first()[0]
    if anchor is None:
        raise ValueError("no dated articles to split")
    at = F.lit(anchor).cast("timestamp_ntz")
    cut = lambda d: at - F.expr(f"make_dt_interval(0, 0, 0, {d * 86400:.6f})")
    name = lambda c: F.when(c <= cut(train_days), "train").when(c <= cut(val_days), "val").otherwise("test")
    last = rows.groupBy("cluster_id").agg(F.max("published_at").alias("_last"))
    return rows.join(last, "cluster_id").withColumns({"row_split": name(F.col("published_at")), "split": name(F.col("_last"))}).drop("_last")


def random_split(rows: DataFrame, seed: int = 42, train: float = 0.7, val: float = 0.15) -> DataFrame:
    """By cluster, on a seeded hash of its id: needs no order of all ids and gives the same split anywhere."""
    u = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), "cluster_id"), 256), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    return rows.withColumn("split", F.when(u < train, "train").when(u < train + val, "val").otherwise("test"))


def exact_random_split(rows: DataFrame, seed: int = 42, train: float = 0.7, val: float = 0.15) -> DataFrame:
    """Exact shares of clusters (their number times the share, rounded down), in the order of a seeded hash of their ids, ties by id.

    The ids are ranked by ranges of the hash, so none are collected and no task holds them all. Empty input is an error.
    """
    ids = rows.select("cluster_id").distinct()
    order = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("cluster_id").cast("string")), 256)
    ranked = written(running_total(ids.withColumns({"_hash": order, "_one": F.lit(1)}), ["_hash", "cluster_id"], "_one", "_rank"), "ranks")
    n = ranked.count()
    if not n:
        raise ValueError("no clusters to split")
    a, b = int(n * train), int(n * train) + int(n * val)
    name = F.when(F.col("_rank") <= a, "train").when(F.col("_rank") <= b, "val").otherwise("test")
    return rows.drop("split").join(ranked.select("cluster_id", name.alias("split")), "cluster_id")


def spanning(split: DataFrame) -> DataFrame:
    """Clusters whose rows alone would lie in several splits."""
    return split.groupBy("cluster_id").agg(F.count_distinct("row_split").alias("splits")).where("splits > 1")


def cluster_leaks(split: DataFrame) -> DataFrame:
    """Clusters in several splits: must be empty."""
    return split.groupBy("cluster_id").agg(F.count_distinct("split").alias("splits")).where("splits > 1")


def composition(split: DataFrame, *by: str) -> DataFrame:
    return split.groupBy("split", *by).agg(F.count("*").alias("articles"))


def compositions(split: DataFrame, *by: str) -> DataFrame:
    """Articles by split, and by split with each of the other columns, in one pass: `by` says which column a row counts by (null: the split alone), `value` its value."""
    sets = [["split"], *[["split", c] for c in by]]
    got = split.groupingSets([[F.col(c) for c in s] for s in sets], "split", *by).agg(F.count("*").alias("articles"), *[F.grouping(c).alias(f"_g{k}") for k, c in enumerate(by)])
    of = lambda f: F.coalesce(*[F.when(F.col(f"_g{k}") == 0, f(c)) for k, c in enumerate(by)])
    return got.select("split", of(F.lit).alias("by"), of(lambda c: F.col(c).cast("string")).alias("value"), "articles")


def warnings(split: DataFrame, least_test: int = 150, labels: int = 8, share: float = 0.8) -> list[str]:
    out = []
    n = {r["split"]: r["n"] for r in split.groupBy("split").agg(F.count("*").alias("n")).collect()}
    top = split.where("split = 'test'").groupBy("source").agg(F.count("*").alias("n")).agg(F.max_by("source", "n").alias("s"), F.max("n").alias("n")).first()
    if n.get("test") and top["n"] > share * n["test"]:
        out.append(f"{top['s']} has more than {share:.0%} of the test rows")
    seen = {r["split"]: r["k"] for r in split.groupBy("split").agg(F.count_distinct("kanal").alias("k")).collect()}
    out += [f"{s}: {k} of {labels} labels" for s, k in sorted(seen.items()) if k < labels]
    if n.get("test", 0) > n.get("train", 0):
        out.append("more test rows than training rows")
    if n.get("test", 0) < least_test:
        out.append(f"provisional: under {least_test} test rows")
    return out


def content_hash(split: DataFrame, settings: dict) -> str:
    """Hash of the settings and of the whole assignment, whatever the order and number of rows: digests of single rows are added up."""
    part = F.conv(F.substring(F.sha2(F.concat_ws("\u0000", "article_key", "split"), 256), 1, 15), 16, 10).cast("decimal(38,0)")
    total = split.agg(F.sum(part), F.count("*")).first()
    return hashlib.sha256(json.dumps([settings, str(total[0]), total[1]], sort_keys=True, default=str).encode()).hexdigest()


@dataclass
class SplitManifest:
    """A split as it is recorded: settings, rows by split, warnings and the hash of the assignment, without the assignment itself."""

    settings: dict
    rows: dict[str, int]
    clusters: dict[str, int]
    warnings: list[str]
    content_hash: str

    @classmethod
    def of(cls, split: DataFrame, settings: dict) -> SplitManifest:
        by = {r["split"]: r for r in split.groupBy("split").agg(F.count("*").alias("n"), F.count_distinct("cluster_id").alias("c")).collect()}
        return cls(settings, {k: r["n"] for k, r in sorted(by.items())}, {k: r["c"] for k, r in sorted(by.items())}, warnings(split), content_hash(split, settings))

    def to_dict(self) -> dict:
        return asdict(self)

    def write(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as f:
            json.dump(self.to_dict(), f, sort_keys=True, default=str)

    def summary(self) -> str:
        return "\n".join([f"split {self.content_hash[:12]}", *(f"  {k}: {n} articles in {self.clusters[k]} clusters" for k, n in self.rows.items()), *(f"  ! {w}" for w in self.warnings)])


def keys(split: DataFrame, name: str) -> DataFrame:
    """The article keys of one split."""
    return split.where(F.col("split") == name).select("article_key")
