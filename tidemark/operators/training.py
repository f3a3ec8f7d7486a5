"""A training run: corpus, clusters, split, candidates, comparison with the incumbent, gate, promotion."""

from __future__ import annotations

import json
import os
import time
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import features
from tidemark.operators import evaluation as E
from tidemark.operators import similar, splits
from tidemark.operators.graph import written
from tidemark.operators.models import Candidate, Majority, TfIdfMargins, latency_ms, load_model, local_scorer
from tidemark.plans.store import AliasNotSet, Registry

CALIBRATION_ROWS = 5_000
LATENCY_ROWS = 200
WINDOWS = ((14, 7), (2, 1))  # days of training and validation cutoffs: the usual ones, then those to fall back on


@dataclass
class TrainingRun:
    verdict: str
    reasons: list[str]
    window: tuple[float, float] | None = None
    fallback: bool = False
    rows: dict[str, int] = field(default_factory=dict)
    scores: dict[str, dict] = field(default_factory=dict)
    winner: str | None = None
    artifact: str | None = None
    calibrated_on: str | None = None
    warnings: list[str] = field(default_factory=list)

    def to_dict(self) -> dict:
        return asdict(self)

    def write(self, path: str) -> None:
        """The run as JSON, replaced as a whole."""
        tmp = f"{path}.tmp"
        with open(tmp, "w", encoding="utf-8") as f:
            json.dump(self.to_dict(), f, sort_keys=True, indent=1)
        os.replace(tmp, path)

    def summary(self) -> str:
        lines = [f"verdict: {self.verdict}", *(f"  {r}" for r in self.reasons)]
        if self.window:
            lines.append(f"window: {self.window[0]}/{self.window[1]} days{' (fallback)' if self.fallback else ''}; rows: {self.rows}")
        lines += [f"  {n}: macro-F1 {s['macro_f1']:.4f}, calibration error {s['ece']:.4f}" for n, s in self.scores.items()]
        return "\n".join([*lines, *(f"  ! {w}" for w in self.warnings)])


def corpus(fct: DataFrame) -> DataFrame:
    """article_key, cluster_id (near-duplicate titles), published_at, source, kanal, label, text.

    Band buckets of over 50 titles are mostly one template and link nothing here; linked, they would put most articles into one split.
    """
    rows = fct.where("published_at IS NOT NULL AND title IS NOT NULL AND title <> ''")
    features.guarded(rows, "title", "summary")  # all that the text is made of
    rows = written(rows.select("article_key", "published_at", "source", "kanal", "title", F.col("kanal").alias("label"), features.text().alias("text")), "corpus")
    of = similar.cluster(rows.select(F.col("article_key").alias("key"), "title"), large=False).select(F.col("key").alias("article_key"), "cluster_id")
    return rows.join(of, "article_key").drop("title")


def usable(split: DataFrame) -> tuple[bool, dict[str, int]]:
    """Whether a split can be trained and tested on, and its rows."""
    found = {r["split"]: r for r in split.groupBy("split").agg(F.count("*").alias("n"), F.count_distinct("label").alias("labels")).collect()}
    n = {k: r["n"] for k, r in found.items()}
    return n.get("train", 0) >= 20 and n.get("test", 0) >= 20 and found["train"]["labels"] >= 2, n


def choose_split(rows: DataFrame, random: bool = False, seed: int = 42) -> tuple[DataFrame, tuple | None, bool, bool, dict[str, int]]:
    """(split, window, whether it is the fallback, whether it is usable, rows by split)."""
    if random:
        split = written(splits.random_split(rows, seed), "split")
        ok, n = usable(split)
        return split, None, False, ok, n
    for k, window in enumerate(WINDOWS):
        split = written(splits.temporal_split(rows, None, *window), "split")
        ok, n = usable(split)
        if ok and (k or n.get("test", 0) <= n.get("train", 0)):
            break
    return split, window, bool(k), ok, n


def calibrate(model: TfIdfMargins, held: DataFrame, fitted_on: DataFrame) -> str:
    """Sets the temperature from validation rows or, where there are none, from those of training; returns which.

    At most CALIBRATION_ROWS are taken, chosen by a hash of the key. Under two rows of known labels leave the temperature as it is.
    """
    for name, rows in (("validation", held), ("train", fitted_on)):
        few = rows.orderBy(F.xxhash64("article_key")).limit(CALIBRATION_ROWS)
        got = model.predict(few).where(F.col("label").isin(model.labels)).select("label", "probabilities").collect()
        if len(got) >= 2:
            p = np.array([[r["probabilities"][v] for v in model.labels] for r in got])
            model.temperature *= E.fit_temperature(np.log(np.maximum(p, 1e-300)), np.array([model.labels.index(r["label"]) for r in got]))
            return name
    return "none"


def scored(model: Candidate, test: DataFrame) -> tuple[dict, DataFrame]:
    """Figures of a model on the test rows, and its predictions (kept). Times are those of single texts, scored on the driver."""
    sample = [r["text"] for r in test.select("text", F.xxhash64("article_key").alias("o")).orderBy("o").limit(LATENCY_ROWS).collect()]
    took = latency_ms(local_scorer(model), sample)
    got = written(model.predict(test).select("article_key", "cluster_id", F.col("label").alias("y_true"), F.col("prediction").alias("y_pred"), "confidence"), "predictions")
    cells = E.confusion(got)
    bins = E.calibration_bins(got.withColumns({"correct": F.col("y_true") == F.col("y_pred"), "confidence": F.least("confidence", F.lit(1.0))}))
    return {"macro_f1": E.summary(cells).first()["macro_f1"], "ece": E.calibration_error(bins), "p95_ms": took["p95_ms"], "overconfident_by": E.overconfidence(bins), "cost_per_1k": model.unit_cost_usd(1000), "f1": {r["label"]: r["f1"] for r in E.class_scores(cells).collect()}}, got


def train_and_promote(fct: DataFrame, registry: Registry, random: bool = False, resamples: int = 10_000, seed: int = 42, candidates: list[Candidate] | None = None) -> TrainingRun:
    """Fits the candidates, lets the best meet the gate, records the verdict and acts on it. An empty corpus is an error."""
    rows = corpus(fct)
    if not rows.limit(1).count():
        raise ValueError("no articles to train on")
    split, window, fallback, ok, n = choose_split(rows, random, seed)
    run = TrainingRun("UNUSABLE", ["too few rows or labels in a split"], window, fallback, n)
    if not ok:
        return run
    run.warnings = splits.warnings(split)
    train, val, test = (split.where(F.col("split") == s) for s in ("train", "val", "test"))
    best = None
    for model in candidates if candidates is not None else [Majority(), TfIdfMargins()]:
        model.fit(train)
        if isinstance(model, TfIdfMargins):
            run.calibrated_on = calibrate(model, val, train)
        run.scores[model.name], got = scored(model, test)
        if best is None or run.scores[model.name]["macro_f1"] > run.scores[best[0].name]["macro_f1"]:
            best = model, got
    model, got = best
    run.winner, digest = model.name, splits.content_hash(split, {"window": window, "seed": seed})
    incumbent = comparison = hours = None
    try:
        name = registry.resolve()
        registry.meta(name, features.feature_hash())
        incumbent, old = scored(load_model(os.path.join(registry.root, "artifacts", name)), test)
        both = got.select("article_key", "y_true", F.col("y_pred").alias("challenger"), F.col("cluster_id").alias("cluster")).join(old.select("article_key", F.col("y_pred").alias("champion")), "article_key")
        c = E.mcnemar_counts(both).first()
        comparison = {"lower": E.paired_bootstrap(both, resamples=resamples, seed=seed)["lower"], "p": E.mcnemar_p(c["only_champion"], c["only_challenger"])}
        last = [d["at"] for d in registry.decisions() if d["verdict"] == "PROMOTE"]
        hours = (time.time() - max(last)) / 3600 if last else None
    except AliasNotSet:
        pass
    figures = run.scores[model.name]
    run.verdict, run.reasons = E.gate(figures | {"split_hash": digest}, comparison, incumbent, digest, n["test"], splits.cluster_leaks(split).count(), hours)
    run.artifact = registry.register({"name": model.name, "feature_hash": features.feature_hash(), "split_hash": digest, "classes": sorted(figures["f1"]), "metrics": {k: figures[k] for k in ("macro_f1", "ece")}}, model.save)
    registry.apply(run.artifact, run.verdict, run.reasons)
    os.makedirs(os.path.join(registry.root, "runs"), exist_ok=True)
    run.write(os.path.join(registry.root, "runs", f"{run.artifact}.json"))
    return run
