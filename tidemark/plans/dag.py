"""The models as a graph of functions, built in order of their dependencies."""

from __future__ import annotations

from collections.abc import Callable
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import articles as A
from tidemark.sources import adapters

MODELS: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "stg_articles": (("raw_articles",), A.staging),
    "int_articles_deduped": (("stg_articles",), A.deduped),
    "int_articles_labelled": (("int_articles_deduped", "taxonomy_map"), A.labelled),
    "fct_articles": (("int_articles_labelled",), A.facts),
    "mart_source_health": (("fct_articles",), A.source_health),
    "mart_feed_health": (("fct_articles",), A.feed_health),
}
ROOTS = ("raw_articles", "taxonomy_map")


def order(models: dict = MODELS) -> list[str]:
    return [m for m in TopologicalSorter({k: v[0] for k, v in models.items()}).static_order()]


def lineage_faults(models: dict = MODELS, roots: tuple[str, ...] = ROOTS) -> list[str]:
    """Dependencies that no model or root makes, and models that no root reaches."""
    out = [f"{m} needs {d}, which nothing makes" for m, (ds, _) in models.items() for d in ds if d not in models and d not in roots]
    reached, grew = set(roots), True
    while grew:
        more = {m for m, (ds, _) in models.items() if m not in reached and any(d in reached for d in ds)}
        reached, grew = reached | more, bool(more)
    return out + [f"{m} is reached from no root" for m in models if m not in reached]


def build(spark: SparkSession, sf_dir: str, *wanted: str) -> dict[str, DataFrame]:
    """The wanted models and what they need, lazily."""
    made = {"raw_articles": adapters.articles(spark, sf_dir), "taxonomy_map": adapters.taxonomy(spark, sf_dir)}

    def get(name):
        if name not in made:
            needs, f = MODELS[name]
            made[name] = f(*[get(n) for n in needs])
        return made[name]

    return {n: get(n) for n in wanted or MODELS}
