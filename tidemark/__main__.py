"""Command line: python -m tidemark COMMAND. Exit codes: 1 unhealthy or no champion, 2 unknown source or unusable split, 3 no token, 4 no export."""

from __future__ import annotations

import argparse
import functools
import json
import os
import sys

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import session
from tidemark.settings import BadSetting, Settings

STATE = "feeds.json"


def _spark() -> SparkSession:
    return session("tidemark", None if os.environ.get("SPARK_REMOTE") or os.environ.get("MASTER") else "local[*]")


def warehouse(spark: SparkSession, data: str):
    from tidemark.sources.tables import Snapshots

    return Snapshots(spark, f"{data}/warehouse")


def facts(spark: SparkSession, data: str, taxonomy: str | None) -> DataFrame:
    """The fact table over what is loaded, with a taxonomy from CSV (source, channel, kanal, confidence, notes) if there is one."""
    from tidemark.operators import articles as A

    return A.facts(A.labelled(A.deduped(A.staging(warehouse(spark, data).read("articles"))), taxonomy_of(spark, taxonomy)))


def ingest(a) -> int:
    from tidemark.sources import cycle, landing

    feeds = cycle.feeds_for(cycle.read_feeds(a.feeds), a.source)
    os.makedirs(a.data, exist_ok=True)
    own = a.settings
    poll = functools.partial(landing.fetch, retries=own.retries, base=own.backoff, breaker=own.breaker, pause=own.pause)
    report = cycle.run_cycle(_spark(), feeds, f"{a.data}/raw", f"{a.data}/{STATE}", 0 if a.no_delay else own.delay, frozenset(a.unreachable), poll=poll, lookback=own.lookback)
    print(report.summary())
    return 0 if report.healthy else 1


def load(a) -> int:
    from tidemark.sources import landing

    spark = _spark()
    print(json.dumps(landing.load(spark, f"{a.data}/raw", warehouse(spark, a.data), a.force)))
    return 0


def taxonomy_of(spark: SparkSession, path: str | None) -> DataFrame:
    shape = "source string, channel string, kanal string, confidence string, notes string"
    return spark.read.schema(shape).option("header", True).csv(path) if path else spark.createDataFrame([], shape)


def transform(a) -> int:
    """Brings facts and marts up to what is loaded, the changed days only, and runs the blocking checks; 1 if one of them fails."""
    from tidemark.operators import checks
    from tidemark.plans import daily

    spark = _spark()
    store = warehouse(spark, a.data)
    days = daily.refresh(store, taxonomy_of(spark, a.taxonomy), a.full)
    keys = checks.key_counts(daily.facts(store)).first()
    print(json.dumps({"days": days, "articles": keys["total"]}))
    return 0 if keys["total"] == keys["distinct"] else 1


def export(a) -> int:
    from tidemark.operators import articles as A

    out = a.out or f"{a.data}/export"
    stats = A.export(facts(_spark(), a.data, a.taxonomy), out)
    with open(os.path.join(out, "README.md"), "w", encoding="utf-8") as f:
        f.write(A.card(stats))
    print(json.dumps(stats, default=str, sort_keys=True))
    return 0


def publish(a) -> int:
    """Checks that an export is whole; uploads it in one commit, if the hub's client is installed. The token comes from HF_TOKEN only."""
    folder = a.export_dir or f"{a.data}/export"
    missing = [n for n in ("articles.parquet", "stats", "README.md") if not os.path.exists(os.path.join(folder, n))]
    if missing:
        print(f"error: {folder} lacks {', '.join(missing)}", file=sys.stderr)
        return 4
    files = [os.path.join(d, n) for d, _, names in os.walk(folder) for n in names if not n.startswith((".", "_"))]
    print(f"{len(files)} files, {sum(map(os.path.getsize, files))} bytes to {a.repo}")
    if a.dry_run:
        return 0
    token = os.environ.get("HF_TOKEN")
    if not token:
        print("error: HF_TOKEN is not set", file=sys.stderr)
        return 3
    from huggingface_hub import HfApi

    api = HfApi(token=token)
    api.create_repo(a.repo, repo_type="dataset", private=a.private, exist_ok=True)
    print(api.upload_folder(folder_path=folder, repo_id=a.repo, repo_type="dataset", commit_message="Export"))
    return 0


def status(a) -> int:
    from tidemark.sources import cycle

    feeds, raw = cycle.read_feeds(a.feeds), f"{a.data}/raw"
    n = _spark().read.option("recursiveFileLookup", True).text(raw).where("trim(value) <> ''").count() if os.path.isdir(raw) else 0
    print(f"landing zone: {raw}\narticles: {n}\nfeeds: {len(feeds)}")
    rates = {}
    if os.path.isdir(f"{a.data}/warehouse"):
        from tidemark.operators import articles as A

        rates = {r["source"]: r for r in A.source_rates(A.staging(warehouse(_spark(), a.data).read("articles"))).collect()}
    for s in sorted({f.source for f in feeds} | set(rates)):
        leak = f", {rates[s]['articles']} loaded, URLs tell the label of {rates[s]['leak_rate']:.1%}{'' if rates[s]['is_clean'] else ' (leaks)'}" if s in rates else ""
        print(f"  {s}: {sum(f.source == s for f in feeds)} feeds{leak}")
    return 0


def train(a) -> int:
    from tidemark.operators.training import train_and_promote

    run = train_and_promote(facts(_spark(), a.data, a.taxonomy), _registry(a), a.random_split, a.resamples)
    print(run.summary())
    return 2 if run.verdict == "UNUSABLE" else 0


def _registry(a):
    from tidemark.plans.store import Registry

    return Registry(a.registry or f"{a.data}/registry")


def champion(a) -> int:
    r = _registry(a)
    now = r.aliases()
    if not now.get("champion"):
        print("champion: none")
        return 1
    print(f"champion: {now['champion']}\nprevious: {now.get('previous') or 'none'}")
    try:
        print(json.dumps(r.meta(now["champion"]), sort_keys=True))
    except (OSError, ValueError) as e:
        print(f"its metadata can't be read: {e}")
    return 0


def rollback(a) -> int:
    from tidemark.plans.store import AliasNotSet

    try:
        print(f"champion: {_registry(a).rollback()}")
    except AliasNotSet:
        print("there is nothing to roll back to")
        return 1
    return 0


def decisions(a) -> int:
    from tidemark.plans.store import decision_summary

    r = _registry(a)
    for d in r.decisions(None if a.all else a.limit):
        print(json.dumps(d) if a.json else decision_summary(d))
    print(f"{len(r.decisions())} decisions, {len(r.decisions(refused=True))} refused")
    return 0


def serve(a) -> int:
    from tidemark.serving import Service, server

    server(Service(_spark(), _registry(a), a.settings.alias_ttl), a.host, a.port).serve_forever()
    return 0


OPTIONS: dict[str, tuple] = {
    "feeds": ("--feeds", {}), "source": ("--source", {}), "no_delay": ("--no-delay", {"action": "store_true"}), "unreachable": ("--unreachable", {"nargs": "*"}),
    "force": ("--force", {"action": "store_true"}), "taxonomy": ("--taxonomy", {}), "out": ("--out", {}), "export_dir": ("--export-dir", {}), "repo": ("--repo", {}), "private": ("--private", {"action": "store_true"}),
    "full": ("--full", {"action": "store_true"}), "json": ("--json", {"action": "store_true"}), "dry_run": ("--dry-run", {"action": "store_true"}), "registry": ("--registry", {}), "random_split": ("--random-split", {"action": "store_true"}), "resamples": ("--resamples", {"type": int, "default": 10_000}),
    "limit": ("--limit", {"type": int, "default": 10}), "all": ("--all", {"action": "store_true"}), "host": ("--host", {}), "port": ("--port", {"type": int}),
}
COMMANDS = {ingest: "feeds source no_delay unreachable", load: "force", transform: "taxonomy full", export: "taxonomy out", publish: "export_dir repo private dry_run", status: "feeds", train: "taxonomy registry random_split resamples", champion: "registry", rollback: "registry", decisions: "registry limit all json", serve: "registry host port"}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    try:
        own = Settings.from_env()
    except BadSetting as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    parser.add_argument("--data", default=own.data, help="folder of the landing zone, warehouse, export and registry")
    sub = parser.add_subparsers(required=True)
    for f, names in COMMANDS.items():
        cmd = sub.add_parser(f.__name__)
        for n in names.split():
            cmd.add_argument(OPTIONS[n][0], **OPTIONS[n][1])
            if n in ("feeds", "unreachable", "host", "port", "taxonomy"):
                cmd.set_defaults(**{n: getattr(own, n)})
        cmd.set_defaults(run=f, settings=own)
    args = parser.parse_args(argv)
    try:
        return args.run(args)
    except KeyError as e:
        print(f"error: unknown source {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    raise SystemExit(main())
