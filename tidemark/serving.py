"""Predictions of the champion: a batch function, and a small HTTP front on the standard library."""

from __future__ import annotations

import json
import os
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.functions import features
from tidemark.functions.python import to_text
from tidemark.operators.models import load_model
from tidemark.plans.store import AliasNotSet, Champion, Registry

MOST_ARTICLES, MOST_TITLE, MOST_SUMMARY = 64, 500, 2000


class BadRequest(ValueError):
    pass


def checked(body) -> list[tuple[int, str, str]]:
    """(place, title, summary) of a request, or BadRequest. Only titles and summaries are read."""
    articles = body.get("articles") if isinstance(body, dict) else None
    if not isinstance(articles, list) or not 1 <= len(articles) <= MOST_ARTICLES:
        raise BadRequest(f"articles must be a list of 1 to {MOST_ARTICLES}")
    out = []
    for k, a in enumerate(articles):
        title, summary = (a.get("title"), a.get("summary", "")) if isinstance(a, dict) else (None, None)
        if not isinstance(title, str) or not 1 <= len(title) <= MOST_TITLE or not isinstance(summary, str) or len(summary) > MOST_SUMMARY:
            raise BadRequest(f"article {k}: title of 1 to {MOST_TITLE} and summary of at most {MOST_SUMMARY} characters")
        out.append((k, title, summary))
    return out


class Service:
    def __init__(self, spark: SparkSession, registry: Registry, ttl: float = 60):
        self.spark, self.registry = spark, registry
        self.champion = Champion(registry, self._load, ttl)

    def _load(self, name: str):
        """The model of an artifact, refused where it was made with other features."""
        self.registry.meta(name, features.feature_hash())
        return load_model(os.path.join(self.registry.root, "artifacts", name))

    def predict(self, body) -> dict:
        rows = checked(body)
        model = self.champion.get()
        start = time.perf_counter()
        texts = self.spark.createDataFrame(rows, "k int, title string, summary string").select("k", to_text(F.col("title"), F.col("summary")).alias("text"))
        got = sorted(model.predict(texts).collect(), key=lambda r: r["k"])
        took = (time.perf_counter() - start) * 1000
        probabilities = [(r["probabilities"] if "probabilities" in r else {r["prediction"]: r["confidence"]}) for r in (x.asDict() for x in got)]
        predictions = [{"kanal": r["prediction"], "confidence": round(r["confidence"], 4), "probabilities": {k: round(v, 4) for k, v in p.items()}} for r, p in zip(got, probabilities, strict=True)]
        return {"predictions": predictions, "model_id": self.champion.name, "model_name": model.name, "latency_ms": round(took, 3), "usd_per_1000": model.unit_cost_usd(1000)}

    def health(self) -> dict:
        state = self.champion
        try:
            model = state.get()
        except AliasNotSet:
            model = None
        meta = self.registry.meta(state.name) if model else {}
        status = "no_champion" if model is None else "degraded" if state.last_error else "ok"
        return {"status": status, "model_id": state.name, "model_name": model.name if model else None, "classes": meta.get("classes", []), "split_hash": meta.get("split_hash"), "reloads": state.reloads, "failed_reloads": state.failed_reloads, "last_error": state.last_error}

    def answer(self, method: str, path: str, body: bytes = b"") -> tuple[int, dict]:
        """(status, JSON) of a request."""
        if (method, path) == ("GET", "/"):
            return 200, {"name": "tidemark", "health": "/health"}
        if (method, path) == ("GET", "/health"):
            return 200, self.health()
        if (method, path) != ("POST", "/predict"):
            return 404, {"detail": "not found"}
        try:
            return 200, self.predict(json.loads(body))
        except AliasNotSet as e:
            return 503, {"detail": f"no champion: {e}"}
        except ValueError as e:
            return 422, {"detail": str(e)}


def server(service: Service, host: str = "127.0.0.1", port: int = 8000) -> ThreadingHTTPServer:
    class Handler(BaseHTTPRequestHandler):
        def _reply(self, body: bytes = b"") -> None:
            status, made = service.answer(self.command, self.path, body)
            out = json.dumps(made).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(out)))
            self.end_headers()
            self.wfile.write(out)

        def do_GET(self) -> None:
            self._reply()

        def do_POST(self) -> None:
            self._reply(self.rfile.read(int(self.headers.get("Content-Length") or 0)))

        def log_message(self, *args) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)
