"""Model registry on files: artifacts, aliases, decisions."""

from __future__ import annotations

import hashlib
import json
import os
import threading
import time


class FeatureMismatch(ValueError):
    pass


class AliasNotSet(KeyError):
    pass


def artifact_id(meta: dict) -> str:
    return hashlib.sha256(json.dumps(meta, sort_keys=True).encode()).hexdigest()[:16]


def decision_summary(decision: dict) -> str:
    """One line: when, what, the verdict and why."""
    at = time.strftime("%Y-%m-%d %H:%M", time.gmtime(decision["at"]))
    why = "; ".join(decision.get("reasons") or ())
    return f"{at} {decision['verdict']:7} {decision['artifact']}{': ' + why if why else ''}"


class Registry:
    def __init__(self, root: str):
        self.root = root
        os.makedirs(os.path.join(root, "artifacts"), exist_ok=True)

    def _path(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    def _write(self, name: str, value) -> None:
        tmp = self._path(f"{name}.tmp")
        with open(tmp, "w", encoding="utf-8") as f:
            json.dump(value, f)
        os.replace(tmp, self._path(name))

    def aliases(self) -> dict:
        try:
            with open(self._path("aliases.json"), encoding="utf-8") as f:
                return json.load(f)
        except FileNotFoundError:
            return {}

    def register(self, meta: dict, save=None) -> str:
        """Same meta, same id; `save(folder)` writes the model once."""
        name = artifact_id(meta)
        folder = self._path("artifacts", name)
        if not os.path.exists(os.path.join(folder, "meta.json")):
            os.makedirs(folder, exist_ok=True)
            if save:
                save(folder)
            with open(os.path.join(folder, "meta.json"), "w", encoding="utf-8") as f:
                json.dump(meta, f, sort_keys=True)
        return name

    def meta(self, name: str, feature_hash: str | None = None) -> dict:
        with open(self._path("artifacts", name, "meta.json"), encoding="utf-8") as f:
            meta = json.load(f)
        if feature_hash and meta.get("feature_hash") != feature_hash:
            raise FeatureMismatch(f"{name} was made with other features")
        return meta

    def resolve(self, alias: str = "champion") -> str:
        found = self.aliases().get(alias)
        if not found:
            raise AliasNotSet(alias)
        return found

    def promote(self, name: str) -> None:
        now = self.aliases()
        if now.get("champion") != name:
            self._write("aliases.json", {"champion": name, "previous": now.get("champion")})

    def rollback(self) -> str:
        now = self.aliases()
        if not now.get("previous"):
            raise AliasNotSet("previous")
        self._write("aliases.json", {"champion": now["previous"], "previous": now["champion"]})
        return now["previous"]

    def record(self, decision: dict) -> None:
        with open(self._path("decisions.jsonl"), "a", encoding="utf-8") as f:
            f.write(json.dumps(decision | {"at": decision.get("at", time.time())}) + "\n")

    def decisions(self, last: int | None = None, refused: bool = False) -> list[dict]:
        try:
            with open(self._path("decisions.jsonl"), encoding="utf-8") as f:
                rows = [json.loads(x) for x in f if x.strip()]
        except FileNotFoundError:
            return []
        rows = [r for r in rows if not refused or r["verdict"] != "PROMOTE"]
        return rows[-last:] if last else rows

    def apply(self, name: str, verdict: str, reasons: list[str]) -> None:
        """Records a verdict and acts on it."""
        self.record({"artifact": name, "verdict": verdict, "reasons": reasons})
        if verdict == "PROMOTE":
            self.promote(name)


class Champion:
    """The resolved champion, looked up again after `ttl` seconds; if that fails, the one at hand stays."""

    def __init__(self, registry: Registry, load, ttl: float = 60, clock=time.monotonic):
        self.registry, self.load, self.ttl, self.clock = registry, load, ttl, clock
        self.name = self.model = self.last_error = None
        self.reloads = self.failed_reloads = 0
        self.looked, self.lock = -float("inf"), threading.Lock()

    def get(self):
        """The model; one caller at a time looks it up."""
        with self.lock:
            return self._get()

    def _get(self):
        if self.clock() - self.looked >= self.ttl:
            self.looked = self.clock()
            try:
                name = self.registry.resolve()
                if name != self.name:
                    self.model, self.name = self.load(name), name
                    self.reloads += 1
                self.last_error = None
            except Exception as e:
                self.failed_reloads, self.last_error = self.failed_reloads + (not isinstance(e, AliasNotSet)), str(e)
                if self.model is None:
                    raise
        return self.model
