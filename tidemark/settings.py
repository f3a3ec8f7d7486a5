"""Settings from the environment: TIDEMARK_ and the name in capitals, parsed by the field's type; unknown names and bad values are errors."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

PREFIX = "TIDEMARK_"


class BadSetting(ValueError):
    pass


@dataclass(frozen=True)
class Settings:
    data: str = "data"  # folder of the landing zone, warehouse, export and registry
    feeds: str = "feeds.json"
    taxonomy: str = ""
    delay: float = 1.0  # seconds between two requests
    retries: int = 3
    backoff: float = 1.0  # seconds before the first retry
    breaker: int = 3  # failures in a row that open it
    pause: float = 3600.0  # seconds that it stays open
    lookback: int = 3  # days in which a source's key does not land again
    unreachable: tuple[str, ...] = ()  # sources that are known not to answer
    alias_ttl: float = 60.0
    host: str = "127.0.0.1"
    port: int = 8000

    @classmethod
    def from_env(cls, env: dict | None = None) -> Settings:
        env = os.environ if env is None else env
        given = {k.removeprefix(PREFIX).lower(): v for k, v in env.items() if k.startswith(PREFIX)}
        known = {f.name: f for f in fields(cls)}
        unknown = sorted(set(given) - set(known))
        if unknown:
            raise BadSetting(f"no such settings: {', '.join(unknown)}")
        return cls(**{n: cls._parse(n, v) for n, v in given.items()})

    @classmethod
    def _parse(cls, name: str, text: str):
        kind = type(getattr(cls, name))
        try:
            value = tuple(x.strip() for x in text.split(",") if x.strip()) if kind is tuple else kind(text)
        except ValueError:
            raise BadSetting(f"{name}: {text!r} is no {kind.__name__}") from None
        if kind in (int, float) and value < 0:
            raise BadSetting(f"{name}: {text!r} is negative")
        return value
