"""Column functions built from Catalyst expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that carry no identity, by prefix and by name.
TRACKING = r"(?i)^((utm_|pk_|mtm_|_ga).*|(fbclid|gclid|igshid|mc_cid|mc_eid|ref|source|medium|campaign|amp|spec)(=.*)?)$"

# Publisher prefixes of summaries and what follows the article, in the order in which they are taken off.
PREFIXES = (
    r"^Liputan6\.com,\s*[^-–—]{0,40}[-–—]\s*",
    r"^KOMPAS\.com\s*[-–—]\s*",
    r"^CNN\s*Indonesia\s*[-–—]\s*",
    r"^TEMPO\.CO,\s*[^-–—]{0,40}[-–—]\s*",
    r"^detik\w*\s*[-–—]\s*",
    r"^ANTARA\s*[-–—]\s*",
    r"^REPUBLIKA\.CO\.ID,\s*[^-–—]{0,40}[-–—]+\s*",
    r"^Jakarta\s*[-–—]\s*",
)
TRAILING = r"(?isU)\s*(Baca juga\s*:.*|Simak selengkapnya.*|\(\s*Baca\s*:.*\)|Artikel ini telah tayang.*)$"


def units_between(unit: str, a: Column, b: Column) -> Column:
    """Boundaries of a unit (HOUR, MINUTE) crossed from a to b."""
    return F.timestamp_diff(unit, F.date_trunc(unit, a), F.date_trunc(unit, b))


def days_between(a: Column, b: Column) -> Column:
    return F.datediff(b, a).cast("long")


def rate(flag: Column) -> Column:
    """Share of rows with the flag set, null counting as not set."""
    return F.avg(F.when(flag, F.lit(1.0)).otherwise(F.lit(0.0)))


def trim_spaces(x: Column) -> Column:
    """Without Unicode spaces at either end."""
    return F.regexp_replace(x, r"^\p{Zs}+|\p{Zs}+$", "")


def fold(x: Column) -> Column:
    """Lower case, other characters than letters, digits and underscores as single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(x), r"(?U)[^\w\s]", " "), r"(?U)\s+", " "))


def fingerprint(x: Column) -> Column:
    return F.sha2(fold(x), 256)


def shingles(x: Column, size: int = 4) -> Column:
    """Distinct character n-grams of folded text; a shorter text is one, an empty one none."""
    cut = lambda c: F.transform(F.sequence(F.lit(1), F.greatest(F.size(c) - (size - 1), F.lit(1))), lambda i: F.array_join(F.slice(c, i, F.lit(size)), ""))
    # The letters are bound once, as the only element of an array; substring() would walk the text from its start for each n-gram.
    grams = F.flatten(F.transform(F.array(F.split(x, "")), cut))
    return F.when(F.length(x) == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(grams))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two sets: 1 if both are empty."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / both)


def clean_text(x: Column) -> Column:
    """White space collapsed, publisher prefixes taken off (twice over, each at most once a time), cross-promotion at the end cut."""
    out = F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)\s+", " "))
    for _ in range(2):
        for p in PREFIXES:
            out = F.regexp_replace(out, f"(?iU){p}", "")
    return F.trim(F.regexp_replace(out, TRAILING, ""))


def canonical_url(x: Column) -> Column:
    """Stable identity of an http(s) URL, null for what is none: see the rules in tidemark.functions.python.

    For URLs without percent-encoding; python.canonical_url encodes the survivors anew.
    """
    raw = F.trim(x)
    parts = [F.regexp_extract(raw, r"^(?i)(?:https?:)?//(?:[^/?#@]*@)?([^/?#:]+)(:\d+)?([^?#]*)(?:\?([^#]*))?", k) for k in (1, 2, 3, 4)]
    host, port, path, query = F.regexp_replace(F.lower(parts[0]), r"^www\.", ""), F.when(parts[1].isin(":80", ":443"), "").otherwise(parts[1]), parts[2], parts[3]
    path = F.regexp_replace(path, "/{2,}", "/")
    path = F.when(path.isin("", "/"), "/").otherwise(F.regexp_replace(path, "/+$", ""))
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    kept = F.transform(kept, lambda p: F.when(p.contains("="), p).otherwise(F.concat(p, F.lit("="))))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(host != "", F.concat(F.lit("https://"), host, port, path, tail))


def article_key(url: Column) -> Column:
    return F.sha2(url, 256)


def softmax(x: Column, temperature: float = 1.0) -> Column:
    """Probabilities of an array of scores, shifted by the largest."""
    top = F.array_max(x)
    e = F.transform(x, lambda v: F.exp((v - top) / temperature))
    total = F.aggregate(e, F.lit(0.0), lambda s, v: s + v)
    return F.transform(e, lambda v: v / total)


def backoff_seconds(base: Column, attempt: Column, retry_after: Column, most: float = 60.0) -> Column:
    return F.least(F.greatest(base * F.pow(F.lit(2.0), attempt), F.coalesce(retry_after, F.lit(0.0))), F.lit(most))
