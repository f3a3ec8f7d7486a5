import random
import zlib
from hashlib import sha256

import duckdb
import pytest

from tidemark.llm import manifest as M


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][k : k + 8]) for k in range(0, len(out[-1]), 8)])
    return out


def way(tree, k):
    """(before, after) at each level of a tree."""
    out = []
    for level in tree[:-1]:
        run = level[k - k % 8 : k - k % 8 + 8]
        out.append(("".join(run[: k % 8]), "".join(run[k % 8 + 1 :])))
        k //= 8
    return out


def slow(rows):
    """rows: doc_id, text, lang, source, n_chars."""
    lower = str.maketrans(M.CAPITALS, M.CAPITALS.lower())
    trees, made = {}, []
    for d, text, lang, source, n in rows:
        leaf = lambda t: h(*map(field, (d, source, lang, n, t)))  # noqa: E731, B023
        struck = d is not None and zlib.crc32(str(d).encode()) % 3 == 0
        other = leaf(text.translate(lower) if text is not None else None) if struck else leaf(text)
        trees.setdefault((lang is not None, (lang or "").encode()), []).append((d is not None, d or 0, leaf(text), other, d))
    names = sorted(trees)
    inner = {x: levels([r[2] for r in sorted(trees[x])]) for x in names}
    top = levels([inner[x][-1][0] for x in names])
    for j, x in enumerate(names):
        for k, (_, _, leaf, other, d) in enumerate(sorted(trees[x])):
            path = way(inner[x], k) + way(top, j)
            got = other
            for a, b in path:
                got = h(a, got, b)
            made.append((d, leaf, inner[x][-1][0], top[-1][0], h(*[a + b for a, b in path]), got, got == top[-1][0]))
    return sorted(made, key=str)


def docs(spark, rows, schema):
    return spark.createDataFrame(rows, f"{schema}, leaf string, tree int, `at` string, n long, path string", verifySchema=False)


def ask(spark, rows, schema):
    got = M.manifest(docs(spark, [(*r, "x", 1, "y", 2, "z") for r in rows], schema))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, got.collect()), key=str)


def text(rng):
    return rng.choice([None, "", "Ab c", "é\n😀 Zz", "word " * rng.randrange(5)])


@pytest.mark.parametrize("n", [0, 1, 8, 9, 700])
def test_is_the_slow_version(spark, docs_schema, n):
    rng = random.Random(n)
    rows = [(rng.choice([None, k, k, k, k // 2]), text(rng), rng.choice(["en", "en", "en", "", None, "é", "de"]), rng.choice([None, "s", ""]), rng.choice([None, 3])) for k in range(n)]
    assert ask(spark, rows, docs_schema) == slow(rows)


def test_three_rounds(spark, docs_schema, monkeypatch):
    """Blocks of 8: a language of 700 rows takes four rounds, 70 languages two; one text is very long."""
    monkeypatch.setattr(M, "LEVELS", 1)
    monkeypatch.setattr(M, "BLOCK", 8)
    rows = [(k, "A" * 300_000 if k == 5 else f"T{k}", f"l{k}" if k < 70 else "en", "s", k) for k in range(770)]
    assert ask(spark, rows, docs_schema) == slow(rows)


def test_same_beyond_the_broadcast(spark, docs_schema, monkeypatch):
    monkeypatch.setattr(M, "BROADCAST_ROWS", 0)
    rows = [(k, f"T{k}", f"l{k % 7}", "s", k) for k in range(90)]
    assert ask(spark, rows, docs_schema) == slow(rows)


def test_sql(spark, docs_schema):
    rng = random.Random(4)
    rows = [(k, text(rng), rng.choice(["en", "en", "de", None, "é"]), rng.choice([None, "s"]), k) for k in range(400)]
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    db.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    assert sorted(db.execute(M.OP13_SQL).fetchall(), key=str) == slow(rows)
