import random
import re
from itertools import permutations

import duckdb
import pytest

from tidemark.llm import filter_audit as A


def fails(rows):
    """The filters that each row fails, in the order of rows."""
    out = []
    for doc_id, text, _, _, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        f = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), bool(re.search(r"[#$%&*|]", text))]
        f.append(doc_id is not None and any((t or "") == text and d is not None and d < doc_id for d, t, *_ in rows))
        out.append({x for x, y in zip("ABCDE", f, strict=True) if y})
    return out


def slow(rows, labels):
    good, toxic = ({d for d, *v in labels if v[k] == 1 and d is not None} for k in (0, 1))
    failed, out = fails(rows), []
    shapley = {}
    for part in {r[3] or "" for r in rows}:
        own = [(r[0], f) for r, f in zip(rows, failed, strict=True) if (r[3] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, x in enumerate(order, 1):
                gone = [r for r in left if x in r[1]]
                left = [r for r in left if x not in r[1]]
                shapley[part, x] = shapley.get((part, x), 0) + len(gone)
                out.append((part, order, step, len(left), len(gone), sum(x in f for _, f in own) - len(gone), sum(f == {x} for _, f in own), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)))
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def text(rng):
    words = [rng.choice(["a", "b", "é😀", "Ab", "word", "x#", "1|2", "CAPS"] + [f"w{k}" for k in range(rng.choice([1, 400]))]) for _ in range(rng.choice([0, 3, 199, 200, 260]))]
    return rng.choice([None, "", rng.choice([" ", "\n", "\x0b\x0c", "\x1c", "　"]).join(words), " ".join(words), "same " * 200, "Same text", "same " * 3])


def case(seed, n):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *[k] * 20, k // 2]), text(rng), "en", rng.choice(["s", "s", "t", "", None]), k) for k in range(n)]
    return rows, [(rng.choice([None, rng.randrange(n)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(n)] if n else []


def ask(spark, rows, labels, schema):
    docs = spark.createDataFrame([(*r, "x", True, 1, "y") for r in rows], f"{schema}, part string, A boolean, n int, digest string")
    marks = spark.createDataFrame([(*r, "z") for r in labels], "doc_id long, quality int, toxic int, good string")
    return sorted(map(tuple, A.audit(A.verdicts(docs, marks)).collect()))


@pytest.mark.parametrize("n", [0, 1, 60])
def test_is_the_slow_version(spark, docs_schema, n):
    rows, labels = case(n, n)
    assert ask(spark, rows, labels, docs_schema) == slow(rows, labels)


def test_copies_beyond_the_hot_ones(spark, docs_schema, monkeypatch):
    monkeypatch.setattr(A, "HOT", 2)
    rows = [(k, f"copy {k % 9}" if k % 3 else "hot", None, "s", 1) for k in range(90)] + [(200, "A " * 150_000, None, None, 1), (201, "A " * 150_000, None, None, 1)]
    assert ask(spark, rows, [(k, 1, k % 2) for k in range(50)], docs_schema) == slow(rows, [(k, 1, k % 2) for k in range(50)])


def test_each_state_is_entered_once(spark, monkeypatch):
    """31 states of 80 edges, each with what its prefix leaves."""
    rows = spark.createDataFrame([("p", *[bool(k >> j & 1) for j in range(5)], True, False) for k in range(32)], "part string, A boolean, B boolean, C boolean, D boolean, E boolean, good boolean, toxic boolean")
    got = A.walk(rows).collect()
    assert len(got) == 80 and len({r["state"] for r in got}) == 31
    assert all(r["n"] == 32 >> len(r["state"]) and r["removed"] * 2 == r["n"] for r in got)


def test_sql(spark):
    rows, labels = case(5, 80)
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    db.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER, toxic INTEGER)")
    db.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    db.executemany("INSERT INTO labels VALUES (?, ?, ?)", labels)
    assert sorted(db.execute(A.OP11_SQL).fetchall()) == slow(rows, labels)
