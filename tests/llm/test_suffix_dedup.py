import hashlib
import random
from collections import Counter

import pytest

from tidemark.llm.suffix_dedup import repeated_spans


def brute(rows, length):
    raw = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(r[k : k + length] for _, r in raw for k in range(len(r) - length + 1))
    out = []
    for d, r in raw:
        gone = [False] * len(r)
        for k in range(len(r) - length + 1):
            if seen[r[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((d, len(r), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(r, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé ") for _ in range(rnd.randint(3, 60)))
    parts = [word() for _ in range(40)]
    rows = [(k, "".join(rnd.choice(parts) if rnd.random() < 0.5 else word() for _ in range(rnd.randint(0, 25)))) for k in range(60)]
    rows += [(100, None), (101, ""), (102, "a" * 900), (103, "ab" * 300), (104, rows[3][1]), (3, rows[3][1]), (None, rows[5][1]), (None, None)]
    return rows + [(200 + k, f"{k:04d}" * 9 + "common line " * 6 + f"{k:05d}" * 9) for k in range(30)]


@pytest.mark.parametrize("length, gram, limit", [(200, 32, 2000), (200, 32, 1), (40, 12, 2000), (64, 16, 3)])
def test_against_brute_force(spark, length, gram, limit):
    rows = corpus(length)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS h", "2 AS c", "3 AS pos", "4 AS th")
    got = repeated_spans(df, length, gram, limit).drop("removed").collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows, length)


def test_empty_table(spark):
    assert repeated_spans(spark.createDataFrame([], "doc_id long, text string")).count() == 0
