import hashlib
import random

import pytest

from tidemark.llm.substring_dedup import repeated_words


def brute(rows, width):
    seen, out = set(), []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        words = (t or "").encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - width + 1):
            w = tuple(words[k : k + width])
            if w in seen:
                gone[k : k + width] = [True] * width
            seen.add(w)
        out.append((d, len(words), sum(gone), hashlib.sha256(b" ".join(w for w, g in zip(words, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("abcdefghij") + rnd.choice("éxyz ")
    parts = [" ".join(word() for _ in range(rnd.randint(1, 40))) for _ in range(30)]
    rows = [(k, rnd.choice([" ", "\n", "\t "]).join(rnd.choice(parts) if rnd.random() < 0.5 else word() for _ in range(rnd.randint(0, 25)))) for k in rnd.sample(range(1000), 70)]
    rows += [(1100, None), (1101, ""), (1102, "a " * 300), (1103, "a b " * 150), (1104, rows[3][1]), (rows[3][0], rows[3][1]), (None, rows[5][1]), (None, None), (1105, "x y " * 60)]
    return rows + [(1200 + k, " ".join(f"{k}-{j}" for j in range(9)) + " a common line of ten words is in this place " + " ".join(f"{k}+{j}" for j in range(9))) for k in range(30)]


@pytest.mark.parametrize("width, gram, limit, batches, fanout", [(20, 4, 2000, 2, 4), (20, 4, 1, 2, 4), (8, 2, 3, 4, 2), (5, 5, 2000, 1, 2)])
def test_against_brute_force(spark, width, gram, limit, batches, fanout):
    rows = corpus(width)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS h", "2 AS c", "3 AS pos", "4 AS rid")
    got = repeated_words(df, width, gram, limit, batches, fanout).drop("removed").collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows, width)


def test_empty_table(spark):
    assert repeated_words(spark.createDataFrame([], "doc_id long, text string")).count() == 0
