import random
import re

import pytest
import xxhash

from tidemark.llm import simhash


def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(prints):
    label = list(range(len(prints)))
    for _ in prints:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 2:
                    label[i] = label[j] = min(label[i], label[j])
    return label


@pytest.mark.parametrize("limit", [64, 3])
def test_links_of_fingerprints(spark, limit):
    rnd = random.Random(limit)
    prints = [rnd.getrandbits(64) for _ in range(25)]
    for _ in range(110):
        x = rnd.choice(prints)
        for b in rnd.sample(range(64), rnd.randint(1, 4)):
            x ^= 1 << b
        prints.append(x)
    prints = sorted(set(prints) | {0, 1, 3, 7, (1 << 64) - 1})
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    found = simhash.common.components(simhash.linked(spark.createDataFrame(signed, "fp long"), limit)).collect()
    of = {r.node % (1 << 64): r.component % (1 << 64) for r in found}
    label = slow_components(prints)
    for i, a in enumerate(prints):
        for j, b in enumerate(prints):
            assert (label[i] == label[j]) == (of.get(a, a) == of.get(b, b)), (a, b)


def test_documents(spark):
    rnd = random.Random(2)
    word = lambda: rnd.choice(["Alpha", "beta", "gamma", "Délta", "eps", "zeta"]) + str(rnd.randint(0, 30))
    base = [" ".join(word() for _ in range(rnd.randint(60, 200))) for _ in range(8)]
    rows = [(100 - k, t) for k, t in enumerate(base)]
    for k in range(40):
        w = rnd.choice(base).split()
        w[rnd.randrange(len(w))] = word()
        rows.append((200 + k, " ".join(w)))
    rows += [(300, None), (301, ""), (302, " \n"), (303, "One"), (304, "one"), (305, "two words"), (None, base[0]), (None, None), (7, base[1]), (7, base[1].upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS fp", "2 AS rid", "3 AS first", "'x' AS class")
    got = simhash.clusters(df).collect()
    prints = [slow_print(t) for _, t in rows]
    label = slow_components(prints)
    least = {c: min((d for (d, _), x in zip(rows, label) if x == c and d is not None), default=None) for c in set(label)}
    assert sorted([(r.doc_id, r.fp % (1 << 64), r.component_id) for r in got], key=str) == sorted([(d, p, least[c]) for (d, _), p, c in zip(rows, prints, label)], key=str)
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns and kept.count() == len(set(label))
    unique = df.where("doc_id >= 100")
    ids = {r.doc_id for r in simhash.keep_first(unique).collect()}
    u = [(d, slow_print(t)) for d, t in rows if d is not None and d >= 100]
    lab = slow_components([p for _, p in u])
    assert ids == {min(d for (d, _), x in zip(u, lab) if x == c) for c in set(lab)}


def test_empty(spark):
    assert simhash.clusters(spark.createDataFrame([], "doc_id long, text string")).count() == 0
