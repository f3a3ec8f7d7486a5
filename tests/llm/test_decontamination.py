import random

from tidemark.llm import decontamination as dc


def test_against_brute_force(spark):
    rnd = random.Random(8)
    word = lambda: rnd.choice("abcdefghij") + rnd.choice("KLMNOPQRST") + rnd.choice("uvwxyz")
    text = lambda n: [word() for _ in range(n)]
    items = [(k, text(rnd.randint(1, 70))) for k in range(60)]
    rows = []
    for k in range(120):
        w = text(rnd.randint(0, 1500))
        for _ in range(rnd.randint(0, 3)):
            part = list(rnd.choice(items)[1])
            for _ in range(rnd.randint(0, 3)):
                if rnd.random() < 0.5:
                    part[rnd.randrange(len(part))] = word()
            at = rnd.randint(0, len(w))
            w[at:at] = [x.lower() for x in part]
        rows.append((k, rnd.choice([" ", "\n", "\t"]).join(w)))
    rows += [(500, None), (501, ""), (None, " ".join(items[5][1])), (7, rows[7][1]), (502, " ".join(items[0][1]))]
    bench = [(i, " ".join(w)) for i, w in items] + [(None, "one two three four five six"), (99, None), (98, ""), (97, "a b"), (97, "a b")]
    rows += [(503, "A b"), (504, "x one two three four five six y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS item_id", "2 AS shared")
    bm = spark.createDataFrame(bench, "item_id long, text string").selectExpr("*", "1 AS doc_id")
    want = []
    for d, t in rows:
        own = dc.shingle_set(dc.words_of(t), 5)
        for i, b in bench:
            s = dc.shingle_set(dc.words_of(b), 5)
            if s and len(s & own) >= 0.8 * len(s):
                want.append((d, i, len(s), len(s & own), len(s & own) / len(s)))
    assert len(want) > 60
    for block in (20000, 7):
        got = dc.leaks(docs, bm, block_items=block)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    kept = dc.keep_uncontaminated(docs, bm)
    bad = {(w[0]) for w in want}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - bad


def test_empty(spark):
    docs, bm = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert dc.leaks(docs, some.withColumnRenamed("doc_id", "item_id")).count() == dc.leaks(some, bm).count() == 0
    assert dc.keep_uncontaminated(some, bm).count() == 1
