import random
from collections import Counter, defaultdict

import corpus_pipeline
from tidemark.llm import line_dedup as ld


def brute(rows, depth, least, min_docs):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    lines, docs_of = [], defaultdict(set)
    for rank, k in enumerate(order):
        for n, line in enumerate((rows[k][1] or "").split("\n")):
            w = tuple("<*>" if any(c in "0123456789" for c in t) else t for t in line.split())
            if w:
                lines.append((rank, n, w))
                docs_of[w].add(rank)
    groups = defaultdict(set)
    for w in docs_of:
        groups[w].add(w)
        if len(w) >= least:
            for p in range(depth, len(w)):
                if w[p] != "<*>":
                    groups[p, w[:p] + ("<*>",) + w[p + 1 :]].add(w)
    gone = set()
    for key, members in groups.items():
        if sum(len(docs_of[w]) for w in members) >= min_docs and (key in members or len(members) > 1):
            mine = sorted((r, n) for r, n, w in lines if w in members)
            gone.update(mine[1:])
    out = []
    for rank, k in enumerate(order):
        ls = (rows[k][1] or "").split("\n")
        kept = [x for n, x in enumerate(ls) if (rank, n) not in gone]
        out.append((rows[k][0], len(ls), len(ls) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def corpus():
    rnd = random.Random(6)
    base = [" ".join(rnd.choice(["red", "blue", "é", "one1", "x", "run"]) for _ in range(rnd.randint(1, 9))) for _ in range(60)]
    rows = []
    for k in range(250):
        lines = []
        for _ in range(rnd.randint(0, 6)):
            w = rnd.choice(base).split()
            if rnd.random() < 0.4:
                w[rnd.randrange(len(w))] = rnd.choice(["new", "other", "7", "val"]) + rnd.choice(["", "q", "z"])
            lines.append(rnd.choice(["", " "]) + " ".join(w))
        rows.append((k * 3, "\n".join(lines)))
    return rows + [(1000, None), (1001, ""), (1002, "\n\n \n"), (1003, "Page 1 of 20 in the book\n" * 50)]


def test_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS rid", "2 AS line", "length(text) AS n_chars")
    want = brute(rows, 3, 6, 3)
    assert sum(w[2] for w in want) > 100
    assert sorted(map(tuple, ld.dedup_lines(df).drop("rid").collect()), key=str) == want
    kept = ld.drop_lines(df)
    assert kept.columns == df.columns
    assert sorted([(r.doc_id, r.text, r.n_chars) for r in kept.collect()], key=str) == sorted([(w[0], w[3], len(w[3])) for w in want], key=str)


def test_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(1, "same words here"), (1, "same words here"), (None, "same words here\nunlike"), (None, None)], "doc_id long, text string")
    got = sorted((r.doc_id is not None, r.kept) for r in ld.dedup_lines(df).collect())
    assert got == [(False, ""), (False, "same words here\nunlike"), (True, ""), (True, "")]
    assert ld.drop_lines(df).count() == 4
    assert ld.dedup_lines(df.limit(0)).count() == 0 == ld.drop_lines(df.limit(0)).count()


def test_a_document_counts_once_for_a_wide_template(spark):
    items = "\n".join(f"the list of things has {w} in it" for w in ("tea", "milk", "bread", "salt"))
    df = spark.createDataFrame([(1, items), (2, "unlike"), (3, "the list of things has rice in it")], "doc_id long, text string")
    assert {r.doc_id: r.n_dropped for r in ld.dedup_lines(df, min_docs=3).collect()} == {1: 0, 2: 0, 3: 0}
    assert {r.doc_id: r.n_dropped for r in ld.dedup_lines(df, min_docs=2).collect()} == {1: 3, 2: 0, 3: 1}


def test_two_documents_make_a_template_recur(spark, tmp_path):
    passage = " ".join(f"word{'abcdefgh'[k % 8]}{'ijklmnop'[k // 8]}" for k in range(55))
    docs = spark.createDataFrame([(1, f"one\n{passage}\nA short line"), (2, f"two\n{passage}\nA short line"), (3, "three")], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.n_dropped for r in ld.op5_line_dedup(spark, str(tmp_path)).collect()} == {1: 0, 2: 2, 3: 0}
    assert {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_lines(spark, docs, "").collect()}[2] == "two"


def slow_agreeing(rows, depth, least, min_docs):
    """(document, line) of the lines that go, documents numbered in order of id, with templates linked that differ in a fifth of their tokens at most."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    lines = [(d, n, tuple("<*>" if any(c.isdigit() for c in t) else t for t in x.split())) for d, (_, text) in enumerate(order) for n, x in enumerate((text or "").split("\n"))]
    lines = [x for x in lines if x[2]]
    words, leaves = sorted({w for _, _, w in lines}), defaultdict(list)
    label = {w: k for k, w in enumerate(words)}
    for w in words:
        leaves[len(w), w[:depth]].append(w)
    near = [(a, b) for own in leaves.values() for a in own for b in own if len(a) >= least and 5 * sum(x != y for x, y in zip(a, b)) <= len(a)]
    for _ in words:
        before = dict(label)
        for a, b in near:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    of = defaultdict(list)
    for d, n, w in lines:
        of[label[w]].append((d, n))
    return {x for mine in of.values() if len({d for d, _ in mine}) >= min_docs for x in sorted(mine)[1:]}


def slow_kept(rows, depth, least, min_docs):
    """(id, text of the lines that stay), by that rule."""
    gone = slow_agreeing(rows, depth, least, min_docs)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    return [(i, "\n".join(x for n, x in enumerate((text or "").split("\n")) if (d, n) not in gone)) for d, (i, text) in enumerate(order)]


def test_several_fields_against_brute_force(spark):
    rnd = random.Random(8)
    base = ["posted by {} in {} on the front page of the paper", "the {} of the {} is here", " ".join(f"p{c}" for c in "abcdefghijklmnopqrstuvwxyz") + " and {} so {} it goes"]
    fields = ["red", "blue", "green", "x", "run", "way"]
    rows = [(k, "\n".join(rnd.choice(base).format(rnd.choice(fields), rnd.choice(fields)) + rnd.choice(["", "", " at 9"]) for _ in range(rnd.randint(0, 3)))) for k in range(30)]
    rows += [(100 + k, "\n".join(" ".join(rnd.choice(["a", "b", "c"]) for _ in range(rnd.randint(5, 11))) for _ in range(5))) for k in range(30)]
    want = Counter(rows[d][0] for d, _ in slow_agreeing(rows, 3, 6, 2))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.n_dropped for r in ld.dedup_lines(df, min_docs=2, agree=0.8).collect() if r.n_dropped} == want
    assert sum(want.values()) > 20


def test_pipeline_generalises_two_fields(spark):
    df = spark.createDataFrame([(1, "posted by anna in sports on the front page"), (2, "posted by boris in culture on the front page"), (3, "posted by anna in culture with a long piece")], "doc_id long, text string")
    text = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_lines(spark, df.selectExpr("doc_id", "replace(text, 'front page', 'front page of the paper') AS text"), "").collect()}
    assert text[1] and not text[2] and text[3]


def test_very_long_texts_and_lines(spark):
    rnd = random.Random(2)
    long = [f"w{rnd.choice('abcdefgh')}{rnd.choice('ijklmnop')}x" for _ in range(3000)]
    other = list(long)
    for k in range(5, 3000, 9):
        other[k] = "else"
    many = "\n".join(f"line {'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{'uvwxyzabcd'[k // 100 % 10]}" for k in range(1000)) * 20
    df = spark.createDataFrame([(1, " ".join(long)), (2, "short\n" + " ".join(other)), (3, many), (4, "line aku")], "doc_id long, text string")
    got = {r.doc_id: r.n_dropped for r in ld.dedup_lines(df, min_docs=2, agree=0.8).collect()}
    assert got[1] == 0 and got[2] == 1 and got[4] == 1
