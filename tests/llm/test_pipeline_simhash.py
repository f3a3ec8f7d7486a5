import pytest
from test_near_copies import corpus, slow_first

import corpus_pipeline
from tidemark.llm import simhash


@pytest.mark.parametrize("every", [False, True])
def test_near_duplicates_go_through_fingerprints(spark, monkeypatch, every):
    rows, seen, real = corpus(5), [], simhash.linked

    def linked(distinct, *limit):
        seen.append(distinct.count())
        if every:  # fingerprints that link too much: the texts decide
            return distinct.selectExpr("fp AS a").crossJoin(distinct.selectExpr("fp AS b")).where("a < b")
        return real(distinct, *limit)

    monkeypatch.setattr(simhash, "linked", linked)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, df, "").collect()} == set(slow_first(rows))
    assert len(seen) == 1 and 20 < seen[0] < len(rows)


def test_candidates_are_the_components_of_fingerprints(spark):
    rows = corpus(6)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keys = simhash.common.keyed(df)
    of = {d: d for d, _ in rows}
    pairs = [(r.a, r.b) for r in simhash.candidates(keys, 3).collect()]
    for _ in rows:
        for a, b in pairs:
            of[a] = of[b] = min(of[a], of[b])
    assert of == {r.doc_id: r.component_id for r in simhash.clusters(df, 3).collect()} and len(pairs) > 5
