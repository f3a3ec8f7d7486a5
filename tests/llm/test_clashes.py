import pytest

import corpus_pipeline as P
from tidemark.llm import common

EXTRA = "_rid string, _gone int, _bit string, _bits string, _word int, _MAY string, _row string, rid int, first int, n int, gone int"
VALUES = ("a", 1, "b", "c", 2, "d", "e", 3, 4, 5, 6)


@pytest.mark.parametrize("ids", [range(12), [None, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 9]])
@pytest.mark.parametrize("stage", ["line_dedup", "simhash_near_dedup"])
def test_any_extra_column_may_be_there(spark, docs_schema, tmp_path, stage, ids):
    line = "one line that very many of the documents here do share word for word as it stands"
    rows = [(d, f"{line}\nown words of document number {k} " + " ".join(f"w{k}x{j}" for j in range(30)) if k % 3 else "copy of a text " * 9, "en", "s", k) for k, d in enumerate(ids)]
    docs = spark.createDataFrame([(*r, *VALUES) for r in rows], f"{docs_schema}, {EXTRA}")
    f = dict(P.STAGES)[stage]
    got, plain = f(spark, docs, str(tmp_path)), f(spark, spark.createDataFrame(rows, docs_schema), str(tmp_path))
    assert got.columns == docs.columns
    assert sorted(map(str, got.select(*plain.columns).collect())) == sorted(map(str, plain.collect())) and all(tuple(r)[5:] == VALUES for r in got.collect())


def test_spare_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "_MAY int, __may int, x int")
    assert common.spare(df, "_may", "x", "y") == ["___may", "_x", "y"]
