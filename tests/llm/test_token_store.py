import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import token_store
from tidemark.llm.encoding import tokenizer_path
from tidemark.llm.token_store import TokenStore, cuts, merkle, shift_crc


def test_round_trip(spark, tmp_path):
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("abcdé,. \n") for _ in range(rnd.randint(1, 9)))
    long = " ".join(word() for _ in range(4000))
    rows = [(k, " ".join(word() for _ in range(rnd.randint(0, 300)))) for k in rnd.sample(range(500), 40)] + [(900, long), (901, "new start " + long), (902, None), (903, ""), (None, "x"), (904, "tail <|endoftext|> x"), (904, "tail")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS rid", "3 AS start")
    path = tokenizer_path("byte_bpe_50k.json")
    store = TokenStore.write(df, str(tmp_path / "s"), path)
    tok = Tokenizer.from_file(path)
    want, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    got = sorted(store.checksums().collect(), key=lambda r: r.start)
    assert [tuple(r) for r in got] == [w[:4] for w in want]
    assert [(r.doc_id, r.start, r.ids) for r in sorted(store.documents().collect(), key=lambda r: r.start)] == [(w[0], w[1], w[4]) for w in want]
    keys = [r.key for r in store.chunks().collect()]
    assert len(keys) == len(set(keys)) < sum(len(r.digests) // 20 for r in store.recipes().collect()) - 10
    assert sum(r.n_docs for r in store.manifest().collect()) == len(rows)
    ordered = [r.rid for f in sorted((tmp_path / "s" / "recipes").glob("*.parquet")) for r in spark.read.parquet(str(f)).collect() if r.rid is not None]
    assert len(ordered) == len(rows) and ordered == sorted(ordered)


def test_damage_is_found(spark, tmp_path):
    store = TokenStore.write(spark.createDataFrame([(1, "some text here")], "doc_id long, text string"), str(tmp_path / "s"), tokenizer_path("byte_bpe_50k.json"))
    path = str(tmp_path / "s" / "objects")
    rows = spark.read.parquet(path)
    bad = spark.createDataFrame(rows.selectExpr("deal", "key", "if(key IS NULL, NULL, cast('xx' AS binary)) AS payload", "rid", "doc_id", "n_tokens", "digests", "root").collect(), rows.schema)
    bad.write.mode("overwrite").parquet(path)
    with pytest.raises(Exception, match="is damaged"):
        store.checksums().collect()


def test_a_wrong_range_is_found(spark, tmp_path):
    store = TokenStore.write(spark.createDataFrame([(k, f"some text {k}") for k in range(30)], "doc_id long, text string"), str(tmp_path / "s"), tokenizer_path("byte_bpe_50k.json"))
    store.verify()
    path = str(tmp_path / "s" / "manifest")
    rows = spark.read.parquet(path)
    spark.createDataFrame(rows.selectExpr("part", "n_docs", "n_tokens + 1 AS n_tokens", "root", "start").collect(), rows.schema).write.mode("overwrite").parquet(path)
    with pytest.raises(ValueError, match="manifest"):
        store.verify()


def test_empty(spark, tmp_path):
    store = TokenStore.write(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "s"), tokenizer_path("byte_bpe_50k.json"))
    assert store.checksums().count() == 0


def test_cuts_and_crc():
    ids = np.random.default_rng(0).integers(0, 50000, 30000).astype(np.uint16)
    ends = cuts(ids)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(ids) and sizes.max() <= token_store.MOST and sizes[:-1].min() >= token_store.LEAST and len(ends) > 20
    moved = cuts(np.concatenate([ids[5000:5003], ids]))
    assert len({e - 3 for e in moved} & set(ends)) > len(ends) * 0.7
    a, b = b"hello there", b"general text" * 9
    assert int(shift_crc(np.array([zlib.crc32(a)]), np.array([len(b)]))[0]) ^ zlib.crc32(b) == zlib.crc32(a + b)
    assert merkle([b"a", b"b", b"c"]) != merkle([b"a", b"c", b"b"])
