import random
import wave
import zlib
from hashlib import sha256
from io import BytesIO

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import media as M

COLUMNS = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]


def slow_cuts(body):
    out, start, h = [], 0, 0
    for k, b in enumerate(body):
        h = ((h << 1) + int(M.GEAR[b])) & 0xFFFFFFFF
        at = k + 1
        if (k >= M.REACH and h < 1 << (32 - M.CUT_BITS) and at - start >= M.LEAST) or at - start == M.MOST:
            out.append(at)
            start = at
    return out + [len(body)] * (start < len(body))


def slow(doc_id, text):
    body = (text or "").encode()
    n = len(body)
    while len(body) % 192 or not body:
        body += b" "
    buf = BytesIO()
    with wave.open(buf, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(M.RATE)
        w.writeframes(body)
    whole = buf.getvalue()
    x = [b - 128 for b in body]
    seen = f"n={len(body)};sum={sum(body)};energy={sum(v * v for v in x)};crossings={sum((a >= 0) != (b >= 0) for a, b in zip(x, x[1:]))};low={min(body)};high={max(body)}"
    return doc_id, n, len(body), sha256(body).hexdigest(), zlib.crc32(body[-16:]), len(whole), sha256(whole).hexdigest(), seen


@given(parts=st.lists(st.tuples(st.integers(0, 3), st.integers(1, 30_000)), max_size=5))
@settings(max_examples=25, deadline=None)
def test_cuts(parts):
    body = b"".join(np.random.default_rng(seed).integers(0, 256, n, dtype=np.uint8).tobytes() if seed else b"a" * n for seed, n in parts)
    assert M.cuts(body) == slow_cuts(body)


def test_cuts_do_not_depend_on_blocks(monkeypatch):
    body = np.random.default_rng(1).integers(0, 256, 300_000, dtype=np.uint8).tobytes()
    want = M.cuts(body)
    monkeypatch.setattr(M, "BLOCK", 1000)
    assert M.cuts(body) == want


def test_feature_does_not_depend_on_blocks(monkeypatch):
    x = np.random.default_rng(2).integers(0, 256, 5000, dtype=np.uint8)
    want = M.feature(x)
    monkeypatch.setattr(M, "BLOCK", 7)
    assert M.feature(x) == want


def passages(rng):
    return [" ".join(f"{rng.randrange(10**6)}" for _ in range(rng.choice([20, 900, 3000]))) for _ in range(6)]


def case(seed, n):
    rng = random.Random(seed)
    shared = passages(rng)
    texts = [rng.choice([None, "", "x" * 192, "y" * 191, "é😀" * 60, "one copy " * 300, rng.choice(shared), rng.choice(shared) + f" {k} " + rng.choice(shared), f"own {k} " * 400]) for k in range(n)]
    return [(rng.choice([None, k, k, k, k // 2]), t, "en", "s", k) for k, t in enumerate(texts)]


@pytest.mark.parametrize("n,hot", [(0, 1000), (1, 1000), (120, 1000), (120, 2)])
def test_documents_come_back(spark, docs_schema, monkeypatch, tmp_path, n, hot):
    monkeypatch.setattr(M, "HOT", hot)
    rows = case(n, n)
    docs = spark.createDataFrame([(*r, 1, b"2", "3") for r in rows], f"{docs_schema}, rid int, media binary, digest string")
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    store = M.MediaStore.write(docs, str(tmp_path / "store"))
    got = store.documents()
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == sorted((slow(r[0], r[1]) for r in rows), key=str)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
    size = store.size()
    if n > 1:
        distinct = {sha256(M.payload(t or "")[a:b]).digest(): b - a for t in {r[1] for r in rows} for ends in [M.cuts(M.payload(t or ""))] for a, b in zip([0, *ends], ends)}
        assert (size["stored_chunks"], size["stored_bytes"]) == (len(distinct), sum(distinct.values())) and size["held_bytes"] > 2 * size["stored_bytes"]


def test_long_text(spark, docs_schema, tmp_path):
    text = "".join(random.Random(3).choices("abc é\n", k=400_000))
    got = M.MediaStore.write(spark.createDataFrame([(1, text, None, None, 1), (2, text[5:], None, None, 1)], docs_schema), str(tmp_path / "s"))
    assert sorted(map(tuple, got.documents().collect())) == [slow(1, text), slow(2, text[5:])]
    assert got.size()["stored_bytes"] < 1.1 * len(text.encode())


def test_damage_is_found(spark, docs_schema, tmp_path):
    store = M.MediaStore.write(spark.createDataFrame(case(9, 40), docs_schema), str(tmp_path / "s"))
    packs = store.table("packs", M._PACK)
    packs.withColumn("body", F.expr("CASE WHEN octet_length(body) > 9 THEN concat(substring(body, 1, octet_length(body) - 1), X'00') ELSE body END")).write.parquet(str(tmp_path / "t" / "packs"))
    for name, schema in (("borrowed", "rid long, k int, digest binary, owner long, owner_k int"),):
        store.table(name, schema).write.parquet(str(tmp_path / "t" / name))
    with pytest.raises(Exception, match="damaged"):
        M.MediaStore(spark, str(tmp_path / "t")).facts()
