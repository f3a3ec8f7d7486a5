import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.functions import python as P


@pytest.mark.parametrize("raw, want", [
    ("http://www.Example.com//a//B/?utm_source=x&b=2&a=1#top", "https://example.com/a/B?a=1&b=2"),
    ("https://example.com:443/", "https://example.com/"),
    ("https://example.com:8080/x/", "https://example.com:8080/x"),
    ("//example.com/x?fbclid=1", "https://example.com/x"),
    ("ftp://example.com/x", None), ("", None), ("https:///x", None), ("no url", None),
])
def test_canonical_url(spark, raw, want):
    assert P.url_identity(raw) == want
    df = spark.createDataFrame([(raw,)], "u string")
    assert df.select(C.canonical_url(F.col("u"))).first()[0] == want
    assert df.select(P.canonical_url("u")).first()[0] == want
    if want:
        assert P.url_identity(want) == want


def test_units_between(spark):
    row = spark.sql("SELECT TIMESTAMP_NTZ '2026-01-01 07:59:00' a, TIMESTAMP_NTZ '2026-01-01 08:01:00' b").select(C.units_between("HOUR", F.col("a"), F.col("b")), C.units_between("MINUTE", F.col("b"), F.col("a")), C.days_between(F.col("a"), F.col("b"))).first()
    assert tuple(row) == (1, -2, 0)


def test_texts(spark):
    one = lambda e, **v: spark.createDataFrame([tuple(v.values())], ", ".join(f"{k} string" for k in v)).select(e).first()[0]
    assert one(C.fold(F.col("t")), t="Café—Naïve!  x_1") == "café naïve x_1"
    assert one(C.trim_spaces(F.col("t")), t="  a b  ") == "a b"
    assert one(C.shingles(F.col("t")), t="abcde") == ["abcd", "bcde"] and one(C.shingles(F.col("t")), t="ab") == ["ab"] and one(C.shingles(F.col("t")), t="") == []
    assert one(C.clean_text(F.col("t")), t="Liputan6.com, Jakarta - ANTARA - Harga\n emas  naik Baca juga: lain\nlagi") == "Harga emas naik"
    assert one(C.clean_text(F.col("t")), t=None) == ""
    assert P.plain_html("<p>a&amp;b<br>c</p>") == " a&b c" and P.plain_html("plain") == "plain" and P.plain_html(None) == ""
    assert P.model_text("Harga\x00 emas\x07 naik", None) == "Harga emas naik" and P.model_text("１００", "ANTARA - isi") == "100. isi" and P.model_text("", "x") == "x"
    assert spark.range(1).select(C.jaccard(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"))), C.jaccard(F.array().cast("array<string>"), F.array().cast("array<string>")), C.jaccard(F.array(F.lit("a")), F.array().cast("array<string>"))).first()[:] == (0.5, 1.0, 0.0)
    assert spark.range(1).select(C.softmax(F.array(F.lit(1.0), F.lit(1.0)))).first()[0] == [0.5, 0.5]


def test_minhash():
    a, b = P.minhash(["abcd", "bcde"]), P.minhash(["abcd", "bcde"])
    assert (a == b).all() and len(a) == 128 and (P.minhash([]) == 2**32 - 1).all()
    coefficients, shifts = P.permutations(42, 128)
    h = [P.hash32(g) for g in ("abcd", "bcde")]
    assert a.tolist() == [min((int(x) * v + int(y)) % (2**61 - 1) for v in h) for x, y in zip(coefficients, shifts)]
