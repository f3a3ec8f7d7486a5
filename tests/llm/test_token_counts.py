import random
from array import array

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm.encoding import encoder, tokenizer_path
from tidemark.llm.token_counts import counts, ids_of

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
PARTS = st.sampled_from(["a", "word", "Word's", " ", "  ", "\n", "\t", "'s", "é", "é", " ́", "İ", "Σ", "12", "<|endoftext|>", "<|startoftext|>", ",", "...", " ", "　", "\x1c", "\x85", "日本", "😀", "​", "ﬁ", "LL", "'ll", "\r\n", "½"])


@pytest.mark.parametrize("name", FILES)
@given(parts=st.lists(PARTS, max_size=25))
@settings(max_examples=150, deadline=None)
def test_encoder_is_the_library(name, parts):
    text, e = "".join(parts), encoder(tokenizer_path(name))
    assert array(e.code, e.encode(text)).tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", FILES)
@given(parts=st.lists(PARTS, max_size=60), chunk=st.integers(4, 40), overlap=st.integers(1, 12))
@settings(max_examples=150, deadline=None)
def test_chunks_are_the_whole(name, parts, chunk, overlap):
    text, e = "".join(parts), encoder(tokenizer_path(name))
    assert ids_of(e, text, chunk, overlap) == e.tokenizer.encode(text, add_special_tokens=False).ids


def test_counts(spark):
    rows = [(1, None), (2, ""), (3, "Some words, here.\n" * 9), (4, "word again " * 9000), (None, "x"), (3, "é" * 70000), (5, "nospace" * 20)]
    path = tokenizer_path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    got = counts(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_tokens", "2 AS n_bytes"), path).collect()
    want = [(d, len((t or "").encode()), n := len(tok.encode(t or "", add_special_tokens=False).ids), n > 2048) for d, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert counts(spark.createDataFrame([], "doc_id long, text string"), path).count() == 0


@pytest.mark.parametrize("name", FILES)
def test_letters_of_all_kinds(name):
    """All code points of the Basic Multilingual Plane and some beyond, in three contexts each. Letters that Python knows and the library doesn't are among them."""
    e = encoder(tokenizer_path(name))
    points = [*range(0xD800), *range(0xE000, 0x10000), *range(0x10000, 0x110000, 97)]
    for k in range(0, len(points), 40):
        own = [chr(c) for c in points[k : k + 40]]
        for text in ("".join(f"ab{x}cd " for x in own), " ".join(f"é {x} {x}'ll1" for x in own), "\n".join(f"{x}'ll a{x}  {x}" for x in own)):
            assert array(e.code, e.encode(text)).tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids, hex(ord(own[0]))


@pytest.mark.parametrize("name", FILES)
def test_random_letters_whole_and_in_chunks(name):
    rng = random.Random(name)
    e = encoder(tokenizer_path(name))
    for _ in range(300):
        text = "".join(rng.choice(["a", "Bc", " ", " ", "'ll", "1", "\n", chr(rng.choice([rng.randrange(0x250), rng.randrange(0xD800), rng.randrange(0x10000, 0x20000)]))]) for _ in range(60))
        want = e.tokenizer.encode(text, add_special_tokens=False).ids
        assert array(e.code, e.encode(text)).tolist() == want == ids_of(e, text, 16, 4)
