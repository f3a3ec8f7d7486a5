import random

import pytest
from tokenizers import Tokenizer

from tidemark.llm import encoding
from tidemark.llm.encoding import Encoder, tokenizer_path

WORDS = ["the", "Word", "één", "stop.", "yes,", "no!!", "a.b", "'s", "x'll", "日本", "<|endoftext|>", "end<|endoftext|>", "12", "7.5,", "naïve.", "᠎", "﻿", "ﬁ", "zz%%%", "b'"]


def _texts(rnd: random.Random) -> list[str]:
    spaces = [[" "], [" ", " ", "\n"], [" ", "\n", "\n\n"], [" ", "\n\n\n"], [" ", "\n", "\n\n", "  ", " \n", "\n ", "\t", "\r\n", "\xa0", "　", "\x1c", "\x85", "\n\n\n"]]
    out = ["", " ", "\n", "a", "\na", "a\n", " a", "a ", "a\nb", "\t", "\ta b"]
    for _ in range(400):
        kind = rnd.choice(spaces)
        out.append(rnd.choice(["", "", "", *kind]) + "".join(rnd.choice(WORDS) + rnd.choice(kind) for _ in range(rnd.randint(1, 30))) + rnd.choice(["", "end", "e\n"]))
        if rnd.random() < 0.6:
            out[-1] = out[-1].strip()
    return out


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("block", [1, 60, 3_000, encoding.BLOCK])
def test_texts_in_blocks_are_the_library(name, block, monkeypatch):
    monkeypatch.setattr(encoding, "BLOCK", block)
    path = tokenizer_path(name)
    tok, texts = Tokenizer.from_file(path), _texts(random.Random(block))
    own, single = Encoder(path), Encoder(path)
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert [memoryview(x).cast(own.code).tolist() for x in own.encode_many(texts)] == want
    assert [memoryview(single.encode(t)).cast(own.code).tolist() for t in texts] == want


def test_a_full_memory_changes_no_ids(monkeypatch):
    monkeypatch.setattr(encoding, "CACHED_PIECES", 20)
    path, texts = tokenizer_path("byte_bpe_50k.json"), _texts(random.Random(5))
    tok, own = Tokenizer.from_file(path), Encoder(path)
    assert [memoryview(x).cast(own.code).tolist() for x in own.encode_many(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(own) <= 20


def test_each_distinct_piece_of_a_block_is_looked_up_once(monkeypatch):
    own, looked = Encoder(tokenizer_path("byte_bpe_50k.json")), []
    monkeypatch.setattr(encoding, "CACHED_PIECES", 0)  # nothing is remembered: each look is a new one
    monkeypatch.setattr(own, "model_tokens", lambda t, f=own.model_tokens: looked.append(t) or f(t))
    assert len(list(own.encode_many(["first again\nNext again"] * 50))) == 50
    assert looked.count("Ġagain") == 1 and looked.count("Next") == 1  # `encode` for each text would look 100 and 50 times


@pytest.mark.parametrize("gap", [" ", "\n"])
def test_any_character_at_a_cut(gap):
    path = tokenizer_path("byte_bpe_50k.json")
    tok, own = Tokenizer.from_file(path), Encoder(path)
    rnd = random.Random(1)
    chars = [c for c in map(chr, [*range(0x3400), *rnd.sample(range(0x3400, 0x110000), 3_000)]) if not "\ud800" <= c <= "\udfff"]
    texts = [t for c in chars for t in (f"a{c}{gap}b", f"a{gap}{c}b", f"{c}{gap}{c}")]
    want = tok.encode_batch_fast(texts, add_special_tokens=False)
    assert [t for t, x, y in zip(texts, own.encode_many(texts), want, strict=True) if memoryview(x).cast(own.code).tolist() != y.ids] == []
