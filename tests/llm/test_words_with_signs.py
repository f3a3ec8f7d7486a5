import random

import pytest
from tokenizers import Tokenizer

from tidemark.llm import encoding
from tidemark.llm.encoding import Encoder, tokenizer_path


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_and_signs_are_the_library(name, monkeypatch):
    path, rnd = tokenizer_path(name), random.Random(3)
    tok, own, looked = Tokenizer.from_file(path), Encoder(path), []
    monkeypatch.setattr(own, "special", lambda t, f=own.special: looked.append(t) or f(t))
    signs = "".join(map(chr, range(33, 127)))
    for _ in range(500):
        text = " ".join("".join(rnd.choice("aBcdeZ") for _ in range(rnd.randint(1, 9))) + "".join(rnd.choice(signs) for _ in range(rnd.choice([0, 0, 1, 3]))) for _ in range(20))
        text += rnd.choice(["", " endoftext <|endoftext|>", " end<|endoftext|>", " word_%%% it's''s %'s"])
        assert memoryview(own.encode(text)).cast(own.code).tolist() == tok.encode(text, add_special_tokens=False).ids
    looked.clear()
    own.encode("first plainwordone plainwordtwo")
    assert not any("plainword" in t for t in looked)  # a plain word is not searched for special strings


def test_a_word_with_signs_is_that_word_and_its_signs():
    own = Encoder(tokenizer_path("byte_bpe_50k.json"))
    own.pattern = None  # not needed for these
    assert own.encode("Some words%%% (no) more***".replace("(no) ", "")) and "words%%%" in own


def test_spaces_other_than_plain_ones():
    assert set(encoding._ODD_SPACES) == {chr(c) for c in range(0x110000) if chr(c).isspace()} - {" ", "\n"}
