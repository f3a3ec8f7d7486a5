import random

from tokenizers import Tokenizer

from tidemark.llm.encoding import Encoder, tokenizer_path


def test_words_around_a_line_end_are_remembered_apart(monkeypatch):
    rnd = random.Random(8)
    words = ["Open", "open.", "it's", "naïve,", "x1", "...", "ß", "don't.", "\x85", "\xa0", "a\tb", "日本", "é", "¿qué?", "<|endoftext|>"]
    texts = [" ".join(rnd.choice(words) + (rnd.choice(["\n", "\n\n", "\r\n", "\n "]) + rnd.choice(words) if rnd.random() < 0.6 else "") for _ in range(12)) for _ in range(400)]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = tokenizer_path(name)
        tok, own = Tokenizer.from_file(path), Encoder(path)
        for t in texts:
            want = tok.encode(t, add_special_tokens=False).ids
            assert memoryview(own.encode(t)).cast(own.code).tolist() == want
    own = Encoder(tokenizer_path("byte_bpe_50k.json"))
    own.encode("one lineend.\nNext two lineend.\nOther")
    assert "lineend." in own  # the word before the line's end, met again without it, is encoded once
