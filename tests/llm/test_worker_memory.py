import tracemalloc

import pytest

from tidemark.llm import decontamination, line_dedup, near_copies, packing, toxicity
from tidemark.llm.encoding import encoder, tokenizer_path


def test_a_batch_is_searched_a_few_texts_at_a_time():
    texts = [" ".join(f"w{k}x{i}" for i in range(2000)) for k in range(150)] + [None, "", "one two three four five six"]
    index = decontamination.Index([(1, "one two three four five six"), (2, texts[3][:300]), (3, "not there at all but once")])
    tracemalloc.start()
    found = [(d, index.items[k][0]) for d, k, *_ in index.search(texts, 0.8)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(found) == [(3, 2), (152, 1)]
    assert peak < 12 << 20  # the words of all texts at once are over that


@pytest.mark.parametrize("run", [toxicity._counts((3,), 8), line_dedup._lines(2), near_copies._digests(5)])
def test_stages_that_encode_nothing_drop_the_encoders_of_earlier_ones(run):
    path = tokenizer_path("word_bpe_49k.json")
    list(packing._pieces(path, 4096, 1)(iter([])))
    held = encoder(path)
    list(packing._pieces(path, 4096, 1)(iter([])))
    assert encoder(path) is held  # kept from task to task of the same stage
    list(run(iter([])))
    assert encoder.cache_info().currsize == 0
