import random

from tidemark.llm.substring_dedup import repeated_words
from tidemark.llm.suffix_dedup import repeated_spans


def test_bytes_of_a_text_longer_than_a_block(spark):
    rnd = random.Random(1)
    base = "".join(rnd.choice("abcdé \n") for _ in range(130_000))
    passage = "".join(rnd.choice("xyz ") for _ in range(1_000))
    long = base[:65_300] + passage + base[65_300:] + base[40_000:40_400] + passage[:199]
    rows = [(1, long), (2, "start " + passage[:300])]
    seen, raw = {}, {d: t.encode() for d, t in rows}
    for d, x in raw.items():
        for k in range(len(x) - 199):
            seen.setdefault(x[k : k + 200], []).append((d, k))
    gone = {d: set() for d in raw}
    for places in seen.values():
        if len(places) > 1:
            for d, k in places:
                gone[d].update(range(k, k + 200))
    got = {r.doc_id: (r.n_bytes, r.n_removed) for r in repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: (len(x), len(gone[d])) for d, x in raw.items()} and len(gone[1]) > 700


def test_words_of_a_text_longer_than_a_block(spark):
    rnd = random.Random(2)
    words = [rnd.choice("abcdefgh") + rnd.choice("ijklmnop") + rnd.choice("qrstuvwx") for _ in range(70_000)]
    passage = [f"p{k}" for k in range(60)]
    long = words[:65_520] + passage + words[65_520:] + words[100:160] + passage[5:40]
    rows = [(1, long), (2, ["start", *passage[10:35]])]
    seen, gone = set(), {1: set(), 2: set()}
    for d, x in rows:
        for k in range(len(x) - 19):
            w = tuple(x[k : k + 20])
            if w in seen:
                gone[d].update(range(k, k + 20))
            seen.add(w)
    df = spark.createDataFrame([(d, " ".join(x)) for d, x in rows], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed) for r in repeated_words(df).collect()}
    assert got == {d: (len(x), len(gone[d])) for d, x in rows} and len(gone[1]) == 95 and len(gone[2]) == 25
