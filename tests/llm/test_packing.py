import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

from tidemark.llm.encoding import tokenizer_path
from tidemark.llm.packing import pack, plan


def slow_best_fit(sizes, capacity):
    free = []
    for s in sorted(sizes, reverse=True):
        fits = [f for f in free if f >= s]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - s)
        else:
            free.append(capacity - s)
    return Counter(free)


def expand(runs, counts, capacity):
    fill = defaultdict(list)
    for k, (size, rank, each, first, offset) in enumerate(runs):
        end = runs[k + 1][1] if k + 1 < len(runs) and runs[k + 1][0] == size else counts[size]
        for j in range(end - rank):
            fill[first + j // each].append((offset + j % each * size, size))
    return fill


def test_plan_equals_best_fit_by_piece():
    rnd = random.Random(4)
    for trial in range(60):
        capacity = rnd.choice([10, 37, 100])
        sizes = [rnd.randint(1, capacity) if rnd.random() < 0.5 else min(capacity, rnd.randint(1, 6)) for _ in range(rnd.randint(0, 300))]
        counts = Counter(sizes)
        fill = expand(plan(counts, capacity), counts, capacity)
        left = []
        for parts in fill.values():
            parts.sort()
            assert [o for o, _ in parts] == np.cumsum([0] + [s for _, s in parts])[:-1].tolist()
            left.append(capacity - sum(s for _, s in parts))
        assert min(left, default=0) >= 0 and Counter(left) == slow_best_fit(sizes, capacity)


def test_pack(spark):
    rnd = random.Random(5)
    rows = [(k, " ".join(rnd.choice(["alpha", "beta,", "Gamma's", "délta"]) for _ in range(rnd.randint(0, 90)))) for k in range(150)]
    rows += [(500, None), (501, ""), (None, "x y"), (7, rows[7][1]), (502, "word " * 700)] + [(600 + k, "same text") for k in range(40)]
    path, cap = tokenizer_path("word_bpe_49k.json"), 64
    got = pack(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS length", "2 AS piece", "3 AS rid"), path, cap, salt_rows=9).collect()
    tok, want = Tokenizer.from_file(path), Counter()
    for d, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), cap):
            part = ids[k : k + cap]
            want[d, k // cap, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [s for _, s in parts])[:-1].tolist() and sum(s for _, s in parts) <= cap
    assert len(seqs) == sum(slow_best_fit([r.length for r in got], cap).values())


def test_empty(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), tokenizer_path("word_bpe_49k.json")).count() == 0
