import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_line_dedup import slow_kept
from test_packing import slow_best_fit
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import decontamination, line_dedup, toxicity
from tidemark.llm.encoding import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rid int, fp int"


def corpus():
    rnd = random.Random(12)
    vocabulary = ["".join(rnd.choice("aeiklmnorstu") for _ in range(rnd.randint(3, 8))) for _ in range(900)]
    line = lambda: " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(4, 14)))
    items = [(k, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(8, 30)))) for k in range(6)] + [(90, None), (91, "")]
    rows, labels = [], []
    for k in range(140):
        lines = [line() for _ in range(rnd.randint(1, 12))]
        toxic = rnd.random() < 0.25
        if toxic:
            lines.insert(rnd.randrange(len(lines)), "you are a Blockhead and a numbskull")
        if rnd.random() < 0.3:
            lines.insert(rnd.randrange(len(lines)), f"page {k} of the daily letter for readers")
        if rnd.random() < 0.15:
            lines[rnd.randrange(len(lines))] += " " + items[rnd.randrange(6)][1]
        rows.append((k * 3, "\n".join(lines)))
        if k % 7:
            labels.append((k * 3, int(toxic)))
    copies = rnd.sample(rows, 20)
    rows += [(1000 + k, t) for k, (_, t) in enumerate(copies)]
    for k, (_, t) in enumerate(copies):
        w = t.split(" ")
        w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        rows.append((2000 + k, " ".join(w)))
    rows += [(3000, None), (3001, ""), (3002, " \n"), (None, line()), (3003, " ".join(rnd.choice(vocabulary) for _ in range(9000)))]
    return rows, labels, items


def slow_near(sets):
    """A class for each set: those of all pairs with a Jaccard similarity of 0.8 or more."""
    label = list(range(len(sets)))
    for a, x in enumerate(sets):
        for b, y in enumerate(sets[:a]):
            if label[a] != label[b] and (x == y or 5 * len(x & y) >= 4 * len(x | y)):
                label = [label[b] if k == label[a] else k for k in label]
    return label


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out, (rows, labels, items) = str(tmp_path_factory.mktemp("tables")), corpus()
    spark.createDataFrame([(d, t, "en", "s", len(t or ""), 1, 2) for d, t in rows], DOCS).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


def test_run_against_brute_force(spark, folder):
    rows, _, items = corpus()
    model = toxicity.train(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    clean = [(d, t) for d, t in rows if model.score(t or "") < 0.5]
    lines = slow_kept(clean, line_dedup.LEADING, line_dedup.LEAST, line_dedup.MIN_DOCS)
    label, groups = slow_near([decontamination.shingle_set(decontamination.words_of(t), 5) for _, t in lines]), defaultdict(list)
    for (d, t), c in zip(lines, label, strict=True):
        groups[c].append((d is None, d or 0, t))
    first = [(None if odd else d, t) for odd, d, t in map(min, groups.values())]
    tests = [s for s in (decontamination.shingle_set(decontamination.words_of(t), 5) for _, t in items) if s]
    kept = []
    for d, t in first:
        own = decontamination.shingle_set(decontamination.words_of(t), 5)
        if not any(len(s & own) >= 0.8 * len(s) for s in tests):
            kept.append((d, t))
    assert len(rows) > len(clean) == len(lines) > len(first) > len(kept) > 20
    tok, want = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")), Counter()
    for d, t in kept:
        ids = tok.encode(t, add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            want[d, k // 4096, k, len(ids[k : k + 4096]), zlib.crc32(np.array(ids[k : k + 4096], "<u4").tobytes())] += 1
    got = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist() and sum(n for _, n in parts) <= 4096
    assert len(seqs) == sum(slow_best_fit([r.length for r in got], 4096).values())


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).schema.simpleString() == docs.schema.simpleString()


def test_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_labels_or_items_are_missing(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, 1), (3, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).count() == docs.count()  # one class only: nothing to learn
    assert corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).count() == docs.count()
    spark.createDataFrame([], "doc_id long, toxic int").write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).count() == docs.count()
