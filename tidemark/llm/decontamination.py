"""Operator 9, benchmark decontamination by size-partitioned MinHash containment search.

Method. A test item is its set of shingles (5 words, A-Z lower-cased). Items are partitioned by the power of two above their size. For each
partition a document is cut into blocks of half that size and three blocks in a row form a window, so a passage like the item lies inside
one window of comparable size and containment of 0.8 becomes a Jaccard similarity of about a quarter at least. Windows and items that share
one of `hashes` MinHash values (single-row bands; a miss has a chance of about 1e-8) are candidates; a candidate document is then
verified: the share of the item's shingles that the whole document has.

Scale. One pass over the documents without shuffle; items come in blocks of at most `block_items`, so what is sent to the tasks is bounded
however long the benchmark is.

Defined cases. Null or blank texts have no shingles and match nothing; a very long text is searched whole, window by window; one to four words are one shingle. Null ids are carried along,
repeated rows give rows of their own; an empty table on either side gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.rolling import mix

WORDS = 5
THRESHOLD = 0.8
HASHES = 64
BLOCK_ITEMS = 20_000
_FACTORS = mix(np.arange(1, 4097, dtype=np.uint64)) | np.uint64(1)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingle_set(words: list[bytes], n: int) -> set[bytes]:
    """Distinct shingles, joined by one space."""
    if not words:
        return set()
    return {b" ".join(words)} if len(words) < n else set(map(b" ".join, zip(*(words[k:] for k in range(n)))))


def shingle_hashes(words: list[bytes], n: int) -> np.ndarray:
    """A hash for each shingle, in order."""
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64)
    m = min(n, len(w))
    h = w[: len(w) - m + 1].copy()
    for k in range(1, m):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[k : len(w) - m + 1 + k]
    return mix(h)


class Index:
    """MinHash tables of one block of items, by size partition."""

    def __init__(self, items: list[tuple], n: int = WORDS, hashes: int = HASHES):
        self.n, self.hashes = n, hashes
        self.items = [(i, s) for i, s in ((i, shingle_set(words_of(t), n)) for i, t in items) if s]
        factors = _FACTORS[:hashes]
        by: dict[int, list] = defaultdict(list)
        for k, (_, s) in enumerate(self.items):
            h = np.array([shingle_hashes(x.split(b" "), n)[0] for x in s], np.uint64)
            by[max(2, 1 << (len(s) - 1).bit_length())].append((k, (h * factors[:, None] >> np.uint64(32)).min(axis=1)))
        self.parts = {}  # size: for each hash function the sorted values and the items in that order
        for size, rows in by.items():
            at, mins = np.array([k for k, _ in rows]), np.array([m for _, m in rows]).T
            order = np.argsort(mins, axis=1, kind="stable")
            self.parts[size] = np.take_along_axis(mins, order, axis=1), at[order]

    def candidates(self, hashes: list[np.ndarray]) -> set[tuple[int, int]]:
        """(document, item) numbers whose windows share a MinHash value, for shingle hashes of some documents."""
        sizes = np.array([len(h) for h in hashes])
        if not self.parts or not sizes.sum():
            return set()
        flat, edge = np.concatenate(hashes), np.append(0, np.cumsum(sizes))
        grids = {}
        for size in self.parts:
            step = size // 2
            blocks = -(-sizes // step)
            owner = np.repeat(np.arange(len(sizes)), blocks)
            number = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            grids[size] = owner, edge[owner] + number * step
        found = set()
        for j in range(self.hashes):
            v = flat * _FACTORS[j] >> np.uint64(32)
            for size, (owner, starts) in grids.items():
                low = np.minimum.reduceat(v, starts)
                wide = low.copy()
                for ahead in (1, 2):
                    ok = owner[ahead:] == owner[:-ahead]
                    wide[:-ahead][ok] = np.minimum(wide[:-ahead][ok], low[ahead:][ok])
                values, items = self.parts[size][0][j], self.parts[size][1][j]
                lo = np.searchsorted(values, wide)
                hit = np.flatnonzero(values[np.minimum(lo, len(values) - 1)] == wide)
                if len(hit):
                    hi = np.searchsorted(values, wide[hit], "right")
                    found.update((int(owner[w]), int(items[k])) for w, a, b in zip(hit, lo[hit], hi, strict=True) for k in range(a, b))
        return found

    def search(self, texts: list[str | None], threshold: float) -> Iterator[tuple[int, int, int, int]]:
        """(text number, item number, shingles of the item, shared) for every containment of at least the threshold."""
        start, total, words = 0, 0, []  # words of the texts from start on, of a few at a time
        for t in texts:
            w = words_of(t)
            if words and total + len(w) >= 1 << 15:
                yield from self._search(start, words, threshold)
                start, total, words = start + len(words), 0, []
            words.append(w)
            total += len(w)
        if words:
            yield from self._search(start, words, threshold)

    def _search(self, start: int, words: list[list[bytes]], threshold: float) -> Iterator[tuple[int, int, int, int]]:
        of: dict[int, list[int]] = defaultdict(list)
        for d, k in self.candidates([shingle_hashes(w, self.n) for w in words]):
            of[d].append(k)
        for d, ks in of.items():
            own = shingle_set(words[d], self.n)
            for k in sorted(ks):
                s = self.items[k][1]
                shared = len(s & own)
                if shared >= threshold * len(s):
                    yield start + d, k, len(s), shared


def _blocks(spark: SparkSession, benchmark: DataFrame, block_items: int):
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    return common.in_blocks((tuple(r) for r in items.toLocalIterator()), block_items)


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, hashes: int = HASHES, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """doc_id, item_id, item_shingles, shared, containment for each document that holds an item."""
    spark, out = docs.sparkSession, None
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("item_shingles", pa.int64()), ("shared", pa.int64()), ("containment", pa.float64())])
    texts = common.id_text(docs)
    for block in _blocks(spark, benchmark, block_items):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            common.give_back()
            index = Index(shared.value, words, hashes)
            for batch in batches:
                ids, text = common.columns(batch, "doc_id", "text")
                yield common.record_batch(schema, [(ids[d], index.items[k][0], q, n, n / q) for d, k, q, n in index.search(text, threshold)])

        got = texts.mapInArrow(run, "doc_id long, item_id long, item_shingles long, shared long, containment double")
        out = got if out is None else out.union(got)
    return out if out is not None else spark.createDataFrame([], "doc_id long, item_id long, item_shingles long, shared long, containment double")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, hashes: int = HASHES, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The rows of docs that hold no item, all columns as they are."""
    spark = docs.sparkSession
    at = docs.columns.index("text")
    for block in _blocks(spark, benchmark, block_items):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            common.give_back()
            index = Index(shared.value, words, hashes)
            for batch in batches:
                bad = {d for d, *_ in index.search(batch.column(at).to_pylist(), threshold)}
                yield batch.filter(pa.array([k not in bad for k in range(len(batch))], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


# Containment by joining all shingles: what the search must find. Words and A-Z as above; one to four words are one shingle.
OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS r, item_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
ds AS (SELECT DISTINCT r, id, array_to_string(w[k:least(k + 4, len(w))], ' ') AS s FROM (SELECT r, id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
bs AS (SELECT DISTINCT r, id, array_to_string(w[k:least(k + 4, len(w))], ' ') AS s FROM (SELECT r, id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM b WHERE len(w) > 0)),
q AS (SELECT r, count(*) AS n FROM bs GROUP BY r)
SELECT any_value(ds.id) AS doc_id, any_value(bs.id) AS item_id, any_value(q.n) AS item_shingles, count(*) AS shared, count(*) / any_value(q.n) AS containment
FROM ds JOIN bs USING (s) JOIN q ON q.r = bs.r GROUP BY ds.r, bs.r HAVING count(*) >= 0.8 * any_value(q.n)
"""
