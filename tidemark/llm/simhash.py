"""Operator 8, SimHash near-duplicates by pigeonring filtering.

Method. The 64 bits lie on a ring of 16 segments. If two fingerprints differ in at most 2 bits, some chain of consecutive segments keeps
every prefix within its share of the budget: k segments differ in at most k * 2 / 16 bits, that is none in the first seven and one in up to
fifteen. So fingerprints meet on (start, seven equal segments), are pruned by the rest of the chain and then by the full Hamming distance.

Scale. Only distinct fingerprints are compared, each in 16 rows. A meeting place with more than `group_limit` fingerprints makes no pairs:
its fingerprints go the exact other way, each to itself and its 64 neighbours at distance one; two fingerprints are within 2 bits if and
only if they share one of those 65, and all that share one are linked to the smallest of them. Such groups hold 65 at most. Components of
the links come from star rounds; copies are never expanded into pairs.

Defined cases. Null or blank text: fingerprint zero, linked as any other. One or two words: one shingle of them. Null ids are passed over
where the smallest id is sought (null, if a component has no other). Repeated rows are rows of their own; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common, near_copies

WORDS = 3
SEED = 42
SEGMENTS, WIDTH, CHAIN = 16, 4, 7
GROUP_LIMIT = 64


def fingerprint(text: str, words: int = WORDS) -> int:
    """Unsigned fingerprint of one text."""
    w = text.encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w)] if len(w) < words else map(b" ".join, zip(*(w[k:] for k in range(words))))
    h = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
    votes = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """rid, doc_id, fp (the fingerprint as a signed long)."""
    return _fingerprinted(common.keyed(docs), words)


def _fingerprinted(keys: DataFrame, words: int) -> DataFrame:
    schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        common.give_back()
        for batch in batches:
            fp = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), pa.array(fp)], schema=schema)

    return keys.mapInArrow(run, "rid long, doc_id long, fp long")


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return x if not by else x >> np.uint64(by) | x << np.uint64(64 - by)


def _chains(batches):
    """Each fingerprint under its 16 starts: the start and the seven segments from there."""
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])
    for batch in batches:
        x = batch.column("fp").to_numpy().view(np.uint64)
        for start in range(SEGMENTS):
            key = _rotated(x, WIDTH * start) & np.uint64((1 << WIDTH * CHAIN) - 1) | np.uint64(start << WIDTH * CHAIN)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column("fp")], schema=schema)


def links(key: np.ndarray, x: np.ndarray, group_limit: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Of rows sorted by key, whole groups: linked pairs of small groups, and whether a row's group is large."""
    size = np.diff(np.append(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])), len(key))) if len(key) else np.empty(0, np.int64)
    large = np.repeat(size > group_limit, size)
    start = (key >> np.int64(WIDTH * CHAIN)).astype(np.uint64)
    last = np.uint64(WIDTH) * ((start + np.uint64(SEGMENTS - 1)) % np.uint64(SEGMENTS))
    rest = ~(np.uint64((1 << WIDTH) - 1) << last)  # all segments of the chain but the sixteenth
    out = []
    for k in range(1, min(int(size.max(initial=0)), group_limit)):
        same = (key[k:] == key[:-k]) & ~large[k:]
        if not same.any():
            continue
        at = np.flatnonzero(same)
        d = x[at] ^ x[at + k]
        at = at[(np.bitwise_count(d & rest[at]) <= 1) & (np.bitwise_count(d) <= 2)]
        out.append((x[at], x[at + k]))
    return out, large


def _meet(group_limit: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def batch_of(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), b], schema=schema)

    def work(key, x):
        pairs, large = links(key, x, group_limit)
        for a, b in pairs:
            if len(a):
                yield batch_of(a, pa.array(b.view(np.int64)))
        if large.any():
            yield batch_of(x[large], pa.nulls(int(large.sum()), pa.int64()))

    def run(batches):
        held_key, held, flood = np.empty(0, np.int64), np.empty(0, np.uint64), None
        for batch in batches:
            key = np.concatenate([held_key, batch.column("key").to_numpy()])
            x = np.concatenate([held, batch.column("fp").to_numpy().view(np.uint64)])
            if flood is not None and len(key):  # the rest of a group that is known to be large
                n = int(np.searchsorted(key, flood, "right"))
                if n:
                    yield batch_of(x[:n], pa.nulls(n, pa.int64()))
                key, x, flood = key[n:], x[n:], flood if n == len(key) else None
            cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
            yield from work(key[:cut], x[:cut])
            held_key, held = key[cut:], x[cut:]
            if len(held) > group_limit:
                flood = held_key[0]
                yield batch_of(held, pa.nulls(len(held), pa.int64()))
                held_key, held = held_key[:0], held[:0]
        yield from work(held_key, held)

    return run


def _neighbours(batches):
    schema = pa.schema([("near", pa.int64()), ("fp", pa.int64())])
    flips = [np.uint64(0), *(np.uint64(1 << k) for k in range(64))]
    for batch in batches:
        x = batch.column("fp").to_numpy().view(np.uint64)
        for f in flips:
            yield pa.RecordBatch.from_arrays([pa.array((x ^ f).view(np.int64)), batch.column("fp")], schema=schema)


def linked(distinct: DataFrame, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of the distinct fingerprints (fp) within 2 bits."""
    met = distinct.select("fp").mapInArrow(_chains, "key long, fp long").repartition("key").sortWithinPartitions("key").mapInArrow(_meet(group_limit), "a long, b long")
    met = common.materialize(met, "met")
    near = met.where("b IS NULL").select(F.col("a").alias("fp")).distinct().mapInArrow(_neighbours, "near long, fp long")
    least = near.groupBy("near").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").select("near", "b")
    return met.where("b IS NOT NULL").union(near.join(least, "near").where("fp <> b").select("fp", "b"))


def clusters(docs: DataFrame, words: int = WORDS, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """rid, doc_id, fp, component_id (smallest doc_id), first (smallest rid of the component)."""
    marked = common.materialize(fingerprints(docs, words), "fingerprints")
    distinct = common.materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.min("rid").alias("first")), "distinct")
    found = common.components(linked(distinct, group_limit))
    of = distinct.join(found, distinct["fp"] == found["node"], "left").select("fp", F.coalesce("component", "fp").alias("class"), "least", "first")
    of = common.materialize(of, "classes")
    whole = of.groupBy("class").agg(F.min("least").alias("component_id"), F.min("first").alias("first"))
    return marked.join(of.select("fp", "class").join(whole, "class").drop("class"), "fp").select("rid", "doc_id", "fp", "component_id", "first")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = clusters(common.table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def candidates(keys: DataFrame, words: int = WORDS) -> DataFrame:
    """Pairs (a, b) of rids whose components are those of the fingerprints of texts (rid, doc_id, text) within 2 bits."""
    marked = common.materialize(_fingerprinted(keys, words).select("rid", "fp"), "fingerprints")
    least = common.materialize(marked.groupBy("fp").agg(F.min("rid").alias("least")), "distinct")
    same = marked.join(least, "fp").where("rid <> least").select(F.col("least").alias("a"), F.col("rid").alias("b"))
    end = lambda c: least.select(F.col("fp").alias(f"{c}_fp"), F.col("least").alias(c))
    near = linked(least).select(F.col("a").alias("a_fp"), F.col("b").alias("b_fp")).join(end("a"), "a_fp").join(end("b"), "b_fp")
    return same.union(near.select(F.least("a", "b"), F.greatest("a", "b")))


def keep_first(docs: DataFrame, words: int = WORDS, similarity: float | None = None) -> DataFrame:
    """The rows of docs, all columns as they are, but of each component only the one with the smallest id (of equal or null ids, any one).

    Components are those of fingerprints within 2 bits. With a similarity, pairs with such fingerprints are candidates whose shingles must have
    that Jaccard similarity at least, and an exact join adds the pairs that 2 bits miss.
    """
    grouped = (lambda d: clusters(d, words)) if similarity is None else (lambda d: near_copies.clusters(d, words, similarity, candidates=lambda own: candidates(own, words)))
    odd = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").limit(1).count()
    if not odd:
        gone = common.materialize(grouped(docs).where("rid <> first").select("doc_id"), "gone")
        return common.without(docs, "doc_id", gone)
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    (row,) = common.spare(docs, "_row")
    rows = common.materialize(docs.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(row, F.monotonically_increasing_id()), "rows")
    kept = grouped(rows.select(F.col(row).alias("doc_id"), "text")).where("rid = first").select(F.col("doc_id").alias(row))
    return rows.join(kept, row, "left_semi").select(docs.columns)
