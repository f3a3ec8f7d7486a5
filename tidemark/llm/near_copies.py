"""Near copies: texts whose sets of word shingles have a Jaccard similarity of at least `similarity`, as components of an exact join.

Method. No bit budget of a fingerprint holds all pairs of a given similarity, so the pairs come from prefix filtering: under any one order of
all shingles, two sets that are similar enough share a shingle among the first n - ceil(similarity * n) + 1 of each. Sets that share one,
and whose sizes and places in the order still allow the similarity, are candidates. A sketch of each set has a bit for each of about n places,
set where an odd number of its shingles fall: two sketches differ in no more bits than the sets differ in shingles, so pairs that differ in
too many bits go without loss. Of the others the whole sets decide.

Scale. A sketch takes a 64th of its set, at most 4 KB, and whole sets travel only for pairs that the sketches leave; they are compared row by
row in the JVM, so no batch of them is held. Equal sets meet by grouping. Shingles that a sample finds often come last in the order (this only steers the work: every order gives
the same pairs). A shingle with more than `group_limit` sets compares each with its smallest one first; then only those that
are in another component than the smallest are compared with the other sets of the shingle, so a large group of near copies makes no square.

Defined cases. Null or blank text: the empty set, equal to other empty ones. Under `words` words: one shingle of them. Ids and repeated rows
as in operator 8; an empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.decontamination import shingle_hashes, words_of

WORDS = 5
SIMILARITY = 0.8
GROUP_LIMIT = 16
SAMPLE, OFTEN, MOST_OFTEN = 8, 8, 100_000
SKETCH_BITS = 64, 1 << 15
_SLACK = 1e-9  # bounds are loosened by this, the decision is not
_PLACES = "s long, rid long, n int, i int"


def shingles(text: str, words: int) -> np.ndarray:
    """Distinct shingles of a text as sorted hashes."""
    return np.unique(shingle_hashes(words_of(text), words).view(np.int64))


def sketch(own: np.ndarray) -> bytes:
    """For each place whether an odd number of the shingles fall there; as many places as the power of two from their number on, in bounds."""
    bits = min(max(SKETCH_BITS[0], 1 << max(0, len(own) - 1).bit_length()), SKETCH_BITS[1])
    odd = np.bincount(own & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differing(x: bytes, y: bytes) -> int:
    """Bits in which two sketches differ, the longer one folded to the places of the shorter: never more than the sets differ in shingles."""
    if len(x) < len(y):
        x, y = y, x
    a = int.from_bytes(x, "little")
    size = 4 * len(x)
    while size >= 8 * len(y):
        a = (a >> size) ^ (a & ((1 << size) - 1))
        size //= 2
    return (a ^ int.from_bytes(y, "little")).bit_count()


def _digests(words: int):
    schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("digest", pa.binary()), ("n", pa.int32()), ("sketch", pa.binary())])

    def run(batches):
        common.give_back()
        for batch in batches:
            out = []
            for rid, doc_id, text in zip(*common.columns(batch, "rid", "doc_id", "text"), strict=True):
                own = shingles(text, words)
                out.append((rid, doc_id, xxhash.xxh3_128_digest(own.tobytes()), len(own), sketch(own)))
            yield common.record_batch(schema, out)

    return run


def _all(words: int):
    schema = pa.schema([("s", pa.int64())])

    def run(batches):
        for batch in batches:
            for t in batch.column("text").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingles(t, words))], schema=schema)

    return run


def _prefixes(words: int, similarity: float, often: np.ndarray):
    schema = pa.schema([("s", pa.int64()), ("rid", pa.int64()), ("n", pa.int32()), ("i", pa.int32())])

    def run(batches):
        common.give_back()
        for batch in batches:
            made = []
            for rid, text in zip(*common.columns(batch, "rid", "text"), strict=True):
                own = shingles(text, words)
                if len(own):
                    if len(often):
                        at = np.minimum(np.searchsorted(often, own), len(often) - 1)
                        own = own[np.argsort(often[at] == own, kind="stable")]
                    p = len(own) - math.ceil(similarity * len(own) - _SLACK) + 1
                    made.append((own[:p], np.full(p, rid), np.full(p, len(own), np.int32), np.arange(p, dtype=np.int32)))
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*made, strict=True)], schema=schema)

    return run


def _possible(similarity: float, n, i, m, j):
    """Whether sets of n and m shingles that first meet at places i and j can be similar enough; for numpy arrays and columns."""
    need = (n + m) * (similarity / (1 + similarity)) - _SLACK
    return (n >= similarity * m - _SLACK) & (m >= similarity * n - _SLACK) & (n - i >= need) & (m - j >= need)


def _meet(group_limit: int, similarity: float):
    """Of rows sorted by (s, rid): candidate pairs (a, b) of small groups; every row of a large group as b, beside its first as a."""
    schema = pa.schema([("s", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int32()), ("i", pa.int32()), ("possible", pa.bool_())])

    def large(first, x):
        ok = _possible(similarity, first[2], first[3], x[2], x[3])
        return pa.RecordBatch.from_arrays([pa.array(v) for v in (x[0], np.full(len(x[0]), first[1]), x[1], x[2], x[3], ok)], schema=schema)

    def work(x):
        s, rid, n, i = x
        if not len(s):
            return
        starts = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        size = np.diff(np.append(starts, len(s)))
        over = np.repeat(size > group_limit, size)
        for k in range(1, min(int(size.max()), group_limit)):
            at = np.flatnonzero((s[k:] == s[:-k]) & ~over[k:])
            at = at[_possible(similarity, n[at], i[at], n[at + k], i[at + k])]
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.int64()), pa.array(rid[at]), pa.array(rid[at + k]), pa.nulls(len(at), pa.int32()), pa.nulls(len(at), pa.int32()), pa.array(np.ones(len(at), bool))], schema=schema)
        for at, m in zip(starts[size > group_limit], size[size > group_limit], strict=True):
            yield large([v[at] for v in x], [v[at : at + m] for v in x])

    def run(batches):
        held, first = [np.empty(0, t) for t in (np.int64, np.int64, np.int32, np.int32)], None
        for batch in batches:
            x = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, ("s", "rid", "n", "i"), strict=True)]
            if first is not None and len(x[0]):  # the rest of a group that is known to be large
                k = int(np.searchsorted(x[0], first[0], "right"))
                if k:
                    yield large(first, [v[:k] for v in x])
                first, x = first if k == len(x[0]) else None, [v[k:] for v in x]
            cut = int(np.searchsorted(x[0], x[0][-1])) if len(x[0]) else 0
            yield from work([v[:cut] for v in x])
            held = [v[cut:] for v in x]
            if len(held[0]) > group_limit:
                first = [v[0] for v in held]
                yield large(first, held)
                held = [v[:0] for v in held]
        yield from work(held)

    return run


def _sets(words: int):
    schema = pa.schema([("rid", pa.int64()), ("own", pa.list_(pa.int64()))])

    def run(batches):
        common.give_back()
        for batch in batches:
            out, values = [], 0
            for rid, text in zip(*common.columns(batch, "rid", "text"), strict=True):
                out.append((rid, shingles(text, words)))
                values += len(out[-1][1])
                if values >= 1 << 18:
                    yield common.record_batch(schema, out)
                    out, values = [], 0
            yield common.record_batch(schema, out)

    return run


def _near(similarity: float):
    """The pairs whose sketches allow the similarity."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            rows = zip(*common.columns(batch, "a", "b", "n", "m", "x", "y"), strict=True)
            yield common.record_batch(schema, [(a, b) for a, b, n, m, x, y in rows if differing(x, y) <= (n + m) * (1 - similarity) / (1 + similarity) + _SLACK])

    return run


def verified(pairs: DataFrame, keys: DataFrame, sketches: DataFrame, words: int, similarity: float) -> DataFrame:
    """Those of the pairs (a, b) of rids whose texts are similar enough."""
    x, y = sketches.select(F.col("rid").alias("a"), "n", F.col("sketch").alias("x")), sketches.select(F.col("rid").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("y"))
    pairs = common.materialize(pairs.distinct().join(x, "a").join(y, "b").mapInArrow(_near(similarity), "a long, b long"), "pairs")
    wanted = pairs.select(F.col("a").alias("rid")).union(pairs.select("b")).distinct()
    wanted = common.materialize(wanted, "wanted")
    sets = common.materialize(common.among(keys.select("rid", "text"), "rid", wanted).join(wanted.hint("merge"), "rid", "left_semi").mapInArrow(_sets(words), "rid long, own array<long>"), "sets")
    x, y = sets.select(F.col("rid").alias("a"), F.col("own").alias("x")), sets.select(F.col("rid").alias("b"), F.col("own").alias("y"))
    both = pairs.join(x, "a").join(y, "b").select("a", "b", (F.size("x") + F.size("y")).alias("n"), F.size(F.array_intersect("x", "y")).alias("both"))
    return common.materialize(both.where(F.col("both") / (F.col("n") - F.col("both")) >= similarity).select("a", "b"), "similar")


def links(keys: DataFrame, sketches: DataFrame, words: int, similarity: float, group_limit: int, known: DataFrame | None = None) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of texts (rid, text, distinct sets) that are similar enough.

    known: similar pairs (a, b) found before; candidates that they connect already are not compared.
    """
    sample = keys.where(F.pmod(F.xxhash64("rid"), F.lit(SAMPLE)) == 0).select("text").mapInArrow(_all(words), "s long")
    often = sample.groupBy("s").agg(F.count("*").alias("n")).where(F.col("n") >= OFTEN).orderBy(F.desc("n"), "s").limit(MOST_OFTEN).select("s").collect()
    often = np.array(sorted(r.s for r in often), np.int64)
    places = keys.select("rid", "text").mapInArrow(_prefixes(words, similarity, often), _PLACES)
    met = places.repartition("s").sortWithinPartitions("s", "rid").mapInArrow(_meet(group_limit, similarity), "s long, a long, b long, n int, i int, possible boolean")
    met = common.materialize(met, "met")
    pairs = met.where("possible AND a <> b").select("a", "b")
    if known is not None:
        pairs = _unconnected(pairs, known)
    found = verified(pairs, keys, sketches, words, similarity)
    found = found if known is None else found.union(known)
    crowd = met.where("s IS NOT NULL")
    if crowd.limit(1).count() == 0:
        return found
    of = common.components(found)
    near = lambda c: of.select(F.col("node").alias(c), F.col("component").alias(f"{c}_class"))
    crowd = crowd.join(near("a"), "a", "left").join(near("b"), "b", "left").select("s", "b", "n", "i", F.coalesce("b_class", "b").alias("class"), (F.coalesce("a_class", "a") != F.coalesce("b_class", "b")).alias("apart"))
    crowd = common.materialize(crowd, "crowd")
    x, y = crowd.where("apart").alias("x"), crowd.alias("y")
    ok = _possible(similarity, F.col("x.n"), F.col("x.i"), F.col("y.n"), F.col("y.i"))
    rest = x.join(y, (F.col("x.s") == F.col("y.s")) & (F.col("x.class") != F.col("y.class")) & ok).select(F.least("x.b", "y.b").alias("a"), F.greatest("x.b", "y.b").alias("b"))
    return found.union(verified(rest, keys, sketches, words, similarity))


def _unconnected(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs (a, b) that lie in different components of the known ones."""
    of = common.components(known)
    near = lambda c: of.select(F.col("node").alias(c), F.col("component").alias(f"{c}_class"))
    return pairs.distinct().join(near("a"), "a", "left").join(near("b"), "b", "left").where(F.coalesce("a_class", "a") != F.coalesce("b_class", "b")).select("a", "b")


def clusters(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, group_limit: int = GROUP_LIMIT, candidates: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """rid, doc_id, first (smallest rid of the component).

    candidates gives pairs (a, b) of rids from distinct texts (rid, doc_id, text) that another method holds for near copies: they are compared
    first, and the exact join is left with the pairs that they don't connect.
    """
    common.small_batches(docs.sparkSession)
    keys = common.keyed(docs)
    marked = common.materialize(keys.select("rid", "doc_id", "text").mapInArrow(_digests(words), "rid long, doc_id long, digest binary, n int, sketch binary"), "digests")
    distinct = common.materialize(marked.groupBy("digest").agg(F.min("rid").alias("first")), "distinct")
    again = common.materialize(marked.join(distinct, "digest").where("rid <> first").select("rid"), "again")
    own = common.without(keys, "rid", again)
    known = None if candidates is None else verified(candidates(own), own, marked, words, similarity)
    found = common.components(links(own, marked, words, similarity, group_limit, known))
    of = distinct.join(found, distinct["first"] == found["node"], "left").select("digest", F.coalesce("component", "first").alias("first"))
    return marked.join(of, "digest").select("rid", "doc_id", "first")
