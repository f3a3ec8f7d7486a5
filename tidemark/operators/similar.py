"""MinHash clusters of near-duplicate titles: banding as a filter, exact similarity as the decision.

Titles travel to their buckets as texts, once for each bucket with company; there pairs are cut by the sizes of their sets and by sketches
(a bit for each place where a gram falls), both without loss, and the sets of the rest decide. A bucket of any size is compared whole: one of
over BLOCK titles is dealt into blocks, and each pair of blocks is a group of its own, so no task holds more than two blocks at a time.
Titles that a group has linked already are not compared again in it, so a large group of near copies makes no square. Where pairs are counted, all
are, of buckets of any size, and each one where its titles meet first: titles then bring their hashes of the bands before.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import fold
from tidemark.functions.python import char_grams, text_signature
from tidemark.operators.graph import components, written

BANDS, ROWS, THRESHOLD, BUCKET = 32, 4, 0.5, (2, 50)
BLOCK = 8192
SKETCH_BITS = 4  # places for each gram, at least
_NARROWEST = 8
_CHUNK = 1 << 15  # words of sketches that are compared at a time
_SLACK = 1e-9  # bounds are loosened by this, the decision is not


def distinct_titles(rows: DataFrame) -> DataFrame:
    """Equal folded titles once, under their smallest key: copies meet by grouping, not in pairs. A null title is a blank one."""
    return rows.select("key", _folded()).groupBy("folded").agg(F.min("key").alias("key"))


def _folded():
    return fold(F.coalesce("title", F.lit(""))).alias("folded")


def _chunk(band: int, rows: int):
    return F.xxhash64(F.slice("sig", band * rows + 1, rows))


def _chunks(signed: DataFrame, bands: int, rows: int) -> DataFrame:
    """key, band, chunk: each title under the hash of each of its bands."""
    chunks = F.array(*[F.struct(F.lit(b).alias("band"), _chunk(b, rows).alias("chunk")) for b in range(bands)])
    return signed.select("key", F.explode(chunks).alias("x")).select("key", "x.*")


def _signed(titles: DataFrame) -> DataFrame:
    return written(titles.withColumn("_x", text_signature("folded")).select(*titles.columns, "_x.*"), "signatures")


def candidate_pairs(titles: DataFrame, bands: int = BANDS, rows: int = ROWS, bucket: tuple[int, int] = BUCKET) -> DataFrame:
    """Pairs (a, b), a < b, of titles that share all rows of a band, in buckets of 2 to `bucket[1]` distinct titles."""
    placed = written(_chunks(_signed(titles), bands, rows), "bands")
    met = placed.join(_sizes(placed).where(F.col("size").between(*bucket)), ["band", "chunk"])
    left, right = met.select("band", "chunk", F.col("key").alias("a")), met.select("band", "chunk", F.col("key").alias("b"))
    return left.join(right, ["band", "chunk"]).where("a < b").select("a", "b").distinct()


def _sizes(placed: DataFrame) -> DataFrame:
    return placed.groupBy("band", "chunk").agg(F.count("*").alias("size"))


def _places(texts: list[str]) -> list[np.ndarray]:
    """For each text a hash of each gram, repeats included; a shorter text is one, padded by zeros, which no folded text holds."""
    out = []
    for t in texts:
        c = np.frombuffer(t.ljust(4, "\0").encode("utf-32-le") if t else b"", np.uint32).astype(np.uint64)
        h = np.zeros(max(0, len(c) - 3), np.uint64)
        for k in range(4):
            h = (h + c[k : len(c) - 3 + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        out.append((h >> np.uint64(20)).astype(np.int64))
    return out


def _class(n: np.ndarray) -> np.ndarray:
    """The power of two of a sketch's number of places."""
    return np.maximum(_NARROWEST, np.ceil(np.log2(np.maximum(n, 1) * SKETCH_BITS))).astype(np.int64)


def _sketches(texts: list[str], power: int) -> np.ndarray:
    out = np.empty((len(texts), 1 << power - 6), np.uint64)
    step = max(1, (1 << 23) >> power)
    for at in range(0, len(texts), step):
        some = _places(texts[at : at + step])
        bits = np.zeros((len(some), 1 << power), np.uint8)
        bits.ravel()[np.concatenate(some) % (1 << power) + np.repeat(np.arange(len(some)) << power, [len(h) for h in some])] = 1
        out[at : at + step] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    return out


class Side:
    """Rows of one block, by the number of their grams, with sketches by class, folded to narrower ones where asked for."""

    def __init__(self, at: np.ndarray, n: np.ndarray, texts: list[str]):
        order = np.argsort(n, kind="stable")
        self.at, self.n = at[order], n[order]
        self.texts = [texts[k] for k in order]
        self.power = _class(self.n)
        self.made: dict[tuple[int, int], tuple[int, np.ndarray, np.ndarray]] = {}

    def sketches(self, power: int, narrow: int) -> tuple[int, np.ndarray, np.ndarray]:
        """Of the rows of a class: place of the first, sketches of `narrow`, and by how much the grams are more than the set places."""
        if (power, narrow) not in self.made:
            lo, hi = np.searchsorted(self.power, [power, power + 1])
            if power == narrow:
                m = _sketches(self.texts[lo:hi], power)
            else:
                m = self.sketches(power, narrow + 1)[1]
                m = m[:, : m.shape[1] // 2] | m[:, m.shape[1] // 2 :]
            self.made[power, narrow] = int(lo), m, self.n[lo:hi] - np.bitwise_count(m).sum(axis=1, dtype=np.int64)
        return self.made[power, narrow]


def _possible(left: Side, i: int, right: Side, lo: int, hi: int, wanted: np.ndarray, threshold: float):
    """Places in `right`, from lo to hi, of wanted rows (one flag for each place from lo) whose sketches allow the similarity with row i of `left`."""
    from_ = lo
    n, power = left.n[i], int(left.power[i])
    start, own, excess = left.sketches(power, power)
    own, excess = own[i - start], excess[i - start]
    while lo < hi:
        first, m, more = right.sketches(int(right.power[lo]), power)
        end = min(hi, first + len(m))
        at = lo + np.flatnonzero(wanted[lo - from_ : end - from_])
        step = max(1, _CHUNK // m.shape[1])
        for k in range(0, len(at), step):
            some = at[k : k + step]
            rows = m[some[0] - first : some[-1] - first + 1] if some[-1] - some[0] + 1 == len(some) else m[some - first]
            both = np.bitwise_count(rows & own).sum(axis=1, dtype=np.int32) + np.minimum(excess, more[some - first])
            yield from some[both * (1 + threshold) >= threshold * (n + right.n[some]) - _SLACK].tolist()
        lo = end


class Fresh:
    """Which pairs of a group's rows meet in it first, by their hashes of the bands before, (bands, rows); `count` of the pairs asked for did."""

    def __init__(self, earlier: np.ndarray):
        self.earlier, self.count = earlier, 0

    def __call__(self, a: int, others: np.ndarray) -> np.ndarray:
        met = np.zeros(len(others), bool)
        for hashes in self.earlier:
            met |= hashes[others] == hashes[a]
        self.count += len(met) - int(np.count_nonzero(met))
        return ~met


def similar_pairs(sides: list[Side], rows: int, threshold: float, every: bool, fresh: Fresh | None = None):
    """Similar pairs of rows of one side, or across two: all (with fresh: all that are), or as many as link the rows that all of them link."""
    label, sets = np.arange(rows), {}

    def grams(side, k):
        at = side.at[k]
        if at not in sets:
            sets[at] = char_grams(side.texts[k])
        return sets[at]

    for turn, left in enumerate(sides):
        right = sides[-1 - turn]
        for i, n in enumerate(left.n):
            lo = i + 1 if right is left else int(np.searchsorted(right.n, n, "right" if turn else "left"))
            hi = int(np.searchsorted(right.n, n / threshold + _SLACK, "right"))
            a = left.at[i]
            wanted = fresh(a, right.at[lo:]) if fresh else label[right.at[lo:hi]] != label[a]
            for j in _possible(left, i, right, lo, hi, wanted, threshold):
                b = right.at[j]
                if label[a] == label[b]:
                    continue
                x, y = grams(left, i), grams(right, j)
                both = len(x & y)
                if both / (len(x) + len(y) - both) >= threshold:
                    yield a, b
                    if not every:
                        label[label == label[b]] = label[a]


_BUCKET = ("band", "chunk", "x", "y")


def _groups(batches):
    """Whole groups of rows sorted by _BUCKET."""
    held = []
    for batch in batches:
        if not len(batch):
            continue
        cut, cols = np.zeros(len(batch), bool), [batch.column(c).to_numpy() for c in _BUCKET]
        for v in cols:
            cut[1:] |= v[1:] != v[:-1]
        cut[0] = bool(held) and any(held[-1].column(c)[len(held[-1]) - 1].as_py() != v[0] for c, v in zip(_BUCKET, cols, strict=True))
        at = 0
        for k in [*np.flatnonzero(cut).tolist(), len(batch)]:
            if cut[at] and held:
                yield pa.Table.from_batches(held)
                held = []
            if k > at:
                held.append(batch.slice(at, k - at))
            at = min(k, len(batch) - 1)
    if held:
        yield pa.Table.from_batches(held)


def _compare(threshold: float, every: bool):
    """Links (a, b) of groups and, where every is set, a row for each group: how many pairs meet in it first, and how many of these are similar."""
    schema = pa.schema([(c, pa.int64()) for c in ("a", "b", "candidates", "confirmed")])

    def batch(a, b, counts):
        a, b = np.asarray(a, np.int64), np.asarray(b, np.int64)
        none, more = pa.nulls(len(a), pa.int64()), [pa.array([c], pa.int64()) for c in counts]
        nodes = [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))]
        cols = [pa.concat_arrays([x, pa.nulls(1, pa.int64())]) for x in nodes] + [pa.concat_arrays([none, m]) for m in more] if more else [*nodes, none, none]
        return pa.RecordBatch.from_arrays(cols, schema=schema)

    def run(batches):
        for group in _groups(batches):
            key, n, block = (group.column(c).to_numpy() for c in ("key", "n", "block"))
            texts = group.column("folded").to_pylist()
            sides = [np.flatnonzero(block == v) for v in np.unique(block)]
            if group.column("x")[0].as_py() != group.column("y")[0].as_py() and len(sides) < 2:
                continue
            sides = [Side(at, n[at], [texts[k] for k in at]) for at in sides]
            if not every:
                found = [*similar_pairs(sides, len(key), threshold, False)]
                if found:
                    yield batch(key[[x for x, _ in found]], key[[y for _, y in found]], ())
                continue
            earlier = group.column("earlier").combine_chunks().flatten().to_numpy().reshape(len(key), -1)
            fresh, label, links, confirmed = Fresh(np.ascontiguousarray(earlier.T)), np.arange(len(key)), [], 0
            for x, y in similar_pairs(sides, len(key), threshold, True, fresh):
                confirmed += 1
                if label[x] != label[y]:
                    links.append((x, y))
                    label[label == label[y]] = label[x]
            yield batch(key[[x for x, _ in links]], key[[y for _, y in links]], (fresh.count, confirmed))

    return run


def compared(signed: DataFrame, threshold: float, bucket: tuple[int, int], large: bool, every: bool) -> DataFrame:
    """a, b, candidates, confirmed from titles (key as a number, folded, sig, n); see _compare."""
    placed = written(_chunks(signed, BANDS, ROWS), "bands")
    sizes = _sizes(placed).where(F.col("size") >= bucket[0] if large else F.col("size").between(*bucket))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    met = placed.join(sizes, ["band", "chunk"]).withColumns({"block": F.pmod(F.xxhash64("key"), blocks).cast("int"), "other": F.explode(F.sequence(F.lit(0), blocks - 1))})
    met = met.withColumns({"x": F.least("block", "other"), "y": F.greatest("block", "other")}).drop("other", "size")
    titles = signed.select("key", "folded", "n", *([F.array(*[_chunk(b, ROWS) for b in range(BANDS)]).alias("chunks")] if every else []))
    met = met.join(titles, "key")
    met = met.withColumn("earlier", F.slice("chunks", F.lit(1), F.col("band"))).drop("chunks") if every else met
    met = met.repartition(*_BUCKET).sortWithinPartitions(*_BUCKET)
    return written(met.mapInArrow(_compare(threshold, every), "a long, b long, candidates long, confirmed long"), "compared")


def cluster(rows: DataFrame, threshold: float = THRESHOLD, bucket: tuple[int, int] = BUCKET, large: bool = True) -> DataFrame:
    """(key, cluster_id) for rows (key, title): the id is the smallest key of the cluster. large: whether buckets over the limit count, too."""
    return clustered(rows, threshold, bucket, large, every=False)[0]


def clustered(rows: DataFrame, threshold: float = THRESHOLD, bucket: tuple[int, int] = BUCKET, large: bool = True, every: bool = True) -> tuple[DataFrame, DataFrame]:
    """The clusters, and where every is set one row of how many pairs of titles share a bucket and how many of these are similar."""
    titles = written(distinct_titles(rows), "titles").withColumn("id", F.monotonically_increasing_id())
    titles = written(titles, "numbered")
    pairs = compared(_signed(titles.select(F.col("id").alias("key"), "folded")), threshold, bucket, large, every)
    found = components(pairs.where("a IS NOT NULL").select("a", "b"))
    of = written(titles.join(found, titles["id"] == found["node"], "left").select("folded", "key", F.coalesce("component", "id").alias("class")), "classes")
    least = of.groupBy("class").agg(F.min("key").alias("cluster_id"))
    of = of.join(least, "class").select("folded", "cluster_id")
    counts = pairs.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(name) for c, name in (("candidates", "candidate_pairs"), ("confirmed", "confirmed_pairs"))])
    return rows.select("key", _folded()).join(of, "folded").select("key", "cluster_id"), counts


def report(clusters: DataFrame) -> DataFrame:
    """Clusters by size: how many, and rows in them."""
    return clusters.groupBy("cluster_id").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("clusters"), F.sum("size").alias("rows"))


def cluster_report(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row: candidate_pairs, confirmed_pairs, clusters and rows_in_a_cluster (of two rows and more), largest, false_candidate_rate."""
    found, pairs = clustered(rows, threshold)
    sizes = found.groupBy("cluster_id").agg(F.count("*").alias("size")).where("size > 1")
    sizes = sizes.agg(F.count("*").alias("clusters"), F.coalesce(F.sum("size"), F.lit(0)).alias("rows_in_a_cluster"), F.coalesce(F.max("size"), F.lit(0)).alias("largest"))
    rate = F.when(F.col("candidate_pairs") > 0, 1 - F.col("confirmed_pairs") / F.col("candidate_pairs")).otherwise(F.lit(0.0))
    return pairs.join(sizes).withColumn("false_candidate_rate", rate)
