"""Operator 6, approximate nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

Method. Largest inner product becomes smallest Euclidean distance: queries are scaled to the largest norm M and rows get one more component,
sqrt(M^2 - |x|^2). All are projected to `dims` stable directions (Gaussian, made orthogonal). A kd-tree over the projections, its cuts from a
sample, deals every row to a leaf. In a leaf a query verifies rows by exact inner products, one step of the projected nearest after the other. While its
k-th best so far is at distance d, an unseen row that is at most as far would, by the chi-square law of projected distances, lie within the projected radius r of
d with probability `sure`: where the next projected row is farther than r, the search of the leaf stops. The `probe` leaves with the nearest boxes come first;
with the k-th best of these, only leaves whose box comes within r are visited, and each verified row that is better draws r in.

Scale. Equal vectors are one class, of which only the ids that can be among the k best of anything travel, so many copies of a vector make
neither a large leaf nor many searches. The tree is fitted on at most `SAMPLE` rows and has at most 2^`MOST_DEPTH` leaves, whose boxes are all
that is broadcast. Queries are rows: blocks of them are shuffled to the cells (leaf, part) that they visit; a cell holds about `leaf_rows`
rows, and meets at most about `query_rows` queries in a task. Each row that is found better than a query's first k-th best is one row of the
result; a window that prunes before its shuffle ranks them. Where no leaf is far (random vectors of many dimensions) all cells are visited
and pairs grow with the square of the table, but only projections are compared for most.

Defined cases. Vectors that are null, zero or hold null or non-finite components, and rows with a null id, take no part. A query searches
among vectors of its own number of components and never finds its own id; rows that repeat both id and vector count once, and of rows that
repeat a query's id with other vectors the least vector is the query. Ties go to the smaller id. An empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import common

K = 20
DIMS = 32
SURE = 0.8
PROBE = 3
STEP = 64
LEAF_ROWS = 1024
MOST_DEPTH = 12
SAMPLE = 20_000
QUERY_ROWS = 1_000_000
BLOCK = 128
SEED = 17
_ROWS = "key long, kind int, ids array<long>, vectors array<double>, low array<float>, bounds array<double>"
_ROWS_ARROW = pa.schema([("key", pa.int64()), ("kind", pa.int32()), ("ids", pa.list_(pa.int64())), ("vectors", pa.list_(pa.float64())), ("low", pa.list_(pa.float32())), ("bounds", pa.list_(pa.float64()))])
_FOUND = "query long, vec_id long, score double, verified long"


def chi_square(x: np.ndarray, dims: int) -> np.ndarray:
    """Distribution function of the chi-square law with an even number of degrees of freedom."""
    half = np.minimum(x, 1e4) / 2
    return 1 - np.exp(-half) * sum(half**i / math.factorial(i) for i in range(dims // 2))


def radius(sure: float, dims: int) -> float:
    """The square of the projected distance, as a multiple of the squared distance, that is not passed with probability `sure`; infinite from 1 on."""
    if sure >= 1:
        return math.inf
    low, high = 0.0, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(np.float64(mid), dims) < sure else (low, mid)
    return high


def directions(d: int, dims: int) -> np.ndarray:
    """Orthogonal Gaussian directions for d + 1 components, each of squared length d + 1."""
    q, _ = np.linalg.qr(np.random.default_rng(SEED).standard_normal((d + 1, min(dims, d + 1))))
    return q * math.sqrt(d + 1)


@dataclass
class Tree:
    """A complete kd-tree: cut number k has the cuts 2k + 1 and 2k + 2 below it."""

    depth: int
    axis: np.ndarray
    at: np.ndarray

    @classmethod
    def fit(cls, points: np.ndarray, depth: int) -> Tree:
        """Halves along the widest axis, `depth` times."""
        axis, at = np.zeros((1 << depth) - 1, np.int64), np.zeros((1 << depth) - 1)
        own = [np.arange(len(points))]
        for k in range(len(axis)):
            part = points[own[k]]
            if len(part):
                axis[k] = int(np.argmax(np.ptp(part, axis=0)))
                at[k] = np.median(part[:, axis[k]])
            right = part[:, axis[k]] > at[k]
            own += [own[k][~right], own[k][right]]
        return cls(depth, axis, at)

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        k = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            k = 2 * k + 1 + (points[np.arange(len(points)), self.axis[k]] > self.at[k])
        return k - len(self.axis)


@dataclass
class Space:
    """What a task needs to project rows and to route queries; boxes and cells are there once all rows are dealt."""

    d: int
    most: float
    matrix: np.ndarray
    tree: Tree | None = None
    leaf: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # numbers of the leaves that hold rows
    low: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))
    high: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))
    base: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # first cell of each
    parts: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # cells of each

    def project(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        if query:
            lifted = np.hstack([vectors * (self.most / np.sqrt((vectors * vectors).sum(axis=1)))[:, None], np.zeros((len(vectors), 1))])
        else:
            lifted = np.hstack([vectors, np.sqrt(np.maximum(self.most**2 - (vectors * vectors).sum(axis=1), 0))[:, None]])
        return (lifted @ self.matrix).astype(np.float32)

    def gaps(self, low: np.ndarray) -> np.ndarray:
        """Squared projected distance of each query to the box of each leaf, a few queries at a time."""
        out, step = np.empty((len(low), len(self.leaf))), max(1, (1 << 22) // max(1, self.low.size))
        for k in range(0, len(low), step):
            q = low[k : k + step, None]
            gap = np.maximum(np.maximum(self.low[None] - q, q - self.high[None]), 0)
            out[k : k + step] = (gap * gap).sum(axis=2)
        return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _project(space: Space):
    """Projections of classes, for the sample."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(list(space.project(_matrix(batch.column("v"), space.d), False)), pa.list_(pa.float32()))], names=["low"])

    return run


def _dealt(space: Space):
    """Classes with their projections and leaves."""

    def run(batches):
        for batch in batches:
            low = space.project(_matrix(batch.column("v"), space.d), False)
            cols = [pa.array(space.tree.leaf_of(low)), batch.column("ids"), batch.column("v"), pa.ListArray.from_arrays(np.arange(len(low) + 1, dtype=np.int32) * low.shape[1], pa.array(low.ravel()))]
            yield pa.RecordBatch.from_arrays(cols, names=["leaf", "ids", "v", "low"])

    return run


def _routed(space: Space, reach: float, probe: int, spread: int, first: bool):
    """Blocks of queries under each cell that they visit: the `probe` nearest leaves first, later all others within the stopping radius."""

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            ids, v = batch.column("query").to_numpy(), _matrix(batch.column("v"), space.d)
            low = space.project(v, True)
            gap = space.gaps(low)
            nearest = np.argsort(gap, axis=1, kind="stable")[:, :probe]
            if first:
                go, square, floor = np.zeros(gap.shape, bool), np.full(len(ids), np.inf), np.full(len(ids), -np.inf)
                np.put_along_axis(go, nearest, True, axis=1)
            else:
                floor = batch.column("kth").to_numpy(zero_copy_only=False).astype(float)
                floor[np.isnan(floor)] = -np.inf
                scale = space.most / np.sqrt((v * v).sum(axis=1))
                far = np.maximum(2 * space.most**2 - 2 * scale * floor, 0)  # squared distance of the k-th best; infinite until there are k
                square = np.where(np.isinf(far), np.inf, far * min(reach, 1e12)) * (1 + 1e-5) + 1e-6
                go = gap <= square[:, None]
                np.put_along_axis(go, nearest, False, axis=1)
            share = (ids // 7) % spread
            for leaf in np.flatnonzero(go.any(axis=0)):
                out = []
                for s in range(spread):
                    own = np.flatnonzero(go[:, leaf] & (share == s))
                    for k in range(0, len(own), BLOCK):
                        x = own[k : k + BLOCK]
                        row = ids[x], v[x].ravel(), low[x].ravel(), np.concatenate([square[x], floor[x]])
                        out += [((space.base[leaf] + p) * spread + s, 1, *row) for p in range(space.parts[leaf])]
                for part in common.in_blocks(iter(out), 64):
                    yield common.record_batch(_ROWS_ARROW, part)

    return run


def _searched(space: Space, k: int, reach: float):
    """Of rows sorted by cell, its vectors before its queries: what each query finds, and how many vectors it verified."""
    d, schema = space.d, pa.schema([("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("verified", pa.int64())])
    reach = min(reach, 1e12)

    def best_of(scores, sizes):
        """Which of the verified rows can be among the k best ids, and the k-th best score, -inf where there are fewer ids."""
        order = np.argsort(-scores, kind="stable")
        upto = np.cumsum(sizes[order])
        last = int(np.searchsorted(upto, k))
        if last >= len(order):
            return np.arange(len(scores)), -np.inf
        kth = scores[order[last]]
        return np.flatnonzero(scores >= kth), kth

    def one(v, distance, near, square, floor, vectors, sizes):
        """(rows, scores, number verified) of one query in a cell, projected neighbours in turn until the stopping test holds."""
        at, scores, seen = np.empty(0, np.int64), np.empty(0), 0
        if not len(near):
            return at, scores, seen
        order = near[np.argsort(distance[near], kind="stable")]
        scale = space.most / np.sqrt(v @ v)
        while seen < len(order) and distance[order[seen]] <= square:
            step = order[seen : seen + STEP]
            step = step[distance[step] <= square]
            seen += len(step)
            score = vectors[step] @ v
            good = score >= floor
            at, scores = np.concatenate([at, step[good]]), np.concatenate([scores, score[good]])
            if len(at):
                kept, kth = best_of(scores, sizes[at])
                at, scores, floor = at[kept], scores[kept], max(floor, kth)
                if kth > -np.inf:
                    square = min(square, max(2 * space.most**2 - 2 * scale * kth, 0) * reach * (1 + 1e-5) + 1e-6)
        return at, scores, seen

    def work(held, ids, v, low, square, floor):
        names, sizes, vectors, points, norms = held
        flat, edge = names
        distance = norms[None] + (low * low).sum(axis=1)[:, None] - 2 * (low @ points.T)
        total, out = 0, []
        for q in range(len(ids)):
            at, score, seen = one(v[q], distance[q], np.flatnonzero(distance[q] <= square[q]), square[q], floor[q], vectors, sizes)
            total += seen
            if len(at):
                own = np.concatenate([flat[edge[x] : edge[x + 1]] for x in at])
                score = np.repeat(score, sizes[at])
                top = np.lexsort((own, -score))[:k]
                out.append((np.full(len(top), ids[q]), own[top], score[top]))
        cols = [pa.array(np.concatenate(x)) for x in zip(*out, strict=True)] if out else [pa.array([], f.type) for f in list(schema)[:3]]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(np.zeros(len(cols[0]), np.int64))], schema=schema)
        yield common.record_batch(schema, [(None, None, None, total)])

    def closed(parts):
        ids = [x for part in parts for x in part[0]]
        sizes = np.array([len(x) for x in ids])
        points = np.concatenate([p[2] for p in parts])
        return (np.concatenate(ids), np.append(0, np.cumsum(sizes))), sizes, np.concatenate([p[1] for p in parts]), points, (points * points).sum(axis=1)

    def run(batches):
        held_key, parts, held = None, [], None
        for batch in batches:
            keys, kinds = batch.column("key").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (kinds[1:] != kinds[:-1])])) if len(keys) else []
            for s, e in zip(cuts, [*cuts[1:], len(keys)], strict=True):
                part = batch.slice(s, e - s)
                if kinds[s] == 0:
                    if keys[s] != held_key:
                        held_key, parts, held = keys[s], [], None
                    ids = [np.asarray(x, np.int64) for x in part.column("ids").to_pylist()]
                    parts.append((ids, _matrix(part.column("vectors"), d), _matrix(part.column("low"), space.matrix.shape[1])))
                elif keys[s] == held_key:
                    held = held or closed(parts)
                    for k_row in range(e - s):
                        ids, v, low, bounds = (np.asarray(part.column(c)[k_row].values) for c in ("ids", "vectors", "low", "bounds"))
                        yield from work(held, ids, v.reshape(-1, d), low.reshape(len(ids), -1), bounds[: len(ids)], bounds[len(ids) :])

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (doubles), d: the rows that take part."""
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    return plain.where(F.coalesce(sound, F.lit(False))).withColumn("d", F.size("v"))


def _top(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return found.where("query IS NOT NULL").select("query", "vec_id", "score").withColumn("n", F.row_number().over(w)).where(F.col("n") <= k)


def _of_one_width(rows: DataFrame, d: int, most: float, every: int, k: int, dims: int, sure: float, probe: int, leaf_rows: int, query_rows: int) -> tuple[DataFrame, DataFrame]:
    """The result for the vectors of d components, and all that was found on the way with the numbers of verified vectors."""
    spark = rows.sparkSession
    hashed = rows.where(F.col("d") == d).select("vec_id", "v", F.xxhash64("v").alias("h")).dropDuplicates(["h", "v", "vec_id"])
    asked = common.materialize(hashed.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("v", "h")).alias("x")).select("vec_id", "x.v", "x.h"), "asked")
    widest = hashed.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    most_ids = k + widest  # so many of a class can matter: k, and those of the query's own id
    copies = Window.partitionBy("h", "v").orderBy("vec_id")
    few = hashed.withColumn("n", F.row_number().over(copies)).where(F.col("n") <= most_ids)
    classes = common.materialize(few.groupBy("h", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "classes")
    n_classes = classes.count()
    space = Space(d, most, directions(d, dims))
    m = space.matrix.shape[1]
    depth = min(MOST_DEPTH, max(0, math.ceil(math.log2(max(1, n_classes / leaf_rows)))))
    sample = classes.select("v", F.xxhash64("h", F.lit(SEED)).alias("o")).orderBy("o").limit(SAMPLE).select("v").mapInArrow(_project(space), "low array<float>")
    points = np.array([r[0] for r in sample.collect()], np.float32).reshape(-1, m) if depth else np.empty((0, m), np.float32)
    space.tree = Tree.fit(points, depth)
    dealt = common.materialize(classes.select("ids", "v").mapInArrow(_dealt(space), "leaf long, ids array<long>, v array<double>, low array<float>"), "dealt")
    sides = [f(F.col("low")[i]).alias(f"{name}{i}") for name, f in (("lo", F.min), ("hi", F.max)) for i in range(m)]
    boxes = dealt.groupBy("leaf").agg(F.count("*").alias("n"), *sides).orderBy("leaf").collect()  # at most 2^MOST_DEPTH rows
    space.leaf = np.array([r["leaf"] for r in boxes], np.int64)
    space.low, space.high = (np.array([[r[f"{name}{i}"] for i in range(m)] for r in boxes], np.float32) for name in ("lo", "hi"))
    space.parts = np.array([max(1, -(-r["n"] // (2 * leaf_rows))) for r in boxes], np.int64)
    space.base = np.concatenate([[0], np.cumsum(space.parts)[:-1]]).astype(np.int64)
    queries = common.materialize(asked.groupBy("h", "v").agg(F.min("vec_id").alias("query")), "queries")
    spread = max(1, -(-queries.count() // query_rows))
    cells = spark.createDataFrame([(int(a), int(b), int(c)) for a, b, c in zip(space.leaf, space.base, space.parts, strict=True)], "leaf long, base long, parts long")
    placed = dealt.join(F.broadcast(cells), "leaf").withColumn("cell", F.col("base") + F.pmod(F.xxhash64("v"), F.col("parts"))).withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    data = placed.select((F.col("cell") * spread + F.col("s")).alias("key"), F.lit(0).alias("kind"), "ids", F.col("v").alias("vectors"), "low", F.array().cast("array<double>").alias("bounds"))
    reach = radius(sure, m)

    def run(blocks: DataFrame, tag: str) -> DataFrame:
        met = data.union(blocks).repartition("key").sortWithinPartitions("key", "kind")
        return common.materialize(met.mapInArrow(_searched(space, most_ids, reach), _FOUND), tag)

    first = run(queries.select("query", "v").mapInArrow(_routed(space, reach, probe, spread, True), _ROWS), "first")
    start = common.materialize(_top(first, most_ids), "start")
    kth = start.where(F.col("n") == most_ids).select("query", F.col("score").alias("kth"))
    rest = run(queries.join(kth, "query", "left").select("query", "v", "kth").mapInArrow(_routed(space, reach, probe, spread, False), _ROWS), "rest")
    best = _top(start.select("query", "vec_id", "score").union(rest.where("query IS NOT NULL").select("query", "vec_id", "score")), most_ids)
    lists = best.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("best"))  # at most `most_ids` each
    whose = asked.alias("a").join(queries.alias("q"), (F.col("a.h") == F.col("q.h")) & (F.col("a.v") == F.col("q.v"))).select(F.col("a.vec_id").alias("query_id"), "query")
    others = whose.join(lists, "query").select("query_id", F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("best"))
    got = others.select("query_id", F.posexplode("best").alias("p", "x")).select("query_id", (F.col("p") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
    pairs = first.select("verified").union(rest.select("verified")).agg(F.coalesce(F.sum("verified"), F.lit(0)).alias("verified")).withColumn("pairs", F.lit(n_classes * queries.count()))
    return got, pairs


def searched(vectors: DataFrame, every: int = 20, k: int = K, dims: int = DIMS, sure: float = SURE, probe: int = PROBE, leaf_rows: int = LEAF_ROWS, query_rows: int = QUERY_ROWS) -> tuple[DataFrame, DataFrame]:
    """The result of `search`, and by number of components: verified (vectors whose inner product was taken), pairs (distinct queries x vectors)."""
    rows = common.materialize(usable(vectors), "vectors")
    shapes = rows.groupBy("d").agg(F.sqrt(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).alias("most")).collect()
    out = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    share = rows.sparkSession.createDataFrame([], "verified long, pairs long")
    for shape in shapes:
        got, pairs = _of_one_width(rows, shape["d"], shape["most"], every, k, dims, sure, probe, leaf_rows, query_rows)
        out, share = out.union(got), share.union(pairs)
    return out, share


def search(vectors: DataFrame, **parameters) -> DataFrame:
    """query_id, rank, vec_id, score for the queries, the rows whose id is divisible by `every`."""
    return searched(vectors, **parameters)[0]


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(common.table(spark, sf_dir, "embeddings"))
