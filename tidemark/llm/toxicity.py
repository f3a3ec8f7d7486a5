"""Operator 3, toxicity: a linear classifier on character n-grams whose features are scaled by naive Bayes log-count ratios.

Method. A text is a set of hashed character n-grams (UTF-8 bytes, A-Z lower-cased, white space runs as one space). Over all labelled
training rows, presence counts by class give each feature its log-count ratio r; the `kept` features that separate the classes most
(chi-square) stay. A logistic model is fitted on vectors whose set features have the value r, and its score is a probability.

Scale. Counts cover all labelled training rows: each task adds up arrays of 2**bits numbers, and Spark ranks the features, so the driver gets
`kept` of them. The fit uses at most `fit_rows` rows of each class and at most `fit_values` set features in all, those of the rows with the
smallest hash of their id, on the driver. Scoring is one pass without shuffle over whole texts. The model is at most `kept` weights.

Defined cases. Null text: empty, which gets the score of the bias alone. A very long text is one set of features, so its length adds no
weight by itself. A null id is never labelled and not held out. Labels other than 0 and 1, and labels of rows held out, are not used; several
labels of one id all count. Without both classes nothing is learned: every score is 0.5 (predicted 1), and `keep_clean` keeps all rows.
Labels, lang, source and ids are no inputs of a score; repeated rows score alike. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import common

GRAMS = (3, 4, 5)
BITS = 20
KEPT = 20_000
FIT_ROWS = 6_000
FIT_VALUES = 8_000_000
_CHUNK = 1 << 20
ROUNDS = 150
PENALTY = 3e-4


def hashed(text: str, grams: tuple[int, ...], bits: int) -> list[np.ndarray]:
    """Feature numbers of one text, in order and with repeats, for each length of n-gram (at most 8 bytes)."""
    raw = np.frombuffer(b" " + b" ".join(text.encode().lower().split()) + b" ", np.uint8)
    code, made = raw.astype(np.uint64), []
    for n in range(2, max(grams) + 1):
        code = code[:-1] << np.uint64(8)
        code |= raw[n - 1 :]
        if n in grams and len(code):
            made.append((code * np.uint64(0x9E3779B97F4A7C15 + 2 * n)) >> np.uint64(64 - bits))
    return made


def features(text: str, grams: tuple[int, ...] = GRAMS, bits: int = BITS) -> np.ndarray:
    """Sorted distinct feature numbers of one text."""
    made = hashed(text, grams, bits)
    return np.unique(np.concatenate(made).astype(np.uint32)) if made else np.empty(0, np.uint32)


def held_out(doc_id: Column) -> Column:
    """Whether a row belongs to the fifth that no model is fitted on."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


@dataclass
class Model:
    weight: np.ndarray  # of each feature, its log-count ratio included; 0 where not kept
    bias: float
    grams: tuple[int, ...]
    bits: int

    def __post_init__(self):
        self.has = self.weight != 0

    def score(self, text: str) -> float:
        found = [f[self.has[f]] for f in hashed(text, self.grams, self.bits)]
        x = self.bias + (float(self.weight[np.unique(np.concatenate(found))].sum()) if found else 0.0)
        return float(1 / (1 + np.exp(-np.clip(x, -500, 500))))


def _counts(grams, bits):
    schema = pa.schema([("feature", pa.int32()), ("pos", pa.int64()), ("neg", pa.int64()), ("docs_pos", pa.int64()), ("docs_neg", pa.int64())])

    def run(batches):
        common.give_back()
        n, seen = np.zeros((2, 1 << bits), np.int64), [0, 0]
        for batch in batches:
            for text, y in zip(*common.columns(batch, "text", "y"), strict=True):
                n[y, features(text, grams, bits)] += 1
                seen[y] += 1
        at = np.flatnonzero(n.any(axis=0)).astype(np.int32)
        zero = np.zeros(len(at), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[1, at]), pa.array(n[0, at]), pa.array(zero), pa.array(zero)], schema=schema)
        yield common.record_batch(schema, [(-1, 0, 0, seen[1], seen[0])])

    return run


def _vectors(place: np.ndarray, grams, bits):
    schema = pa.schema([("y", pa.int32()), ("o", pa.int64()), ("o2", pa.int64()), ("x", pa.list_(pa.int32()))])

    def run(batches):
        for batch in batches:
            out = []
            for text, y, o, o2 in zip(*common.columns(batch, "text", "y", "o", "o2"), strict=True):
                x = place[features(text, grams, bits)]
                out.append((y, o, o2, x[x >= 0].astype(np.int32)))
            yield common.record_batch(schema, out)

    return run


def _fit(at: np.ndarray, size: np.ndarray, y: np.ndarray, r: np.ndarray, rounds: int, penalty: float) -> tuple[np.ndarray, float]:
    """Logistic weights on the scaled vectors, classes weighted alike, by accelerated gradient steps.

    at: the set features of all rows, one after the other; size: how many each row has. Sums go over about _CHUNK features at a time.
    """
    edge = np.append(0, np.cumsum(size))
    cuts = np.unique(np.searchsorted(edge, np.arange(0, edge[-1] + _CHUNK, _CHUNK)))
    cuts = np.unique(np.append(np.minimum(cuts, len(size)), [0, len(size)]))
    chunks = [(int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def by_row(x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(size))
        for a, b in chunks:
            full = np.flatnonzero(size[a:b])
            if len(full):
                out[a + full] = np.add.reduceat(x[at[edge[a] : edge[b]]], edge[a:b][full] - edge[a])
        return out

    def by_feature(g: np.ndarray) -> np.ndarray:
        out = np.zeros(len(r))
        for a, b in chunks:
            out += np.bincount(at[edge[a] : edge[b]], np.repeat(g[a:b], size[a:b]), len(r))
        return out

    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    step = 1 / (0.25 * (float((share * by_row(r * r)).sum()) + 1) + penalty)
    w, b = np.zeros(len(r)), 0.0
    ww, bb, t = w.copy(), b, 1.0
    for _ in range(rounds):
        g = share * (1 / (1 + np.exp(-(by_row(r * ww) + bb))) - y)
        w1, b1 = ww - step * (by_feature(g) * r + penalty * ww), bb - step * g.sum()
        t1 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ww, bb = w1 + (t - 1) / t1 * (w1 - w), b1 + (t - 1) / t1 * (b1 - b)
        w, b, t = w1, b1, t1
    return w, b


def train(docs: DataFrame, labels: DataFrame, grams: tuple[int, ...] = GRAMS, bits: int = BITS, kept: int = KEPT, fit_rows: int = FIT_ROWS, rounds: int = ROUNDS, penalty: float = PENALTY, fit_values: int = FIT_VALUES) -> Model:
    """Fits on labelled documents outside the held-out fifth."""
    common.small_batches(docs.sparkSession)
    truth = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y")).where("y IN (0, 1)").where(~held_out(F.col("doc_id")))
    known = common.materialize(common.among(common.id_text(docs), "doc_id", truth.select("doc_id")).join(truth.hint("merge"), "doc_id").select("doc_id", "text", "y"), "labelled")
    counts = known.select("text", "y").mapInArrow(_counts(grams, bits), "feature int, pos long, neg long, docs_pos long, docs_neg long").groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "docs_pos", "docs_neg")])
    counts = common.materialize(counts, "counts")
    n_pos, n_neg = (int(x or 0) for x in counts.where("feature < 0").agg(F.sum("docs_pos"), F.sum("docs_neg")).first())
    weight = np.zeros(1 << bits)
    if not n_pos or not n_neg:
        return Model(weight, 0.0, grams, bits)
    pos, neg, n = F.col("pos"), F.col("neg"), float(n_pos + n_neg)
    apart = (pos * (n_neg - neg) - neg * (n_pos - pos)).cast("double")
    chi = apart * apart * n / (F.lit(float(n_pos)) * n_neg * (pos + neg) * F.greatest(n - pos - neg, F.lit(1.0)))
    top = counts.where("feature >= 0").select("feature", "pos", "neg", chi.alias("chi")).orderBy(F.desc("chi"), "feature").limit(kept).toArrow()
    at, pos, neg = (top.column(c).to_numpy() for c in ("feature", "pos", "neg"))
    r = np.log(((pos + 1) / (n_pos + 2)) / ((neg + 1) / (n_neg + 2)))
    place = np.full(1 << bits, -1, np.int32)
    place[at] = np.arange(len(at))
    few = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).select("doc_id", F.xxhash64(F.col("doc_id")).alias("o")).orderBy("o", "doc_id").limit(fit_rows)
        few = part if few is None else few.union(part)
    picked = known.join(F.broadcast(few.select("doc_id").distinct()), "doc_id").select("text", "y", F.xxhash64("doc_id").alias("o"), F.xxhash64("text", "y").alias("o2"))
    vectors = common.materialize(picked.mapInArrow(_vectors(place, grams, bits), "y int, o long, o2 long, x array<int>"), "vectors")
    first = Window.partitionBy("y").orderBy("o", "o2").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # about `fit_rows` rows
    sample = vectors.withColumn("total", F.sum(F.size("x")).over(first)).where(F.col("total") <= fit_values // 2).select("y", "x").toArrow()
    x = sample.column("x").combine_chunks()
    w, b = _fit(x.flatten().to_numpy(), np.diff(x.offsets.to_numpy()), sample.column("y").to_numpy(), r, rounds, penalty)
    weight[at] = w * r
    return Model(weight, float(b), grams, bits)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    spark = docs.sparkSession
    at = np.flatnonzero(model.weight).astype(np.int32)
    shared = spark.sparkContext.broadcast((at, model.weight[at], model.bias, model.grams, model.bits))  # at most `kept` numbers
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("score", pa.float64())])

    def run(batches):
        common.give_back()
        at, values, bias, grams, bits = shared.value
        weight = np.zeros(1 << bits)
        weight[at] = values
        m = Model(weight, bias, grams, bits)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.nulls(len(batch), pa.string()), pa.array([m.score(t) for t in batch.column("text").to_pylist()], pa.float64())], schema=schema)

    got = common.id_text(docs).mapInArrow(run, "doc_id long, text string, score double")
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return score(docs, train(docs, common.table(spark, sf_dir, "labels")))


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of docs, all columns as they are, whose text scores under the threshold; all, if the model has learned nothing."""
    if not model.weight.any():
        return docs
    at = np.flatnonzero(model.weight).astype(np.int32)
    shared = docs.sparkSession.sparkContext.broadcast((at, model.weight[at], model.bias, model.grams, model.bits))

    def run(batches):
        common.give_back()
        at, values, bias, grams, bits = shared.value
        weight = np.zeros(1 << bits)
        weight[at] = values
        m = Model(weight, bias, grams, bits)
        for batch in batches:
            yield batch.filter(pa.array([m.score(t or "") < threshold for t in batch.column(batch.schema.get_field_index("text")).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
