"""Shared plumbing: reading a table's columns whatever else it holds, cutting lineage in the shared folder, connected components."""

from __future__ import annotations

import ctypes
import sys
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import bounded_batches, shared_dir, small_batches  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


_scratch: list[dict[int, str]] = []


def materialize(df: DataFrame, tag: str, codec: str = "zstd") -> DataFrame:
    """Writes a frame once in the shared folder and reads it back: lineage ends here and survives lost executors."""
    path = fresh_path(df.sparkSession, tag)
    df.write.option("compression", codec).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    if _scratch:
        _scratch[-1][id(out)] = path
        _frames.append(out)  # held, so that no other frame gets its number
    return out


_frames: list[DataFrame] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables that materialize writes inside are deleted behind it, but for those given to the function that it yields.

    Whatever goes on to be used must rest on kept tables (or on none of these): nothing else could be computed anew.
    """
    noted: dict[int, str] = {}
    first = len(_frames)
    _scratch.append(noted)

    def keep(df: DataFrame) -> DataFrame:
        noted.pop(id(df))
        return df

    try:
        yield keep
    finally:
        _scratch.pop()
        del _frames[first:]
        hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsparkSession.sessionState().newHadoopConf()
        for path in noted.values():
            at = hadoop.Path(path)
            at.getFileSystem(conf).delete(at, True)


def give_back(encoders: bool = True) -> None:
    """For the start of a task: what earlier stages left in its Python worker goes, their encoders (unless wanted) and freed memory that the allocators still hold."""
    encoding = sys.modules.get("tidemark.llm.encoding")
    if encoders and encoding:
        encoding.encoder.cache_clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


FILTER_BITS = 1 << 24


def spare(df: DataFrame, *names: str) -> list[str]:
    """Like these names, but none that the frame has in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def _marked(df: DataFrame, key: str, wanted: DataFrame, may: str) -> DataFrame:
    """df with the column `may`: whether the key may be among the wanted ones, by a hashed set of FILTER_BITS bits; false: it is not.

    What is broadcast is at most FILTER_BITS / 64 rows, however many are wanted; the more are, the more others are marked.
    """
    at = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(FILTER_BITS))
    bit, word, bits = spare(df, "_bit", "_word", "_bits")
    words = wanted.select(at(wanted.columns[0]).alias(bit)).select(F.shiftright(bit, 6).alias(word), F.expr(f"shiftleft(1L, cast({bit} & 63 AS int))").alias(bits)).groupBy(word).agg(F.bit_or(bits).alias(bits))
    marked = df.withColumn(bit, at(key)).withColumn(word, F.shiftright(bit, 6)).join(F.broadcast(words), word, "left")
    return marked.select(*df.columns, F.expr(f"coalesce(shiftright({bits}, cast({bit} & 63 AS int)) & 1L, 0L) = 1").alias(may))


def among(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows of df whose key may be among the wanted ones (one column): all that are, and some others."""
    (may,) = spare(df, "_may")
    return _marked(df, key, wanted, may).where(may).drop(may)


def apart(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The other rows: those whose key is surely not among the wanted ones."""
    (may,) = spare(df, "_may")
    return _marked(df, key, wanted, may).where(f"NOT {may}").drop(may)


def without(df: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """The rows of df whose key (not null) is none of `gone` (one column); only rows that may be are shuffled."""
    return apart(df, key, gone).unionByName(among(df, key, gone).join(gone.withColumnRenamed(gone.columns[0], key).hint("merge"), key, "left_anti").select(*df.columns))


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the id and the text (null: empty), under names that nothing else in the table can clash with."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def keyed(docs: DataFrame) -> DataFrame:
    """rid, doc_id, text: rid is unique, not null and ordered as doc_id is (nulls first, ties by text).

    Where doc_id itself is unique and not null, it is the rid; else the rows are numbered in one range-partitioned sort, written once.
    """
    plain = id_text(docs)
    odd = plain.select("doc_id").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").limit(1).count()
    if not odd:
        return plain.select(F.col("doc_id").alias("rid"), "doc_id", "text")
    return materialize(plain.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text").select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text"), "numbered")


def record_batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    """A batch from rows as tuples in the schema's order."""
    cols = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(cols, schema, strict=True)], schema=schema)


def columns(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(n).to_pylist() for n in names]


def in_blocks(items: Iterator, size: int) -> Iterator[list]:
    block = []
    for x in items:
        block.append(x)
        if len(block) >= size:
            yield block
            block = []
    if block:
        yield block


def components(edges: DataFrame, tag: str = "components", most: int = 60) -> DataFrame:
    """Connected components of edges (a, b), any number of repeats: (node, component), the component being its smallest node.

    Large-star and small-star rounds: each replaces the edges by as many or fewer that lead to smaller nodes, until all lead to the smallest.
    A round is two partial aggregations and joins on the nodes; nothing is collected but two sums.
    """
    e = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct()
    e = materialize(e, tag)
    before = None
    for _ in range(most):
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select(F.col("lo"), F.col("hi")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(low.select("hi", "m")).where("hi <> lo").distinct()
        e = materialize(small, tag)
        now = tuple(e.agg(F.count("*"), F.sum(F.col("lo").cast("decimal(38,0)")), F.sum(F.col("hi").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    return e.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("component"))


def numbered(df: DataFrame, order: list[str], value: str, start: str, tag: str) -> DataFrame:
    """Writes df in ascending order and adds `start`, the sum of `value` over all rows before each, and `part`, the range it lies in.

    Ranges are sorted apart; only one sum for each range comes together.
    """
    kept = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()), tag)
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = kept.groupBy("part").agg(F.sum(value).alias("_sum")).select("part", F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias("_base"))
    inner = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return kept.join(F.broadcast(base), "part").withColumn(start, F.col("_base") + F.coalesce(F.sum(value).over(inner), F.lit(0))).drop("_base")
