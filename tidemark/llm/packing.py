"""Operator 7, best-fit packing planned over the histogram of lengths.

Method. Only the number of pieces of each length (at most `capacity` numbers) reaches the driver, which runs best-fit decreasing over those
counts: whole groups of equally filled sequences take pieces at a time, so the plan is a short list of runs (length, first rank, pieces per
sequence, first sequence, offset) whatever the number of documents. Each piece then takes the slot of its rank within its length.

Scale. One encoding pass. Ranks are counted in salted groups of a length, so that a length that most pieces share is spread; the plan's size
depends on `capacity` alone.

Defined cases. Null text: empty, just the end id. A very long text is cut into many pieces. Null ids and repeated rows are documents of their
own; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.encoding import encoder, tokenizer_path

CAPACITY = 4096
END_ID = 1
SALT_ROWS = 2_000
_PIECES = "rid long, doc_id long, piece int, start long, length long, ids_crc32 long"


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: runs (length, first rank, pieces in each sequence, first sequence, offset), by length and rank.

    A run goes on to the next run of its length; its k-th piece lies in sequence first + k // each, at offset + k % each * length.
    """
    runs, room, bins = [], [], 0  # room: (free, first sequence, number of sequences), sorted
    for size in sorted(counts, reverse=True):
        left, rank = counts[size], 0
        while left:
            at = bisect_left(room, (size, 0, 0))
            if at < len(room):
                free, first, many = room.pop(at)
            else:
                free, first, many = capacity, bins, -(-left // (capacity // size))
                bins += many
            each = free // size
            full = min(many, left // each)
            if full:
                runs.append((size, rank, each, first, capacity - free))
                rank, left = rank + full * each, left - full * each
                if free - each * size:
                    insort(room, (free - each * size, first, full))
                first, many = first + full, many - full
            if many and left and left < each:
                runs.append((size, rank, left, first, capacity - free))
                insort(room, (free - left * size, first, 1))
                rank, left, first, many = rank + left, 0, first + 1, many - 1
            if many:
                insort(room, (free, first, many))
    return sorted(runs)


def _pieces(path: str, capacity: int, end_id: int):
    schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        common.give_back(encoders=False)
        e = encoder(path)
        end = np.array([end_id], e.code).tobytes()
        for batch in batches:
            out = []
            for rid, doc_id, text in zip(*common.columns(batch, "rid", "doc_id", "text"), strict=True):
                ids = np.frombuffer(e.encode(text) + end, e.code).astype("<u4")
                for k, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    out.append((rid, doc_id, k, start, len(part), zlib.crc32(part)))
            yield common.record_batch(schema, out)

    return run


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, salt_rows: int = SALT_ROWS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = common.materialize(common.keyed(docs).mapInArrow(_pieces(path, capacity, end_id), _PIECES), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).toArrow().to_pylist()}  # at most `capacity` rows
    runs = plan(counts, capacity)
    salts = max(1, -(-max(counts.values(), default=1) // salt_rows))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("rid", "piece"), F.lit(salts)))
    base = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    ranked = salted.withColumn("k", F.row_number().over(Window.partitionBy("length", "salt").orderBy("rid", "piece"))).join(base, ["length", "salt"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("k") - 1).alias("rank"))
    table = docs.sparkSession.sparkContext.broadcast(np.array(runs, np.int64).reshape(-1, 5))
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def place(batches):
        size, first_rank, each, first, offset = table.value.T
        lows = np.searchsorted(size, np.arange(capacity + 2))
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.empty(len(length), np.int64)
            for n in np.unique(length):
                lo, hi = lows[n], lows[n + 1]
                mine = length == n
                at[mine] = lo + np.searchsorted(first_rank[lo:hi], rank[mine], "right") - 1
            k = rank - first_rank[at]
            made = first[at] + k // each[at], offset[at] + k % each[at] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), *map(pa.array, made)], schema=schema)

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
