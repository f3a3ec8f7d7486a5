"""Operator 1, suffix-array dedup of repeated byte strings by prefix-free parsing.

Method. Rolling-hash triggers cut each text into phrases: of the 32-byte grams in a window of `length` bytes, the one with the smallest
rolling hash triggers, so equal windows are cut at the same place and the compared strings (a window, which always holds its trigger) are
prefix-free. The dictionary holds the distinct extended phrases (all that one trigger's windows cover), the parse says where each occurs.
A phrase that occurs twice repeats with all its windows and needs no look inside. Only phrases that share a trigger without being equal are
compared: their windows are sorted as suffixes (prefix doubling to `length` bytes) and a window repeats if its neighbour in that order is
equal or its phrase occurs more than once. The parse then carries the repeated windows back to the documents.

Scale. One text pass makes about one row for 65 bytes. Counts are partial aggregations on (trigger) and (trigger, phrase); the joins that
lead back are plain equi-joins that AQE may split. Trigger groups with more than `group_limit` distinct phrases go another, equally exact
way: their phrases are cut into runs of windows by the trigger's offset, which are counted as rows, so no task holds such a group.

Defined cases. Null text: empty. Texts under `length` bytes: nothing is removed. Very long texts are read in overlapping blocks. Null ids are kept as null, rows that repeat an id and a
text count as two documents, an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common, rolling

LENGTH = 200
GRAM = 32
GROUP_LIMIT = 2000
_PARSE = "h long, c long, rid long, pos long, n long"
_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<long>"


def _parse(length: int, gram: int):
    """One row for each phrase that the batch holds, with how often, at the place of its first; a row without phrase for each further place."""
    schema = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("rid", pa.int64()), ("pos", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            raw = [x.encode() for x in batch.column("text").to_pylist()]
            ids = batch.column("rid").to_numpy()
            made = []
            for block in rolling.blocks(map(len, raw), length):
                a = rolling.anchors(np.frombuffer(b"".join(raw[k][s:e] for k, s, e in block), np.uint8), block, length, gram)
                made.append((a["h"], a["c"], ids[np.array([k for k, _, _ in block])[a["piece"]]], a["first"] << 8 | (a["count"] - 1)))
            if made:
                yield from preaggregated(schema, *map(np.concatenate, zip(*made, strict=True)))

    return run


def preaggregated(schema, h, c, rid, pos):
    order = np.lexsort((pos, rid, c, h))
    h, c, rid, pos = h[order], c[order], rid[order], pos[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])])
    n = np.diff(np.append(np.flatnonzero(new), len(new)))
    gone = pa.nulls(int((~new).sum()), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(h[new]), pa.array(c[new]), pa.array(rid[new]), pa.array(pos[new]), pa.array(n)], schema=schema)
    yield pa.RecordBatch.from_arrays([gone, gone, pa.array(rid[~new]), pa.array(pos[~new]), gone], schema=schema)


def suffix_ranks(first: np.ndarray, span: int, edges: np.ndarray, length: int) -> np.ndarray:
    """Rank in suffix order, to `length` symbols, of each window of texts laid end to end; equal windows rank alike.

    first: ranks of the runs of `span` symbols. Prefix doubling; the last step overlaps, so that it does not pass the window's end.
    """
    n, rank = len(first), np.unique(first, return_inverse=True)[1].astype(np.int64)
    while span < length:
        step = min(span, length - span)
        ahead = np.zeros(n, np.int64)
        ahead[: n - step] = rank[step:]
        rank = np.unique(rank * n + ahead, return_inverse=True)[1].astype(np.int64)
        span += step
    return rank[np.concatenate([np.arange(s, e - length + 1) for s, e in zip(edges[:-1], edges[1:], strict=True)])]


def equal_windows(texts: list[bytes], length: int) -> np.ndarray:
    """Suffix ranks of all windows of byte strings, each at least `length` long, from their first 8 bytes as a big-endian number."""
    raw = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
    n = len(raw) - 8
    word = np.zeros(n, np.uint64)
    for k in range(8):
        word = word << np.uint64(8) | raw[k : n + k].astype(np.uint64)
    return suffix_ranks(word, 8, np.cumsum([0] + [len(t) for t in texts]), length)


def _groups(batches, limit_bytes: int):
    """Whole groups of equal h, several at a time, from rows sorted by h."""
    held, size = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            if size > limit_bytes and row["h"] != held[-1]["h"]:
                yield held
                held, size = [], 0
            held.append(row)
            size += len(row["body"])
    if held:
        yield held


def _inside(length: int):
    """For each phrase the bitmap of its repeated windows, if it has any."""
    schema = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("hits", pa.binary())])

    def run(batches):
        for rows in _groups(batches, 1 << 21):
            rank = equal_windows([r["body"] for r in rows], length)
            counts = np.array([len(r["body"]) - length + 1 for r in rows])
            h = np.unique([r["h"] for r in rows], return_inverse=True)[1].repeat(counts)
            key = np.unique(h.astype(np.int64) * (int(rank.max()) + 1) + rank, return_inverse=True)[1]
            weight = np.bincount(key, np.array([r["n"] for r in rows]).repeat(counts))
            hit = (weight > 1)[key]
            edge = np.append(0, np.cumsum(counts))
            out = [(r["h"], r["c"], np.packbits(hit[s:e]).tobytes()) for r, s, e in zip(rows, edge[:-1], edge[1:], strict=True) if hit[s:e].any()]
            if out:
                yield common.record_batch(schema, out)

    return run


def _pieces(length: int, gram: int, step: int):
    """For oversized groups: each phrase cut into runs of windows by the trigger's offset in them."""
    schema = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("n", pa.int64()), ("p", pa.int32()), ("core", pa.int64()), ("cover", pa.int64()), ("k", pa.int32()), ("m", pa.int32())])

    def run(batches):
        for batch in batches:
            bodies = batch.column("body").to_pylist()
            made = [rolling.offset_runs(np.frombuffer(x, np.uint8), length, gram, step) for x in bodies]
            if made:
                count = [len(x[0]) for x in made]
                yield pa.RecordBatch.from_arrays([*(pa.array(np.repeat(batch.column(x).to_numpy(), count)) for x in ("h", "c", "n")), *(pa.array(np.concatenate(x)) for x in zip(*made, strict=True))], schema=schema)

    return run


def _exploded(length: int):
    """A row for each window of the runs that are asked for, told apart by two independent hashes; single: the run occurs once."""
    schema = pa.schema([("h", pa.int64()), ("w1", pa.int64()), ("w2", pa.int64()), ("c", pa.int64()), ("k", pa.int32()), ("n", pa.int64()), ("single", pa.bool_())])

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                raw = np.frombuffer(r["body"], np.uint8)
                k = np.concatenate([np.arange(x["k"], x["k"] + x["m"]) for x in r["runs"]])
                n = np.repeat([x["n"] for x in r["runs"]], [x["m"] for x in r["runs"]])
                one, two = (rolling.Hashes(raw, w).of(k, k + length).view(np.int64) for w in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array([r["h"]] * len(k), pa.int64()), pa.array(one), pa.array(two), pa.array([r["c"]] * len(k), pa.int64()), pa.array(k, pa.int32()), pa.array(n, pa.int64()), pa.array(n == 1)], schema=schema)

    return run


def _oversized(bodies: DataFrame, length: int, gram: int) -> DataFrame:
    """h, c, hits for the phrases of oversized groups, without any group in one task.

    Equal windows hold their trigger at one offset, so runs of windows are compared by offset: a run that occurs twice repeats as a whole, a
    run whose core no other run shares does not repeat, and only the runs left are compared window by window.
    """
    step = math.isqrt(length - gram + 1)
    pieces = common.materialize(bodies.mapInArrow(_pieces(length, gram, step), "h long, c long, n long, p int, core long, cover long, k int, m int"), "pieces")
    covers = common.materialize(pieces.groupBy("h", "p", "core", "cover").agg(F.sum("n").alias("n"), F.min(F.struct("c", "k", "m")).alias("at")).select("h", "p", "core", "cover", "n", "at.*"), "covers")
    open_cores = covers.groupBy("h", "p", "core").agg(F.count("*").alias("t"), F.min("n").alias("least")).where("t > 1 AND least = 1").select("h", "p", "core")
    runs = covers.join(open_cores, ["h", "p", "core"]).groupBy("h", "c").agg(F.collect_list(F.struct("k", "m", "n")).alias("runs"))
    windows = bodies.select("h", "c", "body").join(runs, ["h", "c"]).mapInArrow(_exploded(length), "h long, w1 long, w2 long, c long, k int, n long, single boolean")
    windows = common.materialize(windows, "windows")
    twice = windows.groupBy("h", "w1", "w2").agg(F.sum("n").alias("n")).where("n > 1").drop("n")
    found = windows.where("single").join(twice, ["h", "w1", "w2"]).select("h", "c", "k", F.lit(1).alias("m"))
    whole = pieces.join(covers.where("n > 1").select("h", "p", "core", "cover"), ["h", "p", "core", "cover"]).select("h", "c", "k", "m")
    return found.union(whole).groupBy("h", "c").agg(F.collect_list(F.struct("k", "m")).alias("runs")).mapInArrow(_bitmaps, "h long, c long, hits binary")


def _bodies(length: int):
    """The bytes of the phrases that are asked for, from their documents."""
    schema = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("n", pa.int64()), ("body", pa.binary())])

    def run(batches):
        for batch in batches:
            out = []
            for text, asked in zip(*common.columns(batch, "text", "asked"), strict=True):
                raw = text.encode()
                out += [(x["h"], x["c"], x["n"], raw[x["pos"] >> 8 : (x["pos"] >> 8) + (x["pos"] & 255) + length]) for x in asked]
            for part in common.in_blocks(iter(out), 5000):
                yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)

    return run


def _apply(length: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("removed", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, text, marks in zip(*common.columns(batch, "doc_id", "text", "marks"), strict=True):
                raw = text.encode()
                if not marks:
                    out.append((doc_id, len(raw), 0, 0, hashlib.sha256(raw).hexdigest(), []))
                    continue
                edge = np.zeros(len(raw) + 1, np.int32)
                for m in marks:
                    first, count, bits = m["pos"] >> 8, (m["pos"] & 255) + 1, m["hits"]
                    starts = [first] if bits is None else first + np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), count=count))
                    ends = [first + count - 1 + length] if bits is None else starts + length
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, ends, -1)
                gone = np.cumsum(edge[:-1]) > 0
                turns = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out.append((doc_id, len(raw), int(gone.sum()), len(turns) // 2, hashlib.sha256(kept).hexdigest(), turns.tolist()))
            yield common.record_batch(schema, out)

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (start, end, start, end, ... of the removed bytes)."""
    if not gram <= length or not 8 <= length <= gram + 255:
        raise ValueError("need 8 <= length, gram <= length <= gram + 255")
    keys = common.keyed(docs)
    parse = common.materialize(keys.where(F.octet_length("text") >= length).mapInArrow(_parse(length, gram), _PARSE), "parse")
    phrases = parse.where("h IS NOT NULL")
    shared = phrases.groupBy("h").agg(F.sum("n").alias("m"), (F.min("c") == F.max("c")).alias("alone")).where("m > 1").select("h", "alone")
    again = common.materialize(phrases.join(shared, "h"), "shared-triggers")
    # The dictionary of phrases whose trigger also stands in other phrases, each with one place where it occurs.
    place = F.min(F.struct("rid", "pos"))
    dictionary = common.materialize(again.where("not alone").groupBy("h", "c").agg(F.sum("n").alias("n"), place.alias("at")).select("h", "c", "n", "at.rid", "at.pos"), "dictionary")
    asked = dictionary.groupBy("rid").agg(F.collect_list(F.struct("h", "c", "n", "pos")).alias("asked"))
    bodies = keys.select("rid", "text").join(asked, "rid").select("text", "asked").mapInArrow(_bodies(length), "h long, c long, n long, body binary")
    size = dictionary.groupBy("h").agg(F.count("*").alias("m"))
    bodies = common.materialize(bodies.join(size, "h"), "bodies")
    fit = bodies.where(F.col("m") <= group_limit).drop("m").repartition("h").sortWithinPartitions("h").mapInArrow(_inside(length), "h long, c long, hits binary")
    large = _oversized(bodies.where(F.col("m") > group_limit).drop("m"), length, gram)
    everything = F.lit(None).cast("binary").alias("hits")
    # A phrase that occurs twice repeats as a whole, whatever is found inside it.
    inside = dictionary.where("n = 1").select("h", "c").join(fit.union(large), ["h", "c"]).union(dictionary.where("n > 1").select("h", "c", everything))
    marks = again.where("not alone").join(inside, ["h", "c"]).select("rid", "pos", "hits").union(again.where("alone").select("rid", "pos", everything)).union(parse.where("h IS NULL").select("rid", "pos", everything))
    marks = marks.groupBy("rid").agg(F.collect_list(F.struct("pos", "hits")).alias("marks"))
    return keys.join(marks, "rid", "left").select("doc_id", "text", "marks").mapInArrow(_apply(length), _RESULT)


def _bitmaps(batches):
    schema = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("hits", pa.binary())])
    for batch in batches:
        rows = []
        for h, c, runs in zip(*common.columns(batch, "h", "c", "runs"), strict=True):
            bits = np.zeros(max(x["k"] + x["m"] for x in runs), np.uint8)
            for x in runs:
                bits[x["k"] : x["k"] + x["m"]] = 1
            rows.append((h, c, np.packbits(bits).tobytes()))
        yield common.record_batch(schema, rows)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(common.table(spark, sf_dir, "documents")).drop("removed")
