"""Operator 2, substring dedup with a log-structured fingerprint index.

Method. Windows of `width` consecutive words are fingerprinted by an anchor (the `gram` of words with the smallest rolling hash in the
window, hash h) and a hash c of all words that the windows of one anchor cover. The index is a log of immutable runs, each sorted by (h, c)
and holding each phrase once with its first place. A batch makes its own run, is merge-joined with the older runs on (h, c) (known phrases
go as a whole) and on h (phrases that share an anchor without being equal), and the latter are verified word by word: a window goes if the
same words start earlier. Then the run joins the log and runs of one level are compacted when `fanout` have gathered.

Scale. A row for about seven words, aggregated inside a task first, so a phrase in a third of all rows leaves a task once. Joins are plain
equi-joins; groups of an anchor with more than `group_limit` phrases are cut into runs of windows that are counted as rows, not in one task.

Defined cases. Null text: no words. Texts under `width` words keep all, very long ones are read in overlapping blocks. Null ids come first and ties of ids go by text; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common, rolling
from tidemark.llm.suffix_dedup import _bitmaps, _groups, preaggregated, suffix_ranks

WIDTH = 20
GRAM = 4
GROUP_LIMIT = 2000
BATCHES = 2
FANOUT = 2
_ROWS = "h long, c long, rid long, pos long, n long"
_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, removed array<long>"


def _phrases(width: int, gram: int):
    schema = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("rid", pa.int64()), ("pos", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            ids, made = batch.column("rid").to_numpy(), []
            words = [np.fromiter(map(xxhash.xxh3_64_intdigest, t.encode().split()), np.uint64) for t in batch.column("text").to_pylist()]
            for block in rolling.blocks(map(len, words), width):
                a = rolling.anchors(np.concatenate([words[k][s:e] for k, s, e in block]), block, width, gram)
                made.append((a["h"], a["c"], ids[np.array([k for k, _, _ in block])[a["piece"]]], a["first"] << 8 | (a["count"] - 1)))
            if made:
                yield from preaggregated(schema, *map(np.concatenate, zip(*made, strict=True)))

    return run


def _bodies(width: int):
    schema = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("rid", pa.int64()), ("pos", pa.int64()), ("m", pa.int64()), ("body", pa.binary())])

    def run(batches):
        for batch in batches:
            out = []
            for rid, text, asked in zip(*common.columns(batch, "rid", "text", "asked"), strict=True):
                words = text.encode().split()
                for x in asked:
                    first = x["pos"] >> 8
                    out.append((x["h"], x["c"], rid, x["pos"], x["m"], b" ".join(words[first : first + (x["pos"] & 255) + width])))
            for part in common.in_blocks(iter(out), 5000):
                yield common.record_batch(schema, part)

    return run


def _inside(width: int):
    """For each phrase the bitmap of its windows whose words also start at an earlier place, if it has any."""
    schema = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("hits", pa.binary())])

    def run(batches):
        for rows in _groups(batches, 1 << 20):
            rows.sort(key=lambda r: (r["rid"], r["pos"]))
            words = [r["body"].split(b" ") for r in rows]
            known: dict[bytes, int] = {}
            flat = np.array([known.setdefault(w, len(known)) for ws in words for w in ws], np.int64)
            rank = suffix_ranks(flat, 1, np.cumsum([0] + [len(w) for w in words]), width)
            counts = np.array([len(w) - width + 1 for w in words])
            h = np.unique([r["h"] for r in rows], return_inverse=True)[1].repeat(counts)
            key = h.astype(np.int64) * (int(rank.max()) + 1) + rank
            hit = np.ones(len(key), bool)
            hit[np.unique(key, return_index=True)[1]] = False  # rows are in order of place, so the first of equal windows stays
            edge = np.append(0, np.cumsum(counts))
            out = [(r["h"], r["c"], np.packbits(hit[s:e]).tobytes()) for r, s, e in zip(rows, edge[:-1], edge[1:], strict=True) if hit[s:e].any()]
            if out:
                yield common.record_batch(schema, out)

    return run


def _symbols(body: bytes) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, body.split(b" ")), np.uint64)


def _pieces(width: int, gram: int, step: int):
    """For oversized groups: each phrase cut into runs of windows by the anchor's offset in them."""
    schema = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("rid", pa.int64()), ("pos", pa.int64()), ("p", pa.int32()), ("core", pa.int64()), ("cover", pa.int64()), ("k", pa.int32()), ("m", pa.int32())])

    def run(batches):
        for batch in batches:
            made = [rolling.offset_runs(_symbols(x), width, gram, step) for x in batch.column("body").to_pylist()]
            if made:
                count = [len(x[0]) for x in made]
                yield pa.RecordBatch.from_arrays([*(pa.array(np.repeat(batch.column(x).to_numpy(), count)) for x in ("h", "c", "rid", "pos")), *(pa.array(np.concatenate(x)) for x in zip(*made, strict=True))], schema=schema)

    return run


def _exploded(width: int):
    """A row for each window of the runs that are asked for, told apart by two independent hashes."""
    schema = pa.schema([("h", pa.int64()), ("w1", pa.int64()), ("w2", pa.int64()), ("c", pa.int64()), ("k", pa.int32()), ("rid", pa.int64()), ("pos", pa.int64())])

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                words = _symbols(r["body"])
                k = np.concatenate([np.arange(x["k"], x["k"] + x["m"]) for x in r["runs"]])
                one, two = (rolling.Hashes(words, w).of(k, k + width).view(np.int64) for w in (0, 1))
                m = len(k)
                yield pa.RecordBatch.from_arrays([pa.array([r["h"]] * m, pa.int64()), pa.array(one), pa.array(two), pa.array([r["c"]] * m, pa.int64()), pa.array(k, pa.int32()), pa.array([r["rid"]] * m, pa.int64()), pa.array([r["pos"]] * m, pa.int64())], schema=schema)

    return run


def _oversized(bodies: DataFrame, width: int, gram: int) -> DataFrame:
    """h, c, hits for the phrases of oversized groups, without any group in one task.

    Equal windows hold their anchor at one offset, so runs of windows are compared by offset: of equal runs all but the earliest go as a
    whole, a run whose core no other run shares stays, and only the earliest of the runs left are compared window by window.
    """
    step, earliest = math.isqrt(width - gram + 1), F.min(F.struct("rid", "pos", "c", "k", "m")).alias("at")
    pieces = common.materialize(bodies.mapInArrow(_pieces(width, gram, step), "h long, c long, rid long, pos long, p int, core long, cover long, k int, m int"), "pieces")
    covers = common.materialize(pieces.groupBy("h", "p", "core", "cover").agg(F.count("*").alias("n"), earliest).select("h", "p", "core", "cover", "n", "at.*"), "covers")
    shared = covers.groupBy("h", "p", "core").agg(F.count("*").alias("t")).where("t > 1").select("h", "p", "core")
    runs = covers.join(shared, ["h", "p", "core"]).groupBy("h", "c").agg(F.collect_list(F.struct("k", "m")).alias("runs"))
    windows = bodies.join(runs, ["h", "c"]).mapInArrow(_exploded(width), "h long, w1 long, w2 long, c long, k int, rid long, pos long")
    windows = common.materialize(windows, "windows")
    least = windows.groupBy("h", "w1", "w2").agg(F.count("*").alias("n"), F.min(F.struct("rid", "pos")).alias("at")).where("n > 1").select("h", "w1", "w2", F.col("at.rid").alias("rid0"), F.col("at.pos").alias("pos0"))
    late = windows.join(least, ["h", "w1", "w2"]).where("rid <> rid0 OR pos <> pos0").select("h", "c", "k", F.lit(1).alias("m"))
    again = covers.where("n > 1").select("h", "p", "core", "cover", F.col("c").alias("c0"))
    whole = pieces.join(again, ["h", "p", "core", "cover"]).where("c <> c0").select("h", "c", "k", "m")
    return late.union(whole).groupBy("h", "c").agg(F.collect_list(F.struct("k", "m")).alias("runs")).mapInArrow(_bitmaps, "h long, c long, hits binary")


def _apply(width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("removed", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, text, marks in zip(*common.columns(batch, "doc_id", "text", "marks"), strict=True):
                words = text.encode().split()
                gone = np.zeros(len(words), bool)
                for m in marks or ():
                    first, count, bits = m["pos"] >> 8, (m["pos"] & 255) + 1, m["hits"]
                    if bits is None:
                        gone[first : first + count - 1 + width] = True
                    else:
                        for k in np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), count=count)):
                            gone[first + k : first + k + width] = True
                turns = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
                kept = words if not len(turns) else [w for w, g in zip(words, gone, strict=True) if not g]
                out.append((doc_id, len(words), int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest(), turns.tolist()))
            yield common.record_batch(schema, out)

    return run


class FingerprintLog:
    """The index: a list of (level, rows, frame) runs, oldest first. `texts` must hold every document ever ingested (rid, text)."""

    def __init__(self, width: int = WIDTH, gram: int = GRAM, group_limit: int = GROUP_LIMIT, fanout: int = FANOUT):
        if not 1 <= gram <= width <= gram + 255:
            raise ValueError("need 1 <= gram <= width <= gram + 255")
        self.width, self.gram, self.group_limit, self.fanout = width, gram, group_limit, fanout
        self.runs: list[tuple[int, DataFrame]] = []

    def history(self) -> DataFrame | None:
        out = None
        for _, run in self.runs:
            out = run if out is None else out.union(run)
        return out

    def compact(self) -> None:
        """Merges the newest runs of one level into one of the next; a phrase of several runs keeps its earliest place."""
        while len(self.runs) >= self.fanout and len({lv for lv, _ in self.runs[-self.fanout :]}) == 1:
            level, merged = self.runs[-1][0], None
            for _, run in self.runs[-self.fanout :]:
                merged = run if merged is None else merged.union(run)
            first = merged.groupBy("h", "c").agg(F.min(F.struct("rid", "pos")).alias("at")).select("h", "c", "at.rid", "at.pos")
            self.runs[-self.fanout :] = [(level + 1, common.materialize(first.repartitionByRange("h", "c").sortWithinPartitions("h", "c"), "compacted"))]

    def ingest(self, batch: DataFrame, texts: DataFrame) -> DataFrame:
        """batch: rid, doc_id, text, with no rid before an ingested one. Returns one row per document of the batch.

        Of the tables written on the way only the batch's run and its marks stay.
        """
        with common.scratch(batch.sparkSession) as keep:
            fresh, marks = self._marks(batch, texts)
            self.runs.append((0, keep(fresh)))
            keep(marks)
        self.compact()
        clear = common.apart(batch, "rid", marks.select("rid")).withColumn("marks", F.lit(None).cast(marks.schema["marks"].dataType))
        hit = common.among(batch, "rid", marks.select("rid")).join(marks.hint("merge"), "rid", "left")
        return clear.unionByName(hit).select("doc_id", "text", "marks").mapInArrow(_apply(self.width), _RESULT)

    def _marks(self, batch: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The batch's run without what the log had already, and by rid the runs of windows that go; both written."""
        made = common.materialize(batch.where(F.octet_length("text") >= 2 * self.width - 1).mapInArrow(_phrases(self.width, self.gram), _ROWS), "phrases")
        rows = made.where("h IS NOT NULL").drop("n")
        firsts = rows.groupBy("h", "c").agg(F.count("*").alias("n"), F.min(F.struct("rid", "pos")).alias("at")).select("h", "c", "n", "at.rid", "at.pos")
        old = self.history()
        if old is not None:
            # One merge join with the log tells known phrases from new ones.
            firsts = firsts.join(old.select("h", "c", F.lit(True).alias("known")), ["h", "c"], "left")
        else:
            firsts = firsts.withColumn("known", F.lit(None).cast("boolean"))
        firsts = common.materialize(firsts.sortWithinPartitions("h", "c"), "firsts")  # dealt by (h, c) already
        fresh = common.materialize(firsts.where("known IS NULL").select("h", "c", "rid", "pos"), "run")
        place = lambda c: F.when(F.col("known").isNull(), F.col(c))
        seen = firsts.where("n > 1 OR known").select("h", "c", place("rid").alias("rid0"), place("pos").alias("pos0"))
        mixed = fresh.groupBy("h").agg(F.count("*").alias("m"))
        if old is not None:
            mixed = mixed.join(old.groupBy("h").agg(F.count("*").alias("m_old")), "h", "left").select("h", (F.col("m") + F.coalesce("m_old", F.lit(0))).alias("m"))
        mixed = common.materialize(mixed.where("m > 1"), "mixed")
        compared = fresh.join(mixed, "h").withColumn("new", F.lit(True))
        if old is not None:
            compared = compared.union(old.join(mixed, "h").withColumn("new", F.lit(False)))
        compared = common.materialize(compared, "compared")
        asked = common.materialize(compared.groupBy("rid").agg(F.collect_list(F.struct("h", "c", "pos", "m")).alias("asked")), "asked")
        bodies = common.among(texts.select("rid", "text"), "rid", asked.select("rid")).join(asked.hint("merge"), "rid").mapInArrow(_bodies(self.width), "h long, c long, rid long, pos long, m long, body binary")
        bodies = common.materialize(bodies, "bodies")
        fit = bodies.where(F.col("m") <= self.group_limit).drop("m").repartition("h").sortWithinPartitions("h").mapInArrow(_inside(self.width), "h long, c long, hits binary")
        late = _oversized(bodies.where(F.col("m") > self.group_limit).drop("m"), self.width, self.gram)
        inside = compared.where("new").select("h", "c", "rid", "pos").join(fit.union(late), ["h", "c"]).select("rid", "pos", "hits")
        everything = F.lit(None).cast("binary").alias("hits")
        later = rows.join(seen, ["h", "c"]).where("rid0 IS NULL OR rid <> rid0 OR pos <> pos0").select("rid", "pos", everything)
        marks = inside.union(later).union(made.where("h IS NULL").select("rid", "pos", everything)).groupBy("rid").agg(F.collect_list(F.struct("pos", "hits")).alias("marks"))
        return fresh, common.materialize(marks, "marks")


def repeated_words(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, group_limit: int = GROUP_LIMIT, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """Feeds whole documents to a new index in `batches` parts of ascending ids; one row per document."""
    keys = common.keyed(docs)
    log, out, low = FingerprintLog(width, gram, group_limit, fanout), None, None
    cuts = keys.agg(F.percentile_approx("rid", F.array(*[F.lit(k / batches) for k in range(1, batches)])) if batches > 1 else F.array().cast("array<long>")).first()[0] or []
    for high in [*sorted(set(cuts)), None]:
        part = keys if low is None else keys.where(F.col("rid") > low)
        part = part if high is None else part.where(F.col("rid") <= high)
        got = log.ingest(part, keys if high is None else keys.where(F.col("rid") <= high))
        out, low = got if out is None else out.union(got), high
    return out


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_words(common.table(spark, sf_dir, "documents")).drop("removed")
