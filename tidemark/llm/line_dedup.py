"""Operator 5, line dedup with a tree of line templates.

Method. A line is parsed to a leaf of fixed depth by its number of tokens and its `depth` leading tokens; a token with a digit is a variable
field from the start. Its first template is the line with those fields generalised. Within a leaf, templates that agree in all but one
further token are generalised to a wider one with that token as a variable field (lines of `least` tokens and more). With `agree`, as the
query and the pipeline have it, templates that agree in that share of their tokens or more are linked instead, and each component is one
template with all places where its members differ as variable fields. A template that occurs in `min_docs` documents or more recurs; of its
lines the first (smallest id, then place) stays and all others are dropped.

Scale. A first pass makes one small row for each line; leaves and templates are counted by partial aggregation, and only leaves that recur
and hold several templates are generalised, from one row for each distinct template; only the texts that hold one of these are shuffled
for it. Templates that differ in d tokens have one of d + 1 segments in common and meet there (only segments that several have travel with
tokens, once for each set of members), where a template is compared with those not yet reached by a link: once, where all are alike; the
most is a square, for many that share a segment but are not alike. Marks go back to the documents by one equi-join.

Defined cases. Null text: empty, which is one blank line. Blank lines are kept and never templates. A very long text or line is handled
whole, in one task. Of repeated lines the one with the smallest id, then place, stays (ties of ids: by text). Null ids come first, repeated
rows are documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common

DEPTH = 3
LEADING = 2  # depth of the query and the pipeline: fields often stand early in a line
LEAST = 6
AGREE = 0.8  # of the query and the pipeline
MIN_DOCS = 2  # of the query and the pipeline; the functions take 3 unless told otherwise
_DIGITS = frozenset("0123456789")


def tokens_of(line: str) -> list[bytes]:
    """Tokens of a line, those with a digit generalised."""
    raw = line.encode()
    if _DIGITS.isdisjoint(line):
        return raw.split()
    return [t if not any(48 <= b <= 57 for b in t) else b"<*>" for t in raw.split()]


def _hash(*parts: bytes) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(parts)) - (1 << 63)


def _lines(depth: int):
    schema = pa.schema([("leaf", pa.int64()), ("t", pa.int64()), ("rid", pa.int64()), ("line", pa.int64()), ("fresh", pa.int32())])

    def run(batches):
        common.give_back()
        for batch in batches:
            out = []
            for rid, text in zip(*common.columns(batch, "rid", "text"), strict=True):
                own = set()
                for k, line in enumerate(text.split("\n")):
                    w = tokens_of(line)
                    if w:
                        t = _hash(*w)
                        out.append((_hash(b"%d" % len(w), *w[:depth]), t, rid, k, int(t not in own)))
                        own.add(t)
            yield common.record_batch(schema, out)

    return run


def _wider(depth: int, least: int):
    """The wider templates of the asked lines: each further token but one."""
    schema = pa.schema([("leaf", pa.int64()), ("t", pa.int64()), ("docs", pa.int64()), ("wide", pa.int64()), ("rid", pa.int64()), ("line", pa.int64())])

    def run(batches):
        for batch in batches:
            out = []
            for rid, text, asked in zip(*common.columns(batch, "rid", "text", "asked"), strict=True):
                lines = text.split("\n")
                for x in asked:
                    w = tokens_of(lines[x["line"]])
                    if len(w) >= least:
                        out += [(x["leaf"], x["t"], x["docs"], _hash(b"%d" % k, *w[:k], b"<*>", *w[k + 1 :]), rid, x["line"]) for k in range(depth, len(w)) if w[k] != b"<*>"]
            for part in common.in_blocks(iter(out), 20_000):
                yield common.record_batch(schema, part)

    return run


def _segments(depth: int, least: int, agree: float):
    """The asked lines with a hash for each token, and the keys of their segments."""
    schema = pa.schema([("t", pa.int64()), ("body", pa.binary()), ("keys", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            out = []
            for text, asked in zip(*common.columns(batch, "text", "asked"), strict=True):
                lines = text.split("\n")
                for x in asked:
                    w = tokens_of(lines[x["line"]])
                    most = len(w) - math.ceil(agree * len(w) - 1e-9)
                    if len(w) >= least and most:
                        body = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w)).tobytes()
                        cuts = [depth + (len(w) - depth) * k // (most + 1) for k in range(most + 2)]
                        out.append((x["t"], body, [_hash(b"%d %d %d" % (len(w), x["leaf"], k), *w[a:b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]))
            for part in common.in_blocks(iter(out), 2_000):
                yield common.record_batch(schema, part)

    return run


def _meetings(bodies: DataFrame) -> DataFrame:
    """key, t, body for the segments that several templates have; of segments with the same members one is enough."""
    places = common.materialize(bodies.select("t", F.explode("keys").alias("key")), "segments")
    members = places.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("t")).alias("one"), F.bit_xor(F.xxhash64("t", F.lit(1))).alias("two")).where("n > 1")
    needed = members.groupBy("n", "one", "two").agg(F.min("key").alias("key")).select("key")
    return places.join(needed, "key").join(bodies.select("t", "body"), "t").select("key", "t", "body")


def alike(w: np.ndarray, agree: float) -> list[tuple[int, int]]:
    """Links between rows of token hashes whose components are those of all pairs that agree in a share of their places."""
    out, left, most = [], np.arange(len(w)), w.shape[1] - math.ceil(agree * w.shape[1] - 1e-9)
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            at = reached.pop()
            near = (w[left] != w[at]).sum(axis=1) <= most
            out += [(int(at), int(k)) for k in left[near]]
            reached += left[near].tolist()
            left = left[~near]
    return out


def _linked(agree: float):
    """Of rows sorted by key, links between the templates of each."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def work(ts, bodies):
        if len(ts) < 2:
            return []
        w = np.frombuffer(b"".join(bodies), np.uint64).reshape(len(ts), -1)
        return [(ts[a], ts[b]) for a, b in alike(w, agree)]

    def run(batches):
        key, ts, bodies = None, [], []
        for batch in batches:
            out = []
            for k, t, body in zip(*common.columns(batch, "key", "t", "body"), strict=True):
                if k != key:
                    out += work(ts, bodies)
                    key, ts, bodies = k, [], []
                ts.append(t)
                bodies.append(body)
            yield common.record_batch(schema, out)
        yield common.record_batch(schema, work(ts, bodies))

    return run


def _kept(text: str, gone: list[int] | None) -> tuple[str, int]:
    """The text of the lines that stay, and how many lines it had."""
    lines = text.split("\n")
    if not gone:
        return text, len(lines)
    dropped = set(gone)
    return "\n".join([x for k, x in enumerate(lines) if k not in dropped]), len(lines)


def _drop(batches):
    schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept", pa.string())])
    for batch in batches:
        out = []
        for rid, doc_id, text, gone in zip(*common.columns(batch, "rid", "doc_id", "text", "gone"), strict=True):
            kept, n = _kept(text, gone)
            out.append((rid, doc_id, n, len(gone or ()), kept))
        yield common.record_batch(schema, out)


def dedup_lines(docs: DataFrame, depth: int = DEPTH, least: int = LEAST, min_docs: int = 3, agree: float | None = None) -> DataFrame:
    """rid, doc_id, n_lines, n_dropped, kept (the text of the lines that stay)."""
    keys = common.keyed(docs)
    marks = dropped_lines(keys, depth, least, min_docs, agree)
    return _with_marks(keys.select("rid", "doc_id", "text"), "rid", marks).mapInArrow(_drop, "rid long, doc_id long, n_lines long, n_dropped long, kept string")


def _with_marks(rows: DataFrame, key: str, marks: DataFrame) -> DataFrame:
    """rows with the second column of marks, null where there is none; only rows that may have marks are shuffled."""
    name, ids = marks.columns[1], marks.select(key)
    plain = common.apart(rows, key, ids).withColumn(name, F.lit(None).cast("array<long>"))
    return plain.unionByName(common.among(rows, key, ids).join(marks.hint("merge"), key, "left").select(*rows.columns, name))


def dropped_lines(keys: DataFrame, depth: int, least: int, min_docs: int, agree: float | None) -> DataFrame:
    """rid, gone (numbers of the lines that go), of rows with rid and text."""
    common.small_batches(keys.sparkSession)
    lines = common.materialize(keys.select("rid", "text").mapInArrow(_lines(depth), "leaf long, t long, rid long, line long, fresh int"), "lines")
    first = F.min(F.struct("rid", "line"))
    # Counted by template first, so that a common line is one row of its leaf.
    templates = common.materialize(lines.groupBy("leaf", "t").agg(F.sum("fresh").cast("long").alias("docs"), first.alias("first")), "templates")
    leaves = templates.groupBy("leaf").agg(F.sum("docs").alias("docs"), F.count("*").alias("n")).where((F.col("docs") >= min_docs) & (F.col("n") > 1)).select("leaf")
    several = templates.join(leaves, "leaf").select("first.rid", F.struct("leaf", "t", "docs", "first.line").alias("x"))
    asked = common.materialize(several.groupBy("rid").agg(F.collect_list("x").alias("asked")), "asked")
    asked = common.among(keys.select("rid", "text"), "rid", asked.select("rid")).join(asked.hint("merge"), "rid")
    if agree is None:
        wider = common.materialize(asked.mapInArrow(_wider(depth, least), "leaf long, t long, docs long, wide long, rid long, line long"), "wider")
        several = wider.groupBy("leaf", "wide").agg(F.sum("docs").alias("docs"), F.count("*").alias("n"), first.alias("first")).where((F.col("docs") >= min_docs) & (F.col("n") > 1)).select("leaf", "wide", "first")
        members = wider.select("leaf", "wide", "t").join(several, ["leaf", "wide"])
    else:
        bodies = common.materialize(asked.mapInArrow(_segments(depth, least, agree), "t long, body binary, keys array<long>"), "bodies")
        found = common.components(_meetings(bodies).repartition("key").sortWithinPartitions("key").mapInArrow(_linked(agree), "a long, b long"))
        found = found.union(found.select("component", "component").distinct())
        of = common.materialize(templates.join(found, templates["t"] == found["node"]).select("leaf", F.col("component").alias("wide"), "t", "first"), "of")
        members = of.drop("first").join(of.groupBy("leaf", "wide").agg(F.min("first").alias("first")), ["leaf", "wide"])
    members = common.materialize(members, "members")
    # One document may hold lines of several members: documents are counted from the lines, each once.
    held = members.select("leaf", "wide", "t").join(lines.where("fresh = 1").select("leaf", "t", "rid"), ["leaf", "t"]).select("leaf", "wide", "rid").distinct()
    recurring = held.groupBy("leaf", "wide").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs).select("leaf", "wide")
    firsts = members.join(recurring, ["leaf", "wide"]).select("leaf", "t", "first").union(templates.where(F.col("docs") >= min_docs).select("leaf", "t", "first"))
    firsts = common.materialize(firsts.groupBy("leaf", "t").agg(F.min("first").alias("low"), F.max("first").alias("high")), "firsts")  # written, so that AQE can split a common line's rows in the next join
    # A line stays only as the first of all recurring templates it belongs to.
    gone = lines.join(firsts, ["leaf", "t"]).where("NOT (low = high AND low.rid = rid AND low.line = line)").groupBy("rid").agg(F.collect_set("line").alias("gone"))
    return common.materialize(gone, "gone")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = dedup_lines(common.table(spark, sf_dir, "documents"), LEADING, min_docs=MIN_DOCS, agree=AGREE)
    return got.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def drop_lines(docs: DataFrame, depth: int = DEPTH, least: int = LEAST, min_docs: int = 3, agree: float | None = None) -> DataFrame:
    """docs with its columns, the text and the number of characters as they are after dropping.

    Null text becomes empty; rows with null or repeated ids are documents of their own; an empty table stays empty.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    odd = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").limit(1).count()
    own, away = common.spare(docs, "_rid", "_gone")
    if odd:
        rows = common.materialize(docs.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(own, F.monotonically_increasing_id()), "numbered")
    else:
        rows = docs.withColumn(own, F.col("doc_id"))
    keys = rows.select(F.col(own).alias("rid"), F.coalesce("text", F.lit("")).alias("text"))
    marks = dropped_lines(keys, depth, least, min_docs, agree).select(F.col("rid").alias(own), F.col("gone").alias(away))
    at, sized = docs.columns.index("text"), docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def rewrite(batches):
        common.give_back()
        for batch in batches:
            cols = list(batch.columns[:-1])
            kept = [_kept(text or "", gone)[0] for text, gone in zip(cols[at].to_pylist(), batch.column(len(cols)).to_pylist(), strict=True)]
            cols[at] = pa.array(kept, cols[at].type)
            if sized is not None:
                cols[sized] = pa.array(list(map(len, kept)), pa.int64()).cast(cols[sized].type)
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names[:-1])

    return _with_marks(rows.select(*docs.columns, own), own, marks).drop(own).mapInArrow(rewrite, docs.schema)
