"""Operator 12, media columns in a store of content-defined chunks.

Format. A document's payload is its text as UTF-8, filled up with spaces to a positive multiple of UNIT bytes; its media is a RIFF/WAVE file of
these bytes as unsigned 8-bit samples, one channel. Under one folder: `recipes` (a row for each document: the SHA-256 of its media, the header, and the ordered list of
its payload's chunks: digests and sizes), `masters` (each distinct media once, with the document that stands for it), `index` (each distinct chunk once, with
the document and place that keep it), `borrowed` (the other occurrences) and `packs` (of each distinct media its recipe and the bytes of the chunks that it keeps).

Method. A gear hash rolls over the payload and cuts where its top bits are zero, so an inserted passage changes only the chunks around it. Digests
meet in Spark joins: of equal media one is kept, of equal chunks one occurrence. To read back, the chunks that others keep are joined to the
recipes that borrow them, and each ordered list is put together again; every chunk's digest and every media's digest is checked, and samples,
checksums and the feature come from these bytes alone.

Scale. Texts are read twice and shuffled only where a document is a copy or borrows; slim digests go through the joins. A digest that a third of all
rows hold never meets in one task: the HOT most frequent ones are broadcast (a row, or a chunk of at most MOST bytes, each), the others are
joined by shuffles, in which they are rare. Memory is an Arrow batch and one document. Each table is written in the shared folder and read again.

Defined cases. Null text: empty, a payload of UNIT spaces. Null doc_ids and repeated rows are documents of their own; equal texts have equal values. A very
long text is one media of many chunks, hashed block by block. An empty table gives an empty store. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.rolling import mix

UNIT = 192
RATE = 8000
CUT_BITS, LEAST, MOST = 10, 256, 8192
DIGEST = 32
BLOCK = 1 << 20
REACH = 32  # a gear hash of 32 bits forgets what lies further back
HOT = 1000
GEAR = (mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)

_RECIPE = "rid long, doc_id long, n_bytes long, media binary, header binary, digests binary, sizes array<int>"
_PACK = "rid long, media binary, header binary, digests binary, sizes array<int>, skip array<int>, body binary"
_FACTS = "media binary, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


class Damaged(ValueError):
    pass


def payload(text: str) -> bytes:
    body = text.encode("utf-8", "surrogatepass")
    return body.ljust(max(UNIT, -(-len(body) // UNIT) * UNIT), b" ")


def header(size: int) -> bytes:
    """Head of a RIFF/WAVE file of so many 8-bit samples; sizes beyond its 32 bits are written modulo 2**32."""
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", (36 + size) & 0xFFFFFFFF, b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", size & 0xFFFFFFFF)


def candidates(body: bytes) -> Iterator[int]:
    """Ends of the runs whose gear hash has CUT_BITS zeros at its top, block by block; correct from byte REACH on."""
    symbols = np.frombuffer(body, np.uint8)
    for start in range(0, len(symbols), BLOCK):
        low = max(0, start - REACH)
        h = GEAR[symbols[low : start + BLOCK]]
        for step in (1, 2, 4, 8, 16):
            h[step:] += h[:-step] << np.uint32(step)
        yield from (np.flatnonzero(h[start - low :] < np.uint32(1 << (32 - CUT_BITS))) + start + 1).tolist()


def cuts(body: bytes) -> list[int]:
    """Ends of the chunks: at candidates, at least LEAST bytes each but the last, at most MOST."""
    out, start = [], 0
    for at in candidates(body):
        while at - start > MOST:
            start += MOST
            out.append(start)
        if at - start >= LEAST:
            out.append(at)
            start = at
    while len(body) - start > MOST:
        start += MOST
        out.append(start)
    if start < len(body):
        out.append(len(body))
    return out


def chunked(body: bytes) -> tuple[list[bytes], list[int]]:
    """The chunks of a payload, and their sizes."""
    ends = cuts(body)
    parts = [body[a:b] for a, b in zip([0, *ends], ends)]
    return parts, [len(p) for p in parts]


def digest(body: bytes) -> bytes:
    return hashlib.sha256(body).digest()


def feature(samples: np.ndarray) -> str:
    """Sum, energy about the middle, crossings of the middle, smallest and largest sample, all exact."""
    total = energy = crossings = 0
    low, high, last = 255, 0, None
    for k in range(0, len(samples), BLOCK):
        part = samples[k : k + BLOCK]
        x = part.astype(np.int64) - 128
        total, energy = total + int(part.sum(dtype=np.int64)), energy + int((x * x).sum())
        up = x >= 0
        crossings += int(np.count_nonzero(up[1:] != up[:-1])) + (last is not None and bool(up[0]) != last)
        low, high, last = min(low, int(part.min())), max(high, int(part.max())), bool(up[-1])
    return f"n={len(samples)};sum={total};energy={energy};crossings={crossings};low={low};high={high}"


def _recipes(batches):
    schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary()), ("header", pa.binary()), ("digests", pa.binary()), ("sizes", pa.list_(pa.int32()))])
    for batch in batches:
        out = []
        for rid, doc_id, text in zip(*common.columns(batch, "rid", "doc_id", "text"), strict=True):
            body = payload(text)
            parts, sizes = chunked(body)
            head = header(len(body))
            whole = hashlib.sha256(head)
            whole.update(body)
            out.append((rid, doc_id, len(text.encode("utf-8", "surrogatepass")), whole.digest(), head, b"".join(map(digest, parts)), sizes))
        yield common.record_batch(schema, out)


_PACKED = pa.schema([("rid", pa.int64()), ("media", pa.binary()), ("header", pa.binary()), ("digests", pa.binary()), ("sizes", pa.list_(pa.int32())), ("skip", pa.list_(pa.int32())), ("body", pa.binary())])


def _packs(batches):
    for batch in batches:
        out = []
        for rid, text, skip in zip(*common.columns(batch, "rid", "text", "skip"), strict=True):
            body, skip = payload(text), sorted(skip or ())
            parts, sizes = chunked(body)
            head, left = header(len(body)), set(skip)
            whole = hashlib.sha256(head)
            whole.update(body)
            out.append((rid, whole.digest(), head, b"".join(map(digest, parts)), sizes, skip, b"".join(p for k, p in enumerate(parts) if k not in left) if left else body))
        yield common.record_batch(_PACKED, out)


def _kept(names: bytes, sizes: list[int], skip: list[int], body: bytes) -> dict[int, bytes]:
    """The chunks in a pack by their places; raises where one is not what its digest says."""
    left, out, at = set(skip), {}, 0
    for k, size in enumerate(sizes):
        if k not in left:
            part = body[at : at + size]
            at += size
            if digest(part) != names[k * DIGEST : (k + 1) * DIGEST]:
                raise Damaged(f"chunk {names[k * DIGEST : (k + 1) * DIGEST].hex()} is damaged")
            out[k] = part
    if at != len(body):
        raise Damaged("a pack holds other bytes than its chunks")
    return out


def _lent(batches):
    schema = pa.schema([("digest", pa.binary()), ("body", pa.binary())])
    for batch in batches:
        out = []
        for names, sizes, skip, body, places in zip(*common.columns(batch, "digests", "sizes", "skip", "body", "places"), strict=True):
            kept = _kept(names, sizes, skip, body)
            out += [(names[k * DIGEST : (k + 1) * DIGEST], kept[k]) for k in places]
        yield common.record_batch(schema, out)


def _facts(batches):
    schema = pa.schema([("media", pa.binary()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])
    for batch in batches:
        out = []
        for media, head, names, sizes, skip, body, lent in zip(*common.columns(batch, "media", "header", "digests", "sizes", "skip", "body", "lent"), strict=True):
            found = _kept(names, sizes, skip, body)
            for x in lent or ():
                if digest(x["body"]) != names[x["k"] * DIGEST : (x["k"] + 1) * DIGEST]:
                    raise Damaged(f"borrowed chunk {x['k']} of media {media.hex()} is damaged")
                found[x["k"]] = x["body"]
            if len(found) != len(sizes):
                raise Damaged(f"media {media.hex()} lacks chunks")
            samples = b"".join(found[k] for k in range(len(sizes)))
            whole = hashlib.sha256(head)
            whole.update(samples)
            if whole.digest() != media or head != header(len(samples)):
                raise Damaged(f"media {media.hex()} can't be rebuilt")
            out.append((media, len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-16:]), len(head) + len(samples), whole.hexdigest(), feature(np.frombuffer(samples, np.uint8))))
        yield common.record_batch(schema, out)


def meet(rows: DataFrame, key: str, by: DataFrame, uses: str) -> DataFrame:
    """rows joined with a written table that has each key once and how often it is used.

    The HOT most used keys are broadcast; the rest, each of which holds at most a HOT-th of the rows, meet by a shuffle.
    """
    hot = common.materialize(by.orderBy(F.col(uses).desc(), key).limit(HOT).drop(uses), "hot")  # at most HOT rows
    is_hot = F.broadcast(hot.select(key))
    rare = rows.join(is_hot, key, "left_anti").join(by.join(is_hot, key, "left_anti").drop(uses).hint("merge"), key)
    return rows.join(F.broadcast(hot), key).unionByName(rare)


class MediaStore:
    """A written store under `folder`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _put(self, name: str, rows: DataFrame, mode: str = "error") -> DataFrame:
        rows.write.mode(mode).option("compression", "zstd").parquet(f"{self.folder}/{name}")
        return self.table(name, rows.schema)

    def table(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    @classmethod
    def write(cls, docs: DataFrame, folder: str) -> MediaStore:
        store = cls(docs.sparkSession, folder)
        texts = common.keyed(docs)
        with common.bounded_batches(store.spark):
            recipes = store._put("recipes", texts.mapInArrow(_recipes, _RECIPE))
            masters = store._put("masters", recipes.groupBy("media").agg(F.min("rid").alias("rid"), F.count("*").alias("uses")))
            place = F.posexplode(F.sequence(F.lit(0), F.size("sizes") - 1)).alias("k", "_")
            held = recipes.join(masters.select("rid").hint("merge"), "rid").select("rid", "digests", place).select("rid", "k", F.expr(f"substring(digests, k * {DIGEST} + 1, {DIGEST})").alias("digest"))
            held = common.materialize(held, "held")
            index = held.groupBy("digest").agg(F.min(F.struct("rid", "k")).alias("at"), F.count("*").alias("uses")).select("digest", F.col("at.rid").alias("owner"), F.col("at.k").alias("owner_k"), "uses")
            index = store._put("index", index)
            twice = common.materialize(index.where("uses > 1"), "twice")
            borrowed = meet(held, "digest", twice, "uses").where("rid <> owner OR k <> owner_k").select("rid", "k", "digest", "owner", "owner_k")
            borrowed = store._put("borrowed", borrowed)
            skip = borrowed.groupBy("rid").agg(F.sort_array(F.collect_list("k")).alias("skip"))
            marks = masters.select("rid").join(skip, "rid", "left")
            touched = recipes.select("rid").join(masters.select("rid").hint("merge"), "rid", "left_anti").union(borrowed.select("rid")).distinct()
            touched = common.materialize(touched, "touched")
            clear = common.apart(texts, "rid", touched).withColumn("skip", F.lit(None).cast("array<int>"))
            others = common.among(texts, "rid", touched).join(marks.hint("merge"), "rid")
            for rows in (clear, others):
                store._put("packs", rows.select("rid", "text", "skip").mapInArrow(_packs, _PACK), "append")
        return store

    def facts(self) -> DataFrame:
        """A row for each distinct media, from its stored bytes; raises Damaged where a chunk or a media is not what its digest says."""
        packs = self.table("packs", _PACK)
        borrowed = self.table("borrowed", "rid long, k int, digest binary, owner long, owner_k int")
        with common.bounded_batches(self.spark):
            places = borrowed.groupBy("owner").agg(F.collect_set("owner_k").alias("places")).withColumnRenamed("owner", "rid")
            lenders = common.among(packs, "rid", common.materialize(places.select("rid"), "lenders"))
            lent = lenders.join(places.hint("merge"), "rid").select("digests", "sizes", "skip", "body", "places").mapInArrow(_lent, "digest binary, body binary")
            uses = borrowed.groupBy("digest").agg(F.count("*").alias("uses"))
            lent = common.materialize(lent.join(uses, "digest"), "lent")
            parts = meet(borrowed.select("rid", "k", "digest"), "digest", lent, "uses").groupBy("rid").agg(F.collect_list(F.struct("k", "body")).alias("lent"))
            own = packs.where("size(skip) = 0").withColumn("lent", F.lit(None).cast("array<struct<k: int, body: binary>>"))
            mixed = packs.where("size(skip) > 0").join(parts.hint("merge"), "rid", "left")
            names = ["media", "header", "digests", "sizes", "skip", "body", "lent"]
            made = common.materialize(own.select(*names).mapInArrow(_facts, _FACTS).unionByName(mixed.select(*names).mapInArrow(_facts, _FACTS)), "facts")
        return made

    def documents(self) -> DataFrame:
        """doc_id, n_bytes, and the facts of its media read back, for each document."""
        uses = self.table("masters", "media binary, rid long, uses long").select("media", "uses")
        facts = common.materialize(self.facts().join(uses, "media"), "used")
        rows = meet(self.table("recipes", _RECIPE).select("doc_id", "n_bytes", "media"), "media", facts, "uses")
        return rows.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")

    def size(self) -> dict[str, int]:
        """Chunks and bytes as documents hold them, and as they are stored."""
        total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + x)
        held = self.table("recipes", _RECIPE).agg(F.sum(F.size("sizes")).alias("chunks"), F.sum(total("sizes")).alias("bytes")).first()
        kept = self.table("packs", _PACK).agg(F.sum(F.size("sizes") - F.size("skip")).alias("chunks"), F.sum(F.octet_length("body")).alias("bytes")).first()
        return {"held_chunks": held["chunks"] or 0, "held_bytes": held["bytes"] or 0, "stored_chunks": kept["chunks"] or 0, "stored_bytes": kept["bytes"] or 0}


def op12_media_columns(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    return MediaStore.write(common.table(spark, sf_dir, "documents"), folder or common.fresh_path(spark, "media-store")).documents()
