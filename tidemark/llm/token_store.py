"""Operator 4, token ids in a content-addressed store.

Format. Under one folder: `objects` (Parquet; a row is a chunk, digest and payload of little-endian unsigned ids, 2 bytes each if the
vocabulary allows, else 4, each digest once, or the recipe of a document as it was made), `recipes` (Parquet in ascending document order: rid,
doc_id, within (ids before it in its range), n_tokens, the digests in order, the document's Merkle root, part) and `manifest` (the ranges:
their documents, ids, start and the Merkle root of their documents' roots). Rolling hashes over eight ids cut the stream of each document, so
an inserted passage changes the chunks around it only.

Scale. One encoding pass; payloads are shuffled once, on their digest, after each task has dropped what it sent before, recipes by document.
Starts are summed within sorted ranges; only one row for each range comes together. Reading back checks each chunk's digest and each
document's root (`verify`: each range's too) and derives a document's checksum from those of its chunks, so no payload moves; `documents` gathers
payloads when the ids themselves are wanted.

Defined cases. Null text: empty, just the end id. Null ids come first, repeated rows are documents of their own (ties by text), a very
long text is one document of many chunks, an empty table gives an empty store.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.encoding import encoder, tokenizer_path

DIGEST = 20
CUT_BITS, LEAST, MOST = 9, 64, 4096
SEEN = 500_000
END_ID = 2
_ROLL = [(step, np.uint32(pow(0x01000193, step, 1 << 32))) for step in (1, 2, 4)]
_SPREAD = np.uint32(0x9E3779B1)
_OBJECTS = "deal long, key binary, payload binary, rid long, doc_id long, n_tokens long, digests binary, root binary"
_RECIPES = "part int, rid long, doc_id long, within long, n_tokens long, digests binary, root binary"
_MANIFEST = "part int, n_docs long, n_tokens long, root binary, start long"


def digest(body: bytes) -> bytes:
    return hashlib.blake2b(body, digest_size=DIGEST).digest()


def merkle(leaves: list[bytes]) -> bytes:
    """Root of a binary hash tree; a last odd node moves up, inner nodes are marked."""
    level = leaves or [digest(b"")]
    while len(level) > 1:
        level = [digest(b"\x01" + level[k] + level[k + 1]) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
    return level[0]


def cuts(ids: np.ndarray, bits: int = CUT_BITS, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks: after eight ids whose rolling hash starts with `bits` zeros, no chunk but the last shorter than `least`, none longer than `most`."""
    n = len(ids)
    found: list[int] = []
    if n > 8:
        h = ids.astype(np.uint32)
        for step, factor in _ROLL:
            h, left = h[step:], h[:-step] * factor
            h = np.add(left, h, out=left)
        h *= _SPREAD
        found = (np.flatnonzero(h < np.uint32(1 << (32 - bits))) + 8).tolist()
    out, start = [], 0
    for at in [*found, n]:
        while at - start > most:
            start += most
            out.append(start)
        if at == n or at - start >= least:
            if at > start or not n:
                out.append(at)
            start = at
    return out


def shift_crc(crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The CRC-32 registers after `size` more zero bytes each, by squared shift matrices."""
    crc, size = crc.astype(np.uint32).copy(), size.astype(np.int64).copy()
    column = np.array([0xEDB88320] + [1 << k for k in range(31)], np.uint32)  # one zero bit

    def times(columns: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.uint32)
        for k in range(32):
            out ^= np.where(x >> np.uint32(k) & np.uint32(1), columns[k], np.uint32(0))
        return out

    for _ in range(3):
        column = times(column, column)
    while size.any():
        odd = (size & 1) == 1
        if odd.any():
            crc[odd] = times(column, crc[odd])
        column, size = times(column, column), size >> 1
    return crc


def _objects(path: str, end_id: int):
    """Chunks that the task has not sent before, and a recipe for each document."""
    schema = pa.schema([("deal", pa.int64()), ("key", pa.binary()), ("payload", pa.binary()), ("rid", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("digests", pa.binary()), ("root", pa.binary())])

    def run(batches):
        e, seen = encoder(path), set()
        wire = "<u2" if e.width == 2 else "<u4"
        end = np.array([end_id], e.code).tobytes()
        for batch in batches:
            out, size = [], 0
            rids, doc_ids, texts = common.columns(batch, "rid", "doc_id", "text")
            for rid, doc_id, made in zip(rids, doc_ids, e.encode_many(texts), strict=True):
                ids = np.frombuffer(made + end, e.code).astype(wire, copy=False)
                body, names, start = ids.tobytes(), [], 0
                for at in cuts(ids):
                    part = body[start * e.width : at * e.width]
                    start = at
                    names.append(name := digest(part))
                    if name not in seen:
                        if len(seen) < SEEN:
                            seen.add(name)
                        out.append((int.from_bytes(name[:8], "big", signed=True), name, part, None, None, None, None, None))
                        size += len(part)
                out.append((rid, None, None, rid, doc_id, len(ids), b"".join(names), merkle(names)))
                if size > 1 << 23:
                    yield common.record_batch(schema, out)
                    out, size = [], 0
            yield common.record_batch(schema, out)

    return run


def _once(batches):
    seen = set()
    for batch in batches:
        keep = []
        for key in batch.column("key").to_pylist():
            keep.append(key is None or key not in seen)
            if key is not None:
                seen.add(key)
        yield batch.filter(pa.array(keep, pa.bool_()))


def _summed(batches):
    """Recipes sorted within their range: the ids before each, and at the end one row without rid for the range."""
    schema = pa.schema([("part", pa.int32()), ("rid", pa.int64()), ("doc_id", pa.int64()), ("within", pa.int64()), ("n_tokens", pa.int64()), ("digests", pa.binary()), ("root", pa.binary())])
    part, roots, total = None, [], 0
    for batch in batches:
        if len(batch):
            part = batch.column("part")[0].as_py()
            n = batch.column("n_tokens").to_numpy()
            roots += batch.column("root").to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(total + np.cumsum(n) - n) if f.name == "within" else batch.column(f.name) for f in schema], schema=schema)
            total += int(n.sum())
    if roots:
        yield common.record_batch(schema, [(part, None, None, len(roots), total, None, merkle(roots))])


class TokenStore:
    """A written store under `folder`; width is the bytes of an id in the payloads."""

    def __init__(self, spark: SparkSession, folder: str, width: int):
        self.spark, self.folder, self.width = spark, folder, width

    @classmethod
    def write(cls, docs: DataFrame, folder: str, path: str, end_id: int = END_ID) -> TokenStore:
        spark = docs.sparkSession
        made = common.keyed(docs).mapInArrow(_objects(path, end_id), _OBJECTS)
        made.repartition("deal").mapInArrow(_once, _OBJECTS).write.option("compression", "zstd").parquet(f"{folder}/objects")
        store = cls(spark, folder, encoder(path).width)
        made = spark.read.schema(_OBJECTS).parquet(f"{folder}/objects").where("rid IS NOT NULL").select("rid", "doc_id", "n_tokens", "digests", "root")
        ranges = made.repartitionByRange("rid").sortWithinPartitions("rid").withColumn("part", F.spark_partition_id())
        ranges.mapInArrow(_summed, _RECIPES).write.option("compression", "zstd").parquet(f"{folder}/recipes")
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        sums = store._recipes().where("rid IS NULL").select("part", F.col("within").alias("n_docs"), "n_tokens", "root")  # one row for each range
        sums.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).write.parquet(f"{folder}/manifest")
        return store

    def chunks(self) -> DataFrame:
        return self.spark.read.schema(_OBJECTS).parquet(f"{self.folder}/objects").where("key IS NOT NULL").select("key", "payload")

    def _recipes(self) -> DataFrame:
        return self.spark.read.schema(_RECIPES).parquet(f"{self.folder}/recipes")

    def recipes(self) -> DataFrame:
        """rid, doc_id, start, n_tokens, digests, root, part."""
        of = F.broadcast(self.manifest().select("part", F.col("start").alias("_start")))  # one row for each range
        return self._recipes().where("rid IS NOT NULL").join(of, "part").select("rid", "doc_id", (F.col("_start") + F.col("within")).alias("start"), "n_tokens", "digests", "root", "part")

    def manifest(self) -> DataFrame:
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.folder}/manifest")

    def verify(self) -> None:
        """Raises if a range's documents do not give its Merkle root and number of ids."""

        def run(batches):
            schema = pa.schema([("part", pa.int32()), ("n_tokens", pa.int64()), ("root", pa.binary())])
            part, roots, tokens = None, [], 0
            for batch in batches:
                for p, n, root in zip(*common.columns(batch, "part", "n_tokens", "root"), strict=True):
                    if p != part and roots:
                        yield common.record_batch(schema, [(part, tokens, merkle(roots))])
                        roots, tokens = [], 0
                    part, tokens = p, tokens + n
                    roots.append(root)
            if roots:
                yield common.record_batch(schema, [(part, tokens, merkle(roots))])

        got = self._recipes().where("rid IS NOT NULL").select("part", "rid", "n_tokens", "root").repartition("part").sortWithinPartitions("part", "rid").mapInArrow(run, "part int, n_tokens long, root binary")
        same = (F.col("g.root") == F.col("m.root")) & (F.col("g.n_tokens") == F.col("m.n_tokens"))
        bad = self.manifest().alias("m").join(got.alias("g"), F.col("m.part") == F.col("g.part"), "full").where(~F.coalesce(same, F.lit(False))).limit(1).count()
        if bad:
            raise ValueError("a range does not match its manifest")

    def _references(self) -> DataFrame:
        place = F.posexplode(F.sequence(F.lit(0), (F.octet_length("digests") / DIGEST).cast("int") - 1)).alias("k", "_")
        return self.recipes().select("rid", "digests", place).select("rid", "k", F.expr(f"substring(digests, k * {DIGEST} + 1, {DIGEST})").alias("key"))

    def checksums(self) -> DataFrame:
        """doc_id, start, n_tokens, ids_crc32 from the files; raises if a chunk, a document or its length is not what its hash says."""
        width = self.width

        def measure(batches):
            schema = pa.schema([("key", pa.binary()), ("n", pa.int64()), ("crc", pa.int64())])
            for batch in batches:
                out = []
                for key, body in zip(*common.columns(batch, "key", "payload"), strict=True):
                    if digest(body) != key:
                        raise ValueError(f"chunk {key.hex()} is damaged")
                    ids = np.frombuffer(body, f"<u{width}")
                    out.append((key, len(ids), zlib.crc32(ids.astype("<u4"))))
                yield common.record_batch(schema, out)

        def combine(batches):
            schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
            for batch in batches:
                rows = batch.to_pylist()
                crcs, rests, edges = [], [], []
                for r in rows:
                    parts = sorted((x["k"], x["n"], x["crc"]) for x in r["parts"] or ())
                    names = [r["digests"][k : k + DIGEST] for k in range(0, len(r["digests"]), DIGEST)]
                    if len(parts) != len(names) or merkle(names) != r["root"] or sum(p[1] for p in parts) != r["n_tokens"]:
                        raise ValueError(f"document {r['doc_id']} can't be rebuilt")
                    rest = r["n_tokens"]
                    edges.append(len(crcs))
                    for _, n, crc in parts:
                        rest -= n
                        crcs.append(crc)
                        rests.append(4 * rest)
                if rows:
                    whole = np.bitwise_xor.reduceat(shift_crc(np.array(crcs, np.uint32), np.array(rests)), edges)
                    yield common.record_batch(schema, [(r["doc_id"], r["start"], r["n_tokens"], int(c)) for r, c in zip(rows, whole, strict=True)])

        measured = self.chunks().mapInArrow(measure, "key binary, n long, crc long")
        parts = self._references().join(measured, "key", "left").where("n IS NOT NULL").groupBy("rid").agg(F.collect_list(F.struct("k", "n", "crc")).alias("parts"))
        return self.recipes().join(parts, "rid", "left").select("doc_id", "start", "n_tokens", "digests", "root", "parts").mapInArrow(combine, "doc_id long, start long, n_tokens long, ids_crc32 long")

    def documents(self) -> DataFrame:
        """doc_id, start, ids as an array, rebuilt from the chunks."""
        width = self.width

        def build(batches):
            schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.list_(pa.int64()))])
            for batch in batches:
                yield common.record_batch(schema, [(r["doc_id"], r["start"], np.frombuffer(b"".join(x["payload"] for x in sorted(r["parts"], key=lambda x: x["k"])), f"<u{width}").astype(np.int64)) for r in batch.to_pylist()])

        parts = self._references().join(self.chunks(), "key").groupBy("rid").agg(F.collect_list(F.struct("k", "payload")).alias("parts"))
        return self.recipes().join(parts, "rid").select("doc_id", "start", "parts").mapInArrow(build, "doc_id long, start long, ids array<long>")


def op4_token_store(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    store = TokenStore.write(common.table(spark, sf_dir, "documents"), folder or common.fresh_path(spark, "token-store"), tokenizer_path("byte_bpe_50k.json"))
    return store.checksums()
