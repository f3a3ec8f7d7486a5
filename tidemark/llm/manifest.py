"""Operator 13, a Merkle manifest of the dataset: leaves by row, trees by language, one root over the languages' subroots.

Method. The leaves of a language, in order of doc_id, are cut into blocks of FAN ** LEVELS; a block is one array. `sequence`, `slice`, `transform`
and `aggregate` collapse its levels (runs of FAN nodes, the last one shorter) down to the block's root. The block roots of a language are the
nodes of the next round, and so on until one is left: the subroot. The subroots, ordered by language, go through the same rounds. Coming back
down, each block takes the siblings on its way to the root from the block above, and `aggregate` folds a leaf with its siblings into a root.

Scale. Texts are hashed where they are read and go no further; digests are range-partitioned by (lang, doc_id), numbered by the place in their
range, and dealt in blocks of at most 512, so a language that holds most rows meets in no task. What comes together of a range is one row for each
of its languages. Siblings of the upper levels travel once a block, not once a row. Rounds: one for each three levels.

Defined cases. A null field counts as `-`, also doc_id (which comes first within its language and is never tampered with); a null language is a
language of its own, before all others, the empty one too. Empty and very long texts are hashed whole. Rows of equal doc_id and language follow one another in order
of their leaves; repeated rows are leaves of their own. A single row has no siblings: its proof is the hash of nothing. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import common

FAN = 8
LEVELS = 3
BLOCK = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BROADCAST_ROWS = 100_000
_PATH = "array<struct<before: string, after: string>>"


def _field(x: Column) -> Column:
    text = x.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, tree (the language, as a string that is never null and sorts like it), leaf, and other: the leaf after tampering, null if it was left alone."""
    of = lambda text: F.sha2(F.concat(*[_field(F.col(c)) for c in FIELDS[:-1]], _field(text)), 256)
    struck = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    tree = F.when(F.col("lang").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), "lang"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), tree.alias("tree"), of(F.col("text")).alias("leaf"), F.when(struck, of(F.translate("text", CAPITALS, CAPITALS.lower()))).alias("other"))


def placed(rows: DataFrame, order: list[str], tag: str) -> DataFrame:
    """Adds to rows with a `tree`, written in order of (tree, *order): `at`, the place within the tree, and `n`, the nodes of the tree.

    A row's place in its range is the low part of the id that Spark gives it; ranges add up by one row for each tree in them.
    """
    names = ["tree", *order]
    kept = common.materialize(rows.repartitionByRange(*names).sortWithinPartitions(*names).withColumn("_id", F.monotonically_increasing_id()), tag)
    kept = kept.withColumns({"_part": F.shiftright("_id", 33), "_k": F.col("_id").bitwiseAND((1 << 33) - 1)}).drop("_id")
    runs = kept.groupBy("tree", "_part").agg(F.count("*").alias("_rows"), F.min("_k").alias("_first"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("tree", "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), F.sum("_rows").over(whole).alias("n"))
    runs = common.materialize(runs, f"{tag}-runs")
    runs = F.broadcast(runs) if runs.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else runs
    return kept.join(runs, ["tree", "_part"]).withColumn("at", F.col("_before") + F.col("_k") - F.col("_first")).drop("_part", "_k", "_first", "_before")


def blocks(nodes: DataFrame, tag: str, *more: str) -> DataFrame:
    """Blocks of a round: tree, block, n, members (of nodes: digest and `more`, in order) and levels, the last of which is the block's root alone."""
    member = F.struct((F.col("at") % BLOCK).cast("int").alias("k"), "digest", *more)
    steps = "CASE WHEN n <= 1 THEN 0" + "".join(f" WHEN n <= {FAN**k} THEN {k}" for k in range(1, LEVELS)) + f" ELSE {LEVELS} END"
    last = "element_at(done, -1)"
    up = f"transform(sequence(0, cast((size({last}) - 1) div {FAN} AS int)), j -> sha2(array_join(slice({last}, j * {FAN} + 1, {FAN}), ''), 256))"
    made = nodes.groupBy("tree", F.floor(F.col("at") / BLOCK).alias("block"), "n").agg(F.array_sort(F.collect_list(member)).alias("members"))
    made = made.withColumn("levels", F.expr(f"aggregate(slice(sequence(1, {LEVELS}), 1, {steps}), array(members.digest), (done, l) -> concat(done, array({up})))"))
    kept = ", ".join(f"m.{c} AS {c}" for c in more)
    return common.materialize(made.withColumn("members", F.expr(f"transform(members, m -> struct(m.k AS k{', ' + kept if kept else ''}))")), tag)


def rounds(nodes: DataFrame, tag: str, *more: str) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of all rounds, and the roots: tree, digest."""
    made = [blocks(nodes, tag, *more)]
    while True:
        tops = made[-1].select("tree", F.col("block").alias("at"), F.ceil(F.col("n") / BLOCK).cast("long").alias("n"), F.element_at(F.element_at("levels", -1), 1).alias("digest"))
        if not tops.where("n > 1").limit(1).count():
            return made, tops.select("tree", "digest")
        made.append(blocks(tops, tag))


def _own_path() -> str:
    """SQL: the siblings of member k at each level of its block, those before it and those after it."""
    place = f"cast(shiftright(m.k, l * {FAN.bit_length() - 1}) AS int)"
    return f"""transform(slice(sequence(0, {LEVELS - 1}), 1, size(levels) - 1), l -> struct(
        array_join(slice(levels[l], {place} - {place} % {FAN} + 1, {place} % {FAN}), '') AS before,
        array_join(slice(levels[l], {place} + 2, {FAN - 1} - {place} % {FAN}), '') AS after))"""


def paths(made: list[DataFrame], above: DataFrame, *more: str) -> DataFrame:
    """Nodes of the first round: tree, at, digest, `more` of the members, and path, from the node to the top; above: tree, path and other columns, which are kept."""
    kept = [c for c in above.columns if c not in ("tree", "path")]
    up = above.withColumn("block", F.lit(0).cast("long"))
    for k in range(len(made) - 1, -1, -1):
        also = [f"m.{c} AS {c}" for c in more] if k == 0 else []
        inner = F.expr(f"transform(members, m -> struct(m.k AS k, levels[0][m.k] AS digest, {', '.join([*also, f'{_own_path()} AS own'])}))")
        rows = made[k].join(up, ["tree", "block"]).select("tree", "block", *kept, F.col("path").alias("_up"), F.inline(inner))
        up = rows.select("tree", (F.col("block") * BLOCK + F.col("k")).alias("block"), *kept, "digest", *(more if k == 0 else ()), F.concat("own", "_up").alias("path"))
        if k:
            up = up.drop("digest")
    return up.withColumnRenamed("block", "at")


def folded(start: Column, path: str = "path") -> Column:
    """The root that a node and the siblings on its path give."""
    return F.aggregate(path, start, lambda done, s: F.sha2(F.concat(s["before"], done, s["after"]), 256))


def proof(path: str = "path") -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    nodes = placed(leaves(docs), ["doc_id", "leaf"], "leaves").withColumnRenamed("leaf", "digest")
    made, subroots = rounds(nodes, "blocks", "doc_id", "other")
    spark = docs.sparkSession
    none = F.from_json(F.lit("[]"), _PATH)
    langs = placed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("lang"), "digest"), ["lang"], "subroots")
    tops, roots = rounds(langs, "tops", "lang")
    above = paths(tops, roots.select("tree", F.col("digest").alias("root"), none.alias("path")), "lang")
    above = common.materialize(above.select(F.col("lang").alias("tree"), F.col("digest").alias("subroot"), "root", "path"), "above")
    rows = paths(made, above, "doc_id", "other")
    rows = rows.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof().alias("proof_sha256"), folded(F.coalesce("other", "digest")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(common.table(spark, sf_dir, "documents"))


_SQL_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"
_SQL_LEAF = "sha256(" + " || ".join([_SQL_FIELD.format(c) for c in FIELDS[:-1]]) + " || {0})"
_SQL_LOWER = f"translate(text, '{CAPITALS}', '{CAPITALS.lower()}')"
# The CRC-32 of the digits of doc_id, bit by bit.
_SQL_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(range(1, strlen(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i AS INTEGER), 1)) AS BIGINT))),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

OP13_SQL = f"""
WITH RECURSIVE base AS (SELECT row_number() OVER () AS r, doc_id, lang, {_SQL_LEAF.format(_SQL_FIELD.format("text"))} AS leaf, CASE WHEN {_SQL_CRC} % 3 = 0 THEN {_SQL_LEAF.format(_SQL_FIELD.format(_SQL_LOWER))} END AS other FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n FROM base),
nodes(lang, depth, place, digest, n) AS (
  SELECT lang, 0, place, leaf, n FROM l
  UNION ALL SELECT lang, depth + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place)), any_value((n + 7) // 8) FROM nodes WHERE n > 1 GROUP BY lang, depth, place // 8),
subs AS (SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(depth, place, digest, n) AS (
  SELECT 0, place, subroot, n FROM subs
  UNION ALL SELECT depth + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place)), any_value((n + 7) // 8) FROM tops WHERE n > 1 GROUP BY depth, place // 8),
ns AS (SELECT lang, depth, place, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS z
  FROM nodes WHERE n > 1 WINDOW w AS (PARTITION BY lang, depth, place // 8 ORDER BY place)),
ts AS (SELECT depth, place, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS z
  FROM tops WHERE n > 1 WINDOW w AS (PARTITION BY depth, place // 8 ORDER BY place)),
way AS (SELECT l.r, ns.depth AS step, a, z FROM l JOIN ns ON ns.lang IS NOT DISTINCT FROM l.lang AND ns.place = l.place // CAST(power(8, ns.depth) AS BIGINT)
  UNION ALL SELECT l.r, 1000 + ts.depth, a, z FROM l JOIN subs ON subs.lang IS NOT DISTINCT FROM l.lang JOIN ts ON ts.place = subs.place // CAST(power(8, ts.depth) AS BIGINT)),
steps AS (SELECT r, row_number() OVER (PARTITION BY r ORDER BY step) AS k, a, z FROM way),
fold(r, k, digest) AS (
  SELECT r, 0, coalesce(other, leaf) FROM base
  UNION ALL SELECT f.r, f.k + 1, sha256(s.a || f.digest || s.z) FROM fold f JOIN steps s ON s.r = f.r AND s.k = f.k + 1),
ends AS (SELECT r, max_by(digest, k) AS folded_root FROM fold GROUP BY r),
proofs AS (SELECT r, sha256(string_agg(a || z, '' ORDER BY k)) AS proof_sha256 FROM steps GROUP BY r)
SELECT l.doc_id, l.leaf, subs.subroot, t.digest AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = t.digest AS verified
FROM l JOIN subs ON subs.lang IS NOT DISTINCT FROM l.lang JOIN ends USING (r) LEFT JOIN proofs USING (r) CROSS JOIN (SELECT digest FROM tops WHERE n = 1) t
"""
