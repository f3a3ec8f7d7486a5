"""A cleaning pipeline over `documents`: toxicity, line dedup, near-duplicates, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on what its predecessor kept; all but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import common, decontamination, line_dedup, near_copies, packing, simhash, toxicity
from tidemark.llm.encoding import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores under 0.5 stay. It is fitted on the labelled ones among `docs`.

    Null text counts as empty; rows with null or repeated ids are scored each on its own; without labels of both kinds all stay. An empty table stays empty,
    very long texts are scored whole, and other columns pass through whatever their names.
    """
    return toxicity.keep_clean(docs, toxicity.train(docs, common.table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go, but for the first of each; texts and their lengths change.

    Null text becomes empty; the first is the one with the smallest id (nulls first, ties by a hash of the text), then the earliest line; rows with null or repeated ids are documents of
    their own. An empty table stays empty, very long texts are read whole, and other columns pass through whatever their names.
    """
    return line_dedup.drop_lines(docs, line_dedup.LEADING, min_docs=line_dedup.MIN_DOCS, agree=line_dedup.AGREE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of texts with a 5-word Jaccard similarity of 0.8 or more the document with the smallest id stays.

    SimHash fingerprints within 2 bits (operator 8's pigeonring) give the candidates, whose shingles are compared; pairs that 2 bits miss are added by an exact join.
    Null text counts as empty, and all texts without words are alike; of equal or null ids any one stays, null ids giving way to others. Repeated rows are copies of one
    another. An empty table stays empty, very long texts are compared whole, and other columns pass through whatever their names.
    """
    return simhash.keep_first(docs, near_copies.WORDS, near_copies.SIMILARITY)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts hold none, null and empty items are in no document; rows with null or repeated ids are judged each on its own. An empty table or an empty
    benchmark leaves all as it is, very long texts are searched whole, and other columns pass through whatever their names.
    """
    return decontamination.keep_uncontaminated(docs, common.table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its place in a sequence of at most 4096 tokens.

    Null text counts as empty and is one end token; rows with null or repeated ids are documents of their own; equal lengths are dealt by id. Longer documents are cut into full pieces
    and a rest. An empty table gives no rows; other columns are not read.
    """
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

# Classifier, fingerprints and tokenizer have no SQL form; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet in the shared folder and read back."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
