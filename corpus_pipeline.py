"""The corpus pipeline: documents to packed sequences, one operator a stage."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rungline.llm import common, mixing, packing, queries, simhash, suffixes, toxicity

#: The stages learn weights, hash bytes and run a vocabulary, which SQL can't express.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon learnt from ``labels`` scores under 0.5."""
    return toxicity.clean_only(docs, toxicity.learn(docs, common.table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked fingerprints."""
    return simhash.keep_first(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of over 50 words, or of 400 bytes and more, that occur twice."""
    return suffixes.without_repeats(docs, suffixes.PASSAGE, suffixes.PASSAGE_GRAM, suffixes.WORDS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.copied(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, queries.BYTE_VOCABULARY)


STAGES = [("toxicity", drop_toxic), ("simhash", drop_near_duplicates), ("suffix_array", cut_repeats), ("mixing", mix_sources),
          ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each one's result written and read again as the next one's documents."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
