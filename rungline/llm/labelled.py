"""Bounded samples of labelled rows, for fitting classifiers."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows a classifier is fitted on, at most; the documented bound of what is broadcast and collected for fitting.
SAMPLE = 40_000


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents that no classifier learns from; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def sample(labels: DataFrame, target: str, rows: int = SAMPLE) -> DataFrame:
    """``__id, __label``: at most ``rows`` labelled documents that are not held out, the first by a hash of the id.

    Repeated labels of a document count once (the largest); null ids and null labels don't count.
    """
    good = labels.where(~held_out(F.col("doc_id")) & F.col(target).isNotNull())
    once = good.groupBy(F.col("doc_id").alias("__id")).agg(F.max(target).cast("int").alias("__label"))
    return once.orderBy(F.xxhash64("__id"), "__id").limit(rows)


def joined(rows: DataFrame, labels: DataFrame, target: str, n: int = SAMPLE) -> DataFrame:
    """``rows`` (with doc_id) that are in the sample, with ``__label``; the sample's size is bounded by ``n``."""
    return rows.join(F.broadcast(sample(labels, target, n)), F.col("doc_id") == F.col("__id")).drop("__id")
