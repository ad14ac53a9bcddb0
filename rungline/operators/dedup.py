"""Identical documents: which copy is the original, and how much is double."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as X
from .ranking import join_lookup


def source_rank(source: Column, priority: Sequence[str]) -> Column:
    position = F.coalesce(F.array_position(F.array(*[F.lit(p) for p in priority]), source), F.lit(0))
    return F.when(position == 0, len(priority)).otherwise(position - 1)


def mark_duplicates(inventory: DataFrame, priority: Sequence[str] = tuple(X.COPY_PRIORITY),
                    hash_column: str = "sha256", source: str = "source", path: str = "path") -> DataFrame:
    """Adds ``original`` and ``is_duplicate``: among equal hashes the best source, then path.

    The original of each hash is a partial aggregate, one row per hash, that goes back to the copies.
    """
    best = inventory.groupBy(hash_column).agg(
        F.min(F.struct(source_rank(F.col(source), priority), F.col(path))).alias("_best"))
    originals = best.select(hash_column, F.col(f"_best.{path}").alias("original"))
    return join_lookup(inventory, originals, [hash_column]).withColumn(
        "is_duplicate", F.when(F.col(path) != F.col("original"), 1).otherwise(0))


def originals(docs: DataFrame, marked: DataFrame, path: str = "path") -> DataFrame:
    """Only the documents an inventory marks as originals."""
    return docs.join(marked.where("is_duplicate = 0").select(path), path, "left_semi")


def duplicate_stats(marked: DataFrame, source: str = "source", size: str = "size") -> DataFrame:
    copies = F.col("is_duplicate") == 1
    return marked.groupBy(source).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(~copies).alias("unique_files"),
        F.count_if(copies).alias("duplicates"), F.sum(size).alias("bytes"),
        F.coalesce(F.sum(F.when(copies, F.col(size))), F.lit(0)).alias("duplicate_bytes"))


def only_new(candidates: DataFrame, manifest: DataFrame, url: str = "url",
             hash_column: str = "sha256") -> DataFrame:
    """Candidates whose URL and whose content are not in the manifest yet."""
    known = lambda c: manifest.where(F.coalesce(F.col(c), F.lit("")) != "").select(c).distinct()
    return (candidates.join(known(url), url, "left_anti")
            .join(known(hash_column), hash_column, "left_anti"))
