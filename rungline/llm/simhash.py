"""SimHash near-duplicates by ball hashing that meets in the middle.

Two 64-bit fingerprints within 3 bits differ by at most 1 bit (half the radius) in one of their 32-bit halves. Each distinct fingerprint
emits all variants within that distance of each half; variants meet the halves as they are in a shuffle join,
whose condition verifies the whole fingerprints. Balls of the whole width would need 2,081 variants each instead of 66.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rungline.llm import common, graph

SEED = 42


def fingerprint_of(text: str | None, words: int = 3) -> int:
    """The fingerprint as a signed 64-bit number; 0 for a text without words."""
    found = (text or "").encode().lower().split()  # of bytes: A-Z only, ASCII white space only
    if not found:
        return 0
    if len(found) < words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*[found[i:] for i in range(words)]))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # a very long text needs no more memory than 64 bytes a shingle of a part
        part = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view(">i8")[0])


@F.pandas_udf(T.LongType())
def fingerprint(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint_of(t) for t in texts], dtype="int64")


def hexadecimal(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def _half(fp: str, side: int) -> Column:
    return F.shiftrightunsigned(fp, 32) if side else F.col(fp).bitwiseAND(F.lit(0xFFFFFFFF))


def links(distinct: DataFrame, radius: int = 3) -> DataFrame:
    """``(a, b)``: fingerprints at most ``radius`` (3 at most) bits apart; ``distinct (fp)`` holds each once."""
    if not 0 < radius <= 3:
        raise ValueError("halves within one bit find at most 3 differing bits")
    near, home = [], []
    for side in (0, 1):
        half = _half("fp", side)
        variants = F.array(half, *[half.bitwiseXOR(F.lit(1 << i)) for i in range(32)])
        near.append(distinct.select(F.col("fp").alias("a"), F.lit(side).alias("side"), F.explode(variants).alias("key")))
        home.append(distinct.select(F.col("fp").alias("b"), F.lit(side).alias("side"), half.alias("key")))
    # Spark sizes the 33 variants like the one fingerprint they come from and would broadcast them
    met = near[0].unionByName(near[1]).join(home[0].unionByName(home[1]).hint("merge"), ["side", "key"]).where(
        (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
    return met.select("a", "b")


def classes(prints: DataFrame, radius: int = 3) -> DataFrame:
    """``(fp, root, component_id)`` for each distinct fingerprint of ``prints (doc_id, fp)``.

    ``root`` is the smallest fingerprint of the component and names it; ``component_id`` is the smallest doc_id reachable over links; null ids count only where there is no other.
    """
    distinct = common.written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    roots = graph.components(links(distinct.select("fp"), radius))
    joined = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    return joined.join(smallest, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, radius: int = 3) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs (doc_id, text)``.

    Null and blank texts have fingerprint 0 and link like any other; repeated rows each come back. An empty table gives no rows.
    """
    common.text_batches(docs.sparkSession)
    prints = common.written(docs.select("doc_id", fingerprint("text").alias("fp")), "prints")
    return prints.join(classes(prints, radius).hint("merge"), "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, radius: int = 3) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of their component, one row each, all columns as they are.

    Where only null ids exist in a component one of its rows stays.
    """
    common.text_batches(docs.sparkSession)
    rows = docs.select("doc_id", fingerprint("text").alias("fp"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    rows = common.written(rows, "marked")
    ids = rows.select("doc_id", "fp")
    first = common.written(classes(ids, radius), "classes")
    its_own = F.col("doc_id").eqNullSafe(F.col("component_id"))
    kept = rows.join(first, "fp").where(its_own)
    if not ids.join(first.hint("merge"), "fp").where(its_own).groupBy("root").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["root"])
    return kept.select("row.*")
