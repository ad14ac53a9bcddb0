"""Three sources under one schema, with where each row came from."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions import text as T

SCHEMA = ["origin", "tracing", "union_name", "union_id", "employer", "market", "umbrella",
          "valid_from", "type", "pct", "amount", "basis", "year_status", "document", "url",
          "quotation", "counterparty", "counterparty_name", "own_site"]


def from_register(register: DataFrame) -> DataFrame:
    named = T.with_values(register, _who=T.counterparty_from_register(F.col("employer")))
    return (
        named.withColumn("origin", F.lit(X.ORIGIN_REGISTER)).withColumn("tracing", F.lit(X.TRACE_METADATA))
        .withColumn("counterparty", F.col("_who.id")).withColumn("counterparty_name", F.col("_who.name"))
        .withColumn("own_site", F.lit(0)).drop("_who")
    )


def from_web(web: DataFrame) -> DataFrame:
    """Web rows after ``resolve_union``; rows no union was found for are dropped."""
    owned = T.lookup(F.col("site"), X.UNION_SITES).isNotNull()
    return (
        web.where(F.col("union_name").isNotNull()).withColumn("origin", F.lit(X.ORIGIN_WEB))
        .withColumn("own_site", F.when(owned, 1).otherwise(0))
        .withColumn("employer", F.coalesce("party_2", F.lit("")))
    )


def from_manual(manual: DataFrame) -> DataFrame:
    """Manual rows: type from the values given, note as quotation, link as URL."""
    source = F.coalesce("source", F.lit(""))
    return (
        manual.withColumn("origin", F.lit(X.ORIGIN_MANUAL)).withColumn("tracing", F.lit(X.TRACE_MANUAL))
        .withColumn("type", T.manual_type(F.col("pct"), F.col("amount")))
        .withColumn("year_status", F.lit(X.YEAR_FROM_TEXT))
        .withColumn("document", source)
        .withColumn("url", F.when(source.rlike("^https?://"), source).otherwise(""))
        .withColumn("quotation", F.coalesce(T.blank_to_null(F.col("note")), F.lit(X.MANUAL_QUOTE)))
        .withColumn("counterparty", F.coalesce(F.trim("counterparty"), F.lit("")))
        .withColumn("counterparty_name", F.coalesce(T.counterparty_name(F.col("counterparty")), F.lit("")))
        .withColumn("own_site", F.lit(0))
    )


def override(df: DataFrame, corrections: DataFrame, union: str = "union_name",
             date: str = "valid_from", norm=T.normalize_union) -> DataFrame:
    """Machine-read rows give way where a correction exists for the same union and date."""
    corrected = corrections.select(norm(F.col(union)).alias("_norm"), F.col(date)).distinct()
    return (
        df.withColumn("_norm", norm(F.col(union)))
        .join(corrected, ["_norm", date], "left_anti").drop("_norm")
    )


def merge_sources(register: DataFrame, web: DataFrame, manual: DataFrame) -> DataFrame:
    def shaped(df):
        return df.select(*[c for c in SCHEMA if c in df.columns], "row_id", "source_order")

    machine = shaped(from_register(register).withColumn("source_order", F.lit(0))).unionByName(
        shaped(from_web(web).withColumn("source_order", F.lit(1))), allowMissingColumns=True)
    hand = shaped(from_manual(manual).withColumn("source_order", F.lit(2)))
    return override(machine, manual).unionByName(hand, allowMissingColumns=True)
