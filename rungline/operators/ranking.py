"""Top-k, ordering and skew helpers shared by the operators.

A key may hold a third of all rows, so nothing here gathers a key's raw rows
in one task: tops are kept by partial aggregation (or by row_number with a
bound, which Spark also applies before the shuffle), and a look-up's answer
is one row per key, so that adaptive execution can split a hot key.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dealt(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows by their keys over all shuffle partitions, for a window over the same keys.

    The number is named, or adaptive execution would join partitions by their compressed bytes: short rows
    that pack well would be sorted by the millions in one task.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows per key. Spark keeps at most k per key and map task."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rank", F.row_number().over(window))
            .where(F.col("_rank") <= k).drop("_rank"))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_k(df, keys, order, 1)


def most_frequent(df: DataFrame, keys: Sequence[str], value: str, row: str,
                  alias: str | None = None, weight: Column | None = None) -> DataFrame:
    """Most frequent non-blank value per key; the first seen wins a tie."""
    counted = (
        df.where(F.col(value).isNotNull() & (F.col(value).cast("string") != ""))
        .groupBy(*keys, value)
        .agg(F.sum(weight if weight is not None else F.lit(1)).alias("_n"),
             F.min(row).alias("_first"))
    )
    best = F.max_by(value, F.struct("_n", -F.col("_first")))
    return counted.groupBy(*keys).agg(best.alias(alias or value))


def join_lookup(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of a large side to a table with one row per key.

    The rows of a hot key are split over several tasks by adaptive execution, each with that key's one row.
    """
    values = [c for c in table.columns if c not in keys]
    return df.join(table, list(keys), "left").select(*df.columns, *values)


def number_within(df: DataFrame, keys: Sequence[str], order: str, block: int,
                  alias: str) -> DataFrame:
    """1, 2, 3, … within each key by an integer column, also for a hot key.

    The order column is cut into blocks of ``block`` consecutive values. Rows
    are counted inside (key, block) — never more than ``block`` rows when the
    order column is unique — and shifted by the rows of earlier blocks, for
    which one small row per (key, block) is enough.
    """
    keys = list(keys)
    blocked = df.withColumn("_block", F.floor(F.col(order) / block))
    offsets = (
        blocked.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(
            F.sum("_n").over(Window.partitionBy(*keys).orderBy("_block")
                             .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(order)
    return (
        blocked.withColumn("_at", F.row_number().over(inside))
        .join(offsets, [*keys, "_block"])
        .withColumn(alias, F.col("_before") + F.col("_at"))
        .drop("_block", "_before", "_at")
    )


def grouped_median(df: DataFrame, keys: Sequence[str], value: str, alias: str,
                   steps_per_unit: int = 1000) -> DataFrame:
    """Exact median per key where a key may hold any number of distinct values.

    A histogram per key finds the one or two bins that hold the middle ranks;
    only the values in those bins are then ranked, after counting equal ones. Either side of
    that join grows with the keys, so none is broadcast, however small Spark takes its source to be.
    """
    keys = list(keys)
    bins = F.floor(F.col(value) * steps_per_unit)
    values = (df.where(F.col(value).isNotNull())
              .groupBy(*keys, bins.alias("_bin"), value).agg(F.count(F.lit(1)).alias("_n")))
    histogram = values.groupBy(*keys, "_bin").agg(F.sum("_n").alias("_in_bin"))
    per_key = Window.partitionBy(*keys)
    running = per_key.orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = (
        histogram.withColumn("_total", F.sum("_in_bin").over(per_key))
        .withColumn("_upto", F.sum("_in_bin").over(running))
        .withColumn("_low", F.floor((F.col("_total") + 1) / 2))
        .withColumn("_high", F.floor(F.col("_total") / 2) + 1)
        .withColumn("_before", F.col("_upto") - F.col("_in_bin"))
        .where((F.col("_before") < F.col("_high")) & (F.col("_upto") >= F.col("_low")))
        .select(*keys, "_bin", "_before", "_low", "_high")
    )
    in_bin = Window.partitionBy(*keys, "_bin").orderBy(value).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = (
        values.join(middle.hint("merge"), [*keys, "_bin"])
        .withColumn("_upto", F.col("_before") + F.sum("_n").over(in_bin))
        .withColumn("_from", F.col("_upto") - F.col("_n") + 1)
    )
    covers = lambda rank: F.col(rank).between(F.col("_from"), F.col("_upto"))
    return ranked.groupBy(*keys).agg(
        ((F.max(F.when(covers("_low"), F.col(value)))
          + F.max(F.when(covers("_high"), F.col(value)))) / 2).alias(alias))


def median_from_above(value: str) -> Column:
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{value}` DESC)")


def upper_median(df: DataFrame, value: str, alias: str) -> DataFrame:
    """Element n//2 of the sorted values, without interpolation.

    Read from the top, that element is the first to reach half of the rows.
    Each task counts equal values before the shuffle, so what is gathered is
    one entry per distinct value; meant for rounded columns such as percents.
    """
    return df.agg(median_from_above(value).alias(alias))
