"""Data-quality checks: aggregates that ``quality_report`` computes, all those on one table in one pass."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions.text import month_key, not_blank
from .compare import as_of_date
from .consensus import DATE, LINE
from .ranking import median_from_above

ERROR, WARNING = "VILLA", "aðvörun"


@dataclass
class Check:
    """What counts as a violation in a table, as an aggregate column."""
    df: DataFrame
    name: str
    violations: Column
    severity: str = ERROR


def check_nonempty(df: DataFrame, check: str, severity: str = ERROR) -> Check:
    return Check(df, check, F.when(F.count(F.lit(1)) == 0, 1).otherwise(0), severity)


def check_range(df: DataFrame, check: str, column: str, low, high, open_low: bool = False) -> Check:
    value = F.col(column)
    inside = ((value > low) if open_low else (value >= low)) & (value <= high)
    return Check(df, check, F.count_if(value.isNotNull() & ~inside))


def check_median(df: DataFrame, check: str, column: str, low: float, high: float) -> Check:
    return Check(df, check, F.when(median_from_above(column).between(low, high), 0).otherwise(1))


def check_dates(df: DataFrame, check: str, date: str = DATE, low=None, high=None) -> Check:
    wrong = F.lit(False)
    if low is not None:
        wrong = wrong | (F.col(date) < low)
    if high is not None:
        wrong = wrong | (F.col(date) > high)
    return Check(df, check, F.count_if(wrong))


def check_unique(df: DataFrame, check: str, keys: Sequence[str] = (*LINE, DATE)) -> Check:
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return Check(counted, check, F.coalesce(F.sum(F.col("n") - 1), F.lit(0)))


def _main_lines(series: DataFrame, key: str, counterparty: str) -> DataFrame:
    return series.where(F.col("is_main") == 1).select(key, counterparty).distinct()


def check_single_main(series: DataFrame, check: str, key: str = "union_key",
                      counterparty: str = "counterparty") -> Check:
    per_union = _main_lines(series, key, counterparty).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return Check(per_union, check, F.count_if(F.col("n") > 1))


def check_has_main(series: DataFrame, check: str, key: str = "union_key") -> Check:
    per_union = series.groupBy(key).agg(F.max(F.col("is_main").cast("int")).alias("main"))
    return Check(per_union, check, F.count_if(F.col("main") == 0))


def check_main_reference(series: DataFrame, unions: DataFrame, check: str, key: str = "union_key",
                         counterparty: str = "counterparty", main: str = "main_line") -> Check:
    lines = _main_lines(series, key, counterparty)
    named = lines.join(unions.select(key, F.col(main).alias("_named")), key, "left")
    per_union = named.groupBy(key).agg(
        F.max((F.col(counterparty) == F.col("_named")).cast("int")).alias("agrees"))
    return Check(per_union, check, F.count_if(F.coalesce("agrees", F.lit(0)) == 0))


def over_ceiling(main_series: DataFrame, unions: DataFrame, benchmark: DataFrame, cap: Column,
                 factor: float = X.CEILING_FACTOR, key: str = "union_key", date: str = DATE,
                 grade: str = X.GRADE_CONTINUOUS) -> DataFrame:
    """Continuous unions compared with a measured index over the same months.

    ``benchmark``: (month, value), one row per calendar month.
    """
    spans = (
        unions.where(F.col("grade") == grade)
        .select(key, F.col("stretch_from").alias("span_from"),
                F.least("last_date", cap).alias("span_to"))
        .where(F.col("span_from") < F.col("span_to"))
    )
    months = benchmark.select(month_key(F.col("month")).alias("_m"), F.col("value").alias("_v"))
    start = months.select(F.col("_m").alias("_m1"), F.col("_v").alias("_v1"))
    end = months.select(F.col("_m").alias("_m2"), F.col("_v").alias("_v2"))
    # a union's spans end at the cap or at its last row, so the cap alone bounds the look-up
    own = as_of_date(main_series, [key], date, "stretch_index", cap, "own_index")
    return (
        spans.withColumn("_m1", month_key(F.col("span_from"))).withColumn("_m2", month_key(F.col("span_to")))
        .join(start, "_m1").join(end, "_m2").join(own, key)
        .where(F.col("own_index").isNotNull())
        .withColumn("benchmark_index", F.col("_v2") / F.col("_v1") * 100)
        .withColumn("over", F.col("own_index") > F.col("benchmark_index") * factor)
        .select(key, "span_from", "span_to", "own_index", "benchmark_index", "over")
    )


def check_ceiling(compared: DataFrame, check: str) -> Check:
    return Check(compared, check, F.count_if("over"))


def check_not_blank(df: DataFrame, check: str, column: str) -> Check:
    return Check(df, check, F.count_if(~not_blank(F.coalesce(F.col(column), F.lit("")))))


def quality_report(checks: Sequence[Check]) -> DataFrame:
    """One row per check: check, passed, severity, violations, message. Checks on the same table share one aggregation."""
    tables: dict[int, list[Check]] = {}
    for c in checks:
        tables.setdefault(id(c.df), []).append(c)

    def rows(own: list[Check]) -> DataFrame:
        counted = own[0].df.agg(*[c.violations.cast("bigint").alias(f"_{i}") for i, c in enumerate(own)])
        listed = F.array(*[F.struct(F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), F.col(f"_{i}").alias("violations"))
                           for i, c in enumerate(own)])
        return counted.select(F.inline(listed))

    many = F.col("violations") > 0
    message = F.when(many, F.concat(F.col("violations").cast("string"), F.lit(" frávik"))).otherwise("")
    return reduce(DataFrame.unionByName, map(rows, tables.values())).select(
        "check", (F.col("violations") == 0).alias("passed"), "severity", "violations", message.alias("message"))


def overall(report: DataFrame) -> DataFrame:
    failed = ~F.col("passed")
    return report.agg(
        F.count_if(failed & (F.col("severity") == ERROR)).alias("errors"),
        F.count_if(failed & (F.col("severity") == WARNING)).alias("warnings"),
    ).withColumn("passed", F.col("errors") == 0)
