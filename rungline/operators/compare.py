"""Step-function look-ups, rebasing and comparison with benchmark indices."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import month_key, round_places
from ..session import cut_lineage
from .consensus import DATE


def as_of(df: DataFrame, probes: DataFrame, keys: Sequence[str], date: str, value: str,
          at: str, alias: str) -> DataFrame:
    """The last ``value`` on or before each probe date; NULL where there is none.

    Probes are made distinct first, so series and probes of one key together
    hold at most a row or two per calendar day and the window over a key is
    bounded. Join the result back on (keys, ``at``).
    """
    keys = list(keys)
    asked = probes.select(*keys, F.col(at).alias("_at"), F.lit(None).cast("double").alias("_v"),
                          F.lit(True).alias("_probe")).distinct()
    known = df.select(*keys, F.col(date).alias("_at"), F.col(value).alias("_v"),
                      F.lit(False).alias("_probe"))
    window = (Window.partitionBy(*keys).orderBy("_at", "_probe")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        known.unionByName(asked)
        .withColumn(alias, F.last("_v", ignorenulls=True).over(window))
        .where("_probe").select(*keys, F.col("_at").alias(at), alias)
    )


def as_of_date(df: DataFrame, keys: Sequence[str], date: str, value: str, at: Column,
               alias: str) -> DataFrame:
    """The step function of every key at one date: a plain aggregate."""
    return df.where((F.col(date) <= at) & F.col(value).isNotNull()).groupBy(*keys).agg(
        F.max_by(value, date).alias(alias))


def until_year_end(df: DataFrame, today: Column, date: str = DATE) -> DataFrame:
    return df.where(F.col(date) <= F.make_date(F.year(today), F.lit(12), F.lit(31)))


def select_ids(df: DataFrame, ids: DataFrame, key: str = "union_key") -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_semi")


def unknown_ids(df: DataFrame, ids: DataFrame, key: str = "union_key") -> DataFrame:
    return ids.select(key).distinct().join(df.select(key).distinct(), key, "left_anti")


def default_unions(unions: DataFrame, grade: str, k: int = 4, key: str = "union_key") -> DataFrame:
    """The ``k`` continuous unions with most increases."""
    return (unions.where(F.col("grade") == grade)
            .orderBy(F.desc("n_increases"), key).limit(k))


def benchmark(df: DataFrame, **members: str) -> DataFrame:
    """Rows of the chosen dimension members, e.g. ``unit='Vísitölugildi'``."""
    for column, member in members.items():
        df = df.where(F.col(column) == member)
    return df


def benchmark_change(df: DataFrame, spans: DataFrame, start: str, end: str,
                     month: str = "month", value: str = "value") -> DataFrame:
    """Benchmark ratio between two dates' months; spans with a missing month drop out."""
    keyed = df.select(month_key(F.col(month)).alias("_m"), F.col(value).alias("_v"))
    first = keyed.select(F.col("_m").alias("_m1"), F.col("_v").alias("_v1"))
    last = keyed.select(F.col("_m").alias("_m2"), F.col("_v").alias("_v2"))
    return (
        spans.withColumn("_m1", month_key(F.col(start))).withColumn("_m2", month_key(F.col(end)))
        .join(first, "_m1").join(last, "_m2")
        .withColumn("benchmark_ratio", F.col("_v2") / F.col("_v1") * 100)
        .drop("_m1", "_m2", "_v1", "_v2")
    )


def rebase_at(df: DataFrame, keys: Sequence[str], date: str, value: str, at: Column) -> DataFrame:
    """Each series with 100 at ``at``, starting with an anchor point there.

    Series without a value by then, or with a base that is not positive, drop
    out; see ``dropped_at``.
    """
    line = Window.partitionBy(*keys)
    before = F.col(date) <= at
    return (
        df.where(F.col(value).isNotNull())
        .withColumn("_base_date", F.max(F.when(before, F.col(date))).over(line))
        .withColumn("_base", F.max(F.when(F.col(date) == F.col("_base_date"), F.col(value))).over(line))
        .where((F.col("_base") > 0) & (F.col(date) >= F.col("_base_date")))
        .select(*keys, F.greatest(F.col(date), at).alias(date),
                F.when(before, 100.0).otherwise(F.col(value) / F.col("_base") * 100).alias("rebased"))
    )


def dropped_at(df: DataFrame, keys: Sequence[str], date: str, value: str, at: Column) -> DataFrame:
    usable = (F.col(date) <= at) & F.col(value).isNotNull()
    base = F.max_by(F.when(usable, F.col(value)), F.when(usable, F.col(date)))
    return (df.groupBy(*keys).agg(base.alias("_base"))
            .where("_base is null or _base <= 0").drop("_base"))


def benchmark_rebased(df: DataFrame, start: Column, end: Column, at: Column | None = None,
                      month: str = "month", value: str = "value") -> DataFrame:
    """Monthly benchmark inside a window, 100 at its first month or at ``at``."""
    inside = df.where(month_key(F.col(month)).between(month_key(start), month_key(end)))
    base = _last_value(df, at, month, value) if at is not None else (
        inside.agg(F.min_by(value, month)).scalar())
    return (inside.withColumn("_base", base).where(F.col("_base").isNotNull())
            .select(month, (F.col(value) / F.col("_base") * 100).alias("rebased")))


def _last_value(df: DataFrame, at: Column, month: str = "month", value: str = "value") -> Column:
    """A benchmark's value for the last month not after ``at``, as a scalar subquery."""
    return df.where(month_key(F.col(month)) <= month_key(at)).agg(F.max_by(value, month)).scalar()


def compare(series: DataFrame, ids: DataFrame, benchmarks: dict[str, DataFrame], today: Column,
            at: Column | None = None, key: str = "union_key", date: str = DATE,
            value: str = "stretch_index") -> DataFrame:
    """Chosen unions and benchmarks in one long table (name, kind, date, value).

    With a common base date all lines are rebased there. Without one every
    union keeps its own base, and benchmarks are only shown for a single union.
    """
    def with_two(rows):
        return (rows.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key)))
                .where("_n > 1").drop("_n"))

    points = with_two(until_year_end(
        select_ids(series, ids, key).where(F.col(value).isNotNull()), today, date).select(key, date, value))
    if at is not None:
        points = with_two(rebase_at(points, [key], date, value, at))
    else:
        points = points.withColumnRenamed(value, "rebased")
    points = cut_lineage(points)  # shown, and read again for the span of each benchmark
    lines = points.select(F.col(key).alias("name"), F.lit("union").alias("kind"),
                          F.col(date).alias("date"), "rebased")
    span = points.agg(F.struct(
        F.min(date).alias("start"), F.max(date).alias("end"),
        (F.min(key) == F.max(key)).alias("single"))).scalar()
    for name, df in benchmarks.items():
        if at is not None:
            shown = benchmark_rebased(df, at, span["end"], at)
        else:
            shown = benchmark_rebased(df, span["start"], span["end"]).where(span["single"])
        lines = lines.unionByName(shown.select(
            F.lit(name).alias("name"), F.lit("benchmark").alias("kind"),
            F.col("month").alias("date"), "rebased"))
    return lines


def benchmark_summary(main_series: DataFrame, index: DataFrame, today: Column,
                      key: str = "union_key", date: str = DATE,
                      value: str = "stretch_index") -> DataFrame:
    """Per union with two or more continuous points: own change, benchmark change
    over the same span, and the change including what is agreed for later."""
    points = until_year_end(main_series.where(F.col(value).isNotNull()), today, date)
    measured_to = index.agg(F.max("month")).scalar()
    measured_part = F.when(F.col(date) <= F.col("_last"), F.col(date))
    spans = cut_lineage(
        points.withColumn("_last", measured_to).groupBy(key).agg(
            F.count(F.lit(1)).alias("points"), F.min(date).alias("span_from"), F.max(date).alias("last_date"),
            F.min_by(value, date).alias("_first"), F.max_by(value, date).alias("_final"),
            F.max_by(value, measured_part).alias("_own"), F.first("_last").alias("_last"))
        .where("points >= 2")
        .withColumn("span_to", F.least("last_date", "_last"))
    )
    # one benchmark: its months and the distinct probe dates are bounded by the calendar
    monthly = index.select(F.lit(0).alias("_k"), "month", "value")
    asked = spans.select(F.lit(0).alias("_k"), F.col("span_from").alias("_d")).unionByName(
        spans.select(F.lit(0).alias("_k"), F.col("span_to").alias("_d")))
    measured = as_of(monthly, asked, ["_k"], "month", "value", "_d", "_m").drop("_k")
    start = measured.select(F.col("_d").alias("span_from"), F.col("_m").alias("_m0"))
    end = measured.select(F.col("_d").alias("span_to"), F.col("_m").alias("_m1"))
    change = F.col("_own") / F.col("_first") * 100 - 100
    return (
        spans.join(start, "span_from", "left").join(end, "span_to", "left")
        .select(
            key, "span_from", "span_to", "points",
            round_places(change, 4).alias("own_change"),
            round_places(F.when((F.col("_m0") != 0) & (F.col("_m1") != 0),
                                F.col("_m1") / F.col("_m0") * 100 - 100), 4).alias("benchmark_change"),
            round_places(F.col("_final") / F.col("_first") * 100 - 100, 4).alias("total_change"),
            (F.col("last_date") > F.col("_last")).alias("agreed_beyond"))
    )


def real_change(main_series: DataFrame, prices: DataFrame, start: Column, end: Column,
                key: str = "union_key", date: str = DATE, value: str = "stretch_index") -> DataFrame:
    """Agreed change over what prices did between the same two dates, in percent."""
    first = as_of_date(main_series, [key], date, value, start, "_v0")
    last = as_of_date(main_series, [key], date, value, end, "_v1")
    nominal = F.col("_v1") / F.col("_v0")
    price = F.col("_p1") / F.col("_p0")
    return (
        first.where("_v0 > 0").join(last, key)
        .withColumn("_p0", _last_value(prices, start)).withColumn("_p1", _last_value(prices, end))
        .where("_p0 is not null and _p1 is not null")
        .select(key, round_places((nominal - 1) * 100, 4).alias("nominal_change"),
                round_places((price - 1) * 100, 4).alias("price_change"),
                round_places((nominal / price - 1) * 100, 4).alias("real_change"))
    )
