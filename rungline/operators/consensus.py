"""One point per (union, counterparty, date) out of everything that mentions it.

Raw rows of a hot line are reduced by partial aggregation before they are
shuffled. What leaves this module holds at most one row per line and calendar
day, and it is that bound which makes the per-line windows in ``series`` safe.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions.text import counterparty_name, round_places
from .ranking import most_frequent

LINE = ("union_key", "counterparty")
DATE = "valid_from"


def trusted(df: DataFrame, status: str = "year_status",
            accepted: Sequence[str] = tuple(X.TRUSTED_YEAR)) -> DataFrame:
    return df.where(F.col(status).isin(*accepted))


def basis_rank(basis, priority: Sequence[str]):
    position = F.array_position(F.array(*[F.lit(b) for b in priority]), basis)
    return F.when(F.coalesce(position, F.lit(0)) == 0, len(priority) + 1).otherwise(position)


def consensus(df: DataFrame, keys: Sequence[str] = LINE, date: str = DATE,
              priority: Sequence[str] = tuple(X.BASIS_PRIORITY),
              describe: Sequence[str] = (), origin: str | None = None,
              name: str | None = None) -> DataFrame:
    """Median values of the best basis; counts and origins over all rows.

    ``describe`` columns come from the first row with the best basis.
    """
    point = [*keys, date]
    first = F.struct("row_id", *describe)
    values = (
        df.withColumn("_rank", basis_rank(F.col("basis"), priority))
        .groupBy(*point, "_rank", "basis", "pct", "amount",
                 *([origin] if origin else []))
        .agg(F.count(F.lit(1)).alias("_n"), F.min(first if describe else F.col("row_id")).alias("_first"))
    )
    first_row = F.col("_first.row_id") if describe else F.col("_first")
    whole_point = Window.partitionBy(*point)
    best = (
        values.withColumn("_best", F.min("_rank").over(whole_point))
        .withColumn("_sources", F.sum("_n").over(whole_point))
        .withColumn("_row", F.min(first_row).over(whole_point))
    )
    if origin:
        best = best.withColumn("_origins", F.array_sort(F.collect_set(origin).over(whole_point)))
    # equal best rank can mean several unlisted bases: the first seen decides
    best = best.where(F.col("_rank") == F.col("_best"))
    best = (best.withColumn("_chosen", F.min_by("basis", first_row).over(whole_point))
            .where(F.col("basis").eqNullSafe(F.col("_chosen"))))
    points = best.groupBy(*point).agg(
        F.first("_chosen").alias("basis"),
        round_places(F.percentile("pct", F.lit(0.5), F.col("_n"))).alias("pct"),
        F.percentile("amount", F.lit(0.5), F.col("_n")).cast("bigint").alias("amount"),
        F.first("_sources").alias("sources"),
        F.size(F.collect_set("pct")).alias("distinct_pcts"),
        F.first("_row").alias("first_row"),
        *([F.first("_origins").alias("origins")] if origin else []),
        *([F.min("_first").alias("_first")] if describe else []),
    )
    if describe:
        points = points.select("*", *[F.col(f"_first.{c}").alias(c) for c in describe]).drop("_first")
    if name:
        named = most_frequent(df, point, name, "row_id", "_name")
        fallback = F.coalesce(counterparty_name(F.col(keys[-1])), F.col(keys[-1]))
        points = (points.join(named, point, "left")
                  .withColumn(name, F.coalesce("_name", fallback)).drop("_name"))
    return points


def display_names(df: DataFrame, key: str = "union_key", name: str = "union_name",
                  row: str = "row_id", alias: str | None = None) -> DataFrame:
    return most_frequent(df, [key], name, row, alias)


def choose_main(df: DataFrame, as_of, federations: DataFrame | None = None,
                overrides: DataFrame | None = None, key: str = "union_key",
                counterparty: str = "counterparty", date: str = DATE,
                umbrella: str = "umbrella", market: str = "market",
                unknown: str = X.UNKNOWN_COUNTERPARTY,
                public_umbrellas: Sequence[str] = tuple(X.PUBLIC_FEDERATIONS),
                private_umbrella: str = X.PRIVATE_FEDERATION,
                public_market: str = X.PUBLIC_MARKET,
                public_order: Sequence[str] = tuple(X.PUBLIC_ORDER),
                private_order: Sequence[str] = tuple(X.PRIVATE_ORDER),
                other_order: Sequence[str] = tuple(X.OTHER_ORDER)) -> DataFrame:
    """(union, main counterparty): override, federation, sector rule, then most rows.

    ``federations`` and ``overrides`` hold (key, counterparty), one row per union.
    """
    from_date = F.make_date(F.year(as_of) - X.RECENT_YEARS, F.lit(1), F.lit(1))
    # counterparties, umbrellas and markets of a union are counted in one pass over the rows
    values = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("value")) for c in (counterparty, umbrella, market)])
    counts = (
        df.select(key, date, "row_id", F.inline(values)).groupBy(key, "kind", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(date) >= from_date).alias("recent"), F.min("row_id").alias("first_row"))
    )
    listed = list(dict.fromkeys([*public_order, *private_order, *other_order]))
    filled = F.coalesce(F.col("value"), F.lit("")) != ""
    is_party = (F.col("kind") == counterparty) & filled & (F.col("value") != unknown)

    def most(which: Column, *order: Column) -> Column:
        return F.max_by(F.when(which, F.col("value")), F.when(which, F.struct(*order)))

    by_number = (F.col("n"), -F.col("first_row"))
    result = counts.groupBy(key).agg(
        most(is_party, F.col("recent"), *by_number).alias("_most"),
        most((F.col("kind") == umbrella) & filled, *by_number).alias("_umbrella"),
        most((F.col("kind") == market) & filled, *by_number).alias("_market"),
        *[F.max(is_party & (F.col("value") == c) & (F.col("n") >= X.MIN_MAIN_ROWS)).alias(f"_has_{i}") for i, c in enumerate(listed)])

    def first_usable(order):
        return F.coalesce(*[F.when(F.col(f"_has_{listed.index(c)}"), c) for c in order])

    private = F.coalesce(F.col("_umbrella") == private_umbrella, F.lit(False))
    public = F.coalesce(F.col("_umbrella").isin(*public_umbrellas), F.lit(False)) | (
        ~private & F.coalesce(F.col("_market") == public_market, F.lit(False)))
    by_rule = F.coalesce(
        F.when(public, first_usable(public_order))
        .when(private, first_usable(private_order))
        .otherwise(first_usable(other_order)),
        F.col("_most"), F.lit(unknown))
    sources = [by_rule]
    for table, column in ((federations, "_federation"), (overrides, "_override")):
        if table is not None:
            result = result.join(
                table.select(key, F.col(counterparty).alias(column)), key, "left")
            sources.insert(0, F.col(column))
    return result.select(key, F.coalesce(*sources).alias("main_counterparty"))


def assign_line(df: DataFrame, main: DataFrame, key: str = "union_key",
                counterparty: str = "counterparty", own_site: str = "own_site",
                unknown: str = X.UNKNOWN_COUNTERPARTY) -> DataFrame:
    """Rows without counterparty, or unknown from the union's own site, go to the main line."""
    blank = F.coalesce(F.trim(counterparty), F.lit("")) == ""
    own = (F.col(counterparty) == unknown) & F.coalesce(F.col(own_site) == 1, F.lit(False))
    return (df.join(main, key, "left")
            .withColumn(counterparty, F.when(blank | own, F.col("main_counterparty"))
                        .otherwise(F.trim(counterparty)))
            .drop("main_counterparty"))


def is_company(counterparty: str = "counterparty"):
    return F.col(counterparty).startswith(X.COMPANY_PREFIX)


def general_increases(points: DataFrame, minimum: int = X.GENERAL_MIN_UNIONS,
                      key: str = "union_key", counterparty: str = "counterparty",
                      date: str = DATE, excluded=None) -> DataFrame:
    """(counterparty, date, pct, amount) that at least ``minimum`` unions share."""
    if excluded is None:
        excluded = is_company(counterparty) | (F.col(counterparty) == X.UNKNOWN_COUNTERPARTY)
    increase = [counterparty, date, "pct", "amount"]
    return (
        points.where(~excluded).groupBy(*increase, key).agg(F.count(F.lit(1)))
        .groupBy(*increase).agg(F.count(F.lit(1)).alias("unions"))
        .where(F.col("unions") >= minimum)
    )
