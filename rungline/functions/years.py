"""Which year does a dated increase belong to?"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed as X
from .text import make_date, once


def plausible_window(start: Column, end: Column) -> tuple[Column, Column]:
    """The dates an increase of a contract can rightly fall on.

    The validity period is widened at both ends; an open end is taken to be
    six years after the start, an open start eight years before the end.
    """
    low = F.date_sub(start, X.YEAR_WINDOW_DAYS)
    high = F.date_add(end, X.YEAR_WINDOW_DAYS)
    return (
        F.coalesce(low, F.make_date(F.year(high) - 8, F.lit(1), F.lit(1))),
        F.coalesce(high, F.make_date(F.year(low) + 6, F.lit(12), F.lit(31))),
    )


def _digits_that_differ(a: Column, b: Column) -> Column:
    places = (1, 10, 100, 1000)
    return sum(
        F.when(F.floor(a / p) % 10 == F.floor(b / p) % 10, 0).otherwise(1) for p in places
    )


def resolve_year(day: Column, month: Column, year: Column,
                 start: Column, end: Column) -> Column:
    """struct(date, status); ``date`` is NULL when the increase must be dropped."""
    low, high = plausible_window(start, end)
    return once(F.struct(low.alias("low"), high.alias("high")),
                lambda w: resolve_within(day, month, year, w["low"], w["high"]))


def resolve_within(day: Column, month: Column, year: Column, low: Column, high: Column) -> Column:
    """``resolve_year`` with the plausible window's ends at hand."""
    bounded = low.isNotNull() & high.isNotNull()
    written = make_date(year, month, day)
    in_window = written.isNotNull() & F.coalesce(written.between(low, high), ~bounded)
    years = F.when(bounded & (low <= high) & ~in_window, F.sequence(F.year(low), F.year(high))).otherwise(
        F.array().cast("array<int>"))
    candidates = F.filter(F.transform(years, lambda y: make_date(y, month, day)),
                          lambda d: d.between(low, high))

    def outside(fits: Column) -> Column:
        one_digit_off = F.filter(fits, lambda d: _digits_that_differ(F.year(d), year) == 1)
        return F.when(year.isNull(), F.struct(
            F.get(fits, F.lit(0)).alias("date"),
            F.when(F.size(fits) == 1, X.YEAR_INFERRED).when(F.size(fits) > 1, X.YEAR_INFERRED_UNSURE).alias("status"),
        )).otherwise(once(one_digit_off, lambda off: F.when(
            F.size(off) == 1, F.struct(F.get(off, F.lit(0)).alias("date"), F.lit(X.YEAR_CORRECTED).alias("status"))
        ).otherwise(F.struct(written.alias("date"), F.lit(X.YEAR_SUSPICIOUS).alias("status")))))

    return (
        F.when(in_window, F.struct(written.alias("date"), F.lit(X.YEAR_FROM_TEXT).alias("status")))
        .when(year.isNotNull() & written.isNull(), F.struct(
            F.lit(None).cast("date").alias("date"), F.lit(None).cast("string").alias("status")))
        .otherwise(once(candidates, outside))
    )
