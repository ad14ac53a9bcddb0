"""Ordered operators on consensus points: side agreements, twins, index, continuity.

Input has at most one row per line and calendar day (see ``consensus``), so a
window over one line is bounded by the calendar no matter how many raw rows
the line had. All windows share one partitioning: the chain needs a single
shuffle by line.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions.text import counterparty_name, month_gap, round_places
from ..session import cut_lineage
from .consensus import DATE, LINE, general_increases


def _line(keys: Sequence[str], date: str):
    return Window.partitionBy(*keys).orderBy(date)


def _running(keys, date):
    return _line(keys, date).rowsBetween(Window.unboundedPreceding, Window.currentRow)


# -------------------------------------------------------- company agreements

def same_increase(days: Column, pct_a: Column, pct_b: Column, amount_a: Column,
                  amount_b: Column, limit: int = X.CONFIRM_DAYS) -> Column:
    """Near in time and equal in percent, or in amount where a percent is missing."""
    both = pct_a.isNotNull() & pct_b.isNotNull()
    return (days <= limit) & F.when(both, F.abs(pct_a - pct_b) < X.PERCENT_EQUAL).otherwise(
        F.coalesce((amount_a == amount_b) & (amount_a != 0), F.lit(False)))


def _around(date: Column, reach: int) -> Column:
    """The blocks of ``reach`` days that hold every date within ``reach`` days."""
    block = F.floor(F.unix_date(date) / reach)
    return F.array(block - 1, block, block + 1)


def near(left: DataFrame, right: DataFrame, keys: Sequence[str], date: str, reach: int,
         how: str = "inner", condition=None, rename: str = "_r_") -> DataFrame:
    """Rows of ``left`` and ``right`` with equal keys at most ``reach`` days apart.

    An equi-join on (keys, block of days): ``right`` is copied to the three
    blocks around it, so a hot key is spread over its blocks of time.
    Columns of ``right`` get the prefix ``rename``.
    """
    copies = (
        right.withColumn("_block", F.explode(_around(F.col(date), reach)))
        .select("_block", *[F.col(c).alias(rename + c) for c in right.columns])
    )
    left = left.withColumn("_block", F.floor(F.unix_date(date) / reach))
    match = left["_block"] == copies["_block"]
    for k in keys:
        match &= left[k] == copies[rename + k]
    match &= F.abs(F.datediff(left[date], copies[rename + date])) <= reach
    if condition is not None:
        match &= condition(left, copies, rename)
    joined = left.join(copies, match, how)
    return joined.drop(left["_block"], copies["_block"]) if how in ("inner", "left") else joined.drop("_block")


def _same(reach: int):
    def condition(a, b, p):
        return same_increase(F.abs(F.datediff(a[DATE], b[p + DATE])), a["pct"], b[p + "pct"],
                             a["amount"], b[p + "amount"], reach)
    return condition


def fold_company_lines(points: DataFrame, main: DataFrame,
                       foldable: Column | None = None, key: str = "union_key",
                       counterparty: str = "counterparty",
                       name: str | None = None) -> DataFrame:
    """Fold company and unknown-counterparty lines into their union's main line.

    Row by row, in the order the lines and points were first seen, a point
    either confirms a main-line row, fills a hole in the main line with a
    general increase of the main counterparty, or stays on its own line.

    Only fills depend on the order, and only on earlier fills: a fill needs an
    empty stretch of ``YIELD_DAYS`` around it, and confirming a row never
    moves it. So the ordered part is a greedy choice among the general points
    far from the main line — at most one per union and day — and everything
    else is a join.
    """
    if foldable is None:
        foldable = F.col(counterparty).startswith(X.COMPANY_PREFIX) | (
            F.col(counterparty) == X.UNKNOWN_COUNTERPARTY)
    label = name or counterparty
    extra = points.columns
    line = Window.partitionBy(key, counterparty)
    tagged = cut_lineage(  # every branch below reads it
        points.withColumn("line_row", F.min("first_row").over(line)).join(main, key)
        .withColumn("is_main", F.col(counterparty) == F.col("main_counterparty"))
        .withColumn("order", F.struct("line_row", "first_row"))
    )
    general = general_increases(tagged, key=key, counterparty=counterparty, excluded=foldable)
    main_rows = tagged.where("is_main").select(*extra, "main_counterparty", "order")
    loose = tagged.where(~F.col("is_main") & foldable).select(*extra, "main_counterparty", "order")
    other = tagged.where(~F.col("is_main") & ~foldable).select(*extra)

    shared = general.select(F.col(counterparty).alias("main_counterparty"), DATE, "pct", "amount")
    candidates = near(loose, shared, ["main_counterparty"], DATE, X.CONFIRM_DAYS, "left_semi",
                      _same(X.CONFIRM_DAYS))
    candidates = near(candidates, main_rows.select(key, DATE), [key], DATE, X.YIELD_DAYS, "left_anti")
    one_per_day = candidates.groupBy(key, DATE).agg(F.min("order").alias("order"))
    fills = cut_lineage(_greedy_fills(one_per_day, key))

    filled = (
        loose.join(fills, [key, DATE, "order"], "left_semi")
        .withColumn("filled_from", F.col(label))
        .withColumn(counterparty, F.col("main_counterparty"))
    )
    if name:
        main_name = main_rows.groupBy(key).agg(F.min_by(name, "order").alias("_main_name"))
        filled = (filled.join(main_name, key, "left")
                  .withColumn(name, F.coalesce(counterparty_name(F.col(counterparty)),
                                               "_main_name", F.col(counterparty)))
                  .drop("_main_name"))
    unfilled = loose.join(fills, [key, DATE, "order"], "left_anti")
    targets = main_rows.withColumn("is_fill", F.lit(False)).withColumn("filled_from", F.lit(None).cast("string")).unionByName(
        filled.withColumn("is_fill", F.lit(True)))

    def confirms(a, b, p):
        return _same(X.CONFIRM_DAYS)(a, b, p) & (~b[p + "is_fill"] | (b[p + "order"] < a["order"]))

    ident = [key, counterparty, DATE, "order"]
    slim = targets.select(key, DATE, "pct", "amount", "order", "is_fill")
    matched = cut_lineage(
        near(unfilled, slim, [key], DATE, X.CONFIRM_DAYS, "inner", confirms)
        .groupBy(*ident)
        .agg(F.min(F.struct("_r_is_fill", "_r_order", "_r_" + DATE)).alias("target"),
             F.first("sources").alias("sources"),
             *([F.first("origins").alias("origins")] if "origins" in extra else []))
    )
    added = matched.groupBy(key, F.col("target._r_" + DATE).alias(DATE)).agg(
        F.sum("sources").alias("_added"),
        *([F.array_sort(F.array_distinct(F.flatten(F.collect_set("origins")))).alias("_origins")]
          if "origins" in extra else []))
    kept_main = (
        targets.join(added, [key, DATE], "left")
        .withColumn("sources", F.col("sources") + F.coalesce("_added", F.lit(0)))
    )
    if "origins" in extra:
        kept_main = kept_main.withColumn("origins", F.array_sort(F.array_union(
            "origins", F.coalesce("_origins", F.array().cast("array<string>")))))
    stays = unfilled.join(matched.select(*ident), ident, "left_anti")
    empty = F.lit(None).cast("string").alias("filled_from")
    return (
        kept_main.select(*extra, "filled_from")
        .unionByName(stays.select(*extra, empty))
        .unionByName(other.select(*extra, empty))
    )


def _greedy_fills(candidates: DataFrame, key: str) -> DataFrame:
    """In order, take each candidate with no earlier taken one within ``YIELD_DAYS``.

    One candidate per union and day: the array folded here is bounded by the
    calendar.
    """
    day = F.struct(F.col("order"), F.unix_date(DATE).alias("day"))
    taken = F.aggregate(
        F.array_sort(F.collect_list(day)),
        F.array().cast("array<struct<order:struct<line_row:bigint,first_row:bigint>,day:int>>"),
        lambda kept, x: F.when(
            F.exists(kept, lambda k: F.abs(k["day"] - x["day"]) <= X.YIELD_DAYS), kept
        ).otherwise(F.array_append(kept, x)))
    return (
        candidates.withColumn("order", F.struct(
            F.col("order.line_row").cast("bigint").alias("line_row"),
            F.col("order.first_row").cast("bigint").alias("first_row")))
        .groupBy(key).agg(taken.alias("_taken"))
        .select(key, F.explode("_taken").alias("_t"))
        .select(key, F.date_from_unix_date("_t.day").alias(DATE), F.col("_t.order").alias("order"))
    )


# --------------------------------------------------------------- federations

def inherit(points: DataFrame, members: DataFrame, key: str = "union_key",
            counterparty: str = "counterparty", describe: Sequence[str] = (),
            federation_name: str | None = None) -> DataFrame:
    """Members take over all rows of their federation for one counterparty.

    ``members``: (member, federation, counterparty). A member needs rows of
    its own already; its own rows within ``YIELD_DAYS`` of a federation row
    give way. ``describe`` columns are the member's own (from its first row).
    """
    columns = points.columns
    if "inherited_from" in columns:
        points = points.drop("inherited_from")
        columns = points.columns
    label = F.col(federation_name) if federation_name else F.col(key)
    profile = points.groupBy(key).agg(
        F.min("first_row").alias("_seen"),
        *[F.min_by(c, "first_row").alias("_own_" + c) for c in describe])
    taken = (
        points.withColumn("inherited_from", label)
        .join(members.select("member", F.col("federation").alias(key), counterparty),
              [key, counterparty])
        .drop(key).withColumnRenamed("member", key)
        .join(profile, key)
    )
    for c in describe:
        taken = taken.withColumn(c, F.col("_own_" + c))
    taken = taken.select(*columns, "inherited_from")
    own = near(points, taken.select(key, counterparty, DATE), [key, counterparty], DATE,
               X.YIELD_DAYS, "left_anti")
    return own.withColumn("inherited_from", F.lit(None).cast("string")).unionByName(taken)


# ------------------------------------------------------- side agreements, twins

def mark_side(df: DataFrame, keys: Sequence[str] = LINE, date: str = DATE,
              sources: str = "sources", days: int = X.SIDE_DAYS, ratio: int = X.SIDE_RATIO,
              minimum: int = X.SIDE_MIN_SOURCES) -> DataFrame:
    """``in_chain`` is 0 where a row near in time has ``ratio`` times the sources.

    The row itself can never outweigh itself, so a range window replaces the
    pairwise search.
    """
    weight = F.when(F.coalesce(F.col(sources), F.lit(0)) == 0, 1).otherwise(F.col(sources))
    nearby = (Window.partitionBy(*keys).orderBy(F.unix_date(date))
              .rangeBetween(-days, days))
    strongest = F.max(weight).over(nearby)
    side = (strongest >= weight * ratio) & (strongest >= minimum)
    return df.withColumn("in_chain", F.when(side, 0).otherwise(1))


def merge_twins(df: DataFrame, keys: Sequence[str] = LINE, date: str = DATE, pct: str = "pct",
                sources: str = "sources", days: int = X.TWIN_DAYS,
                replaced: Sequence[str] = ("basis", "amount")) -> DataFrame:
    """The same percent within ``days`` of a kept row is the same step.

    The kept row keeps its date and flag; ``replaced`` columns and the source
    count come from a twin that has more sources. ``merged`` counts twins.
    Rows kept for one percent are more than ``days`` apart, so only the last
    kept one can match, and percents can be folded apart from each other.
    """
    payload = [c for c in df.columns if c not in (*keys, pct)]
    order = [date, *[c for c in payload if c != date]]
    row = F.struct(*[F.col(c) for c in order], F.lit(0).alias("merged"))
    rows = F.array_sort(F.collect_list(row))
    grouped = df.groupBy(*keys, pct).agg(rows.alias("_rows"))

    def fold(kept, x):
        last = F.element_at(kept, -1)
        stronger = x[sources] > last[sources]
        merged = F.struct(*[
            F.when(stronger, x[c]).otherwise(last[c]).alias(c) if c in (*replaced, sources)
            else last[c].alias(c) for c in order
        ], (last["merged"] + 1).alias("merged"))
        twin = F.datediff(x[date], last[date]) <= days
        return F.when(twin, F.concat(F.slice(kept, 1, F.size(kept) - 1), F.array(merged))).otherwise(
            F.array_append(kept, x))

    folded = F.aggregate(
        F.slice(F.col("_rows"), 2, F.size("_rows")), F.slice(F.col("_rows"), 1, 1), fold)
    result = F.when(F.coalesce(F.col(pct), F.lit(0.0)) == 0.0, F.col("_rows")).otherwise(folded)
    return (
        grouped.select(*keys, pct, F.explode(result).alias("_row"))
        .select(*keys, pct, *[F.col(f"_row.{c}").alias(c) for c in order],
                F.col("_row.merged").alias("merged"))
    )


# -------------------------------------------------------------- chained index

def chain_index(df: DataFrame, keys: Sequence[str] = LINE, date: str = DATE,
                pct: str = "pct", in_chain: str | None = "in_chain") -> DataFrame:
    """Index per line, 100 at its first row; months since the previous row; a note.

    The first row is 100 whatever its own percent; the running value is not
    rounded between steps.
    """
    chained = (F.col(in_chain) == 1) if in_chain else F.lit(True)
    has_pct = F.coalesce(F.col(pct), F.lit(0.0)) != 0.0
    factor = F.when((F.col("_rn") > 1) & chained & has_pct, 1 + F.col(pct) / 100).otherwise(F.lit(1.0))
    gap = month_gap(F.lag(date).over(_line(keys, date)), F.col(date))
    return (
        df.withColumn("_rn", F.row_number().over(_line(keys, date)))
        .withColumn("gap_months", gap)
        .withColumn("index", round_places(100 * F.product(factor).over(_running(keys, date))))
        .withColumn("note", F.when(F.col("_rn") == 1, X.NOTE_BASE)
                    .when(~chained, X.NOTE_SIDE)
                    .when(~has_pct, X.NOTE_AMOUNT_ONLY)
                    .when(F.col("gap_months") > X.LONG_GAP_MONTHS, X.NOTE_LONG_GAP)
                    .otherwise(""))
        .drop("_rn")
    )


# ----------------------------------------------------------------- continuity

def with_confirmed(df: DataFrame, confirmed: DataFrame, keys: Sequence[str] = LINE,
                   date: str = DATE, is_main: str = "is_main") -> DataFrame:
    """``gap_confirmed``: a reviewer found the gap before this row to be real.

    ``confirmed``: (union, counterparty, gap_from, gap_to); a blank
    counterparty stands for the union's main line.
    """
    union, counterparty = keys
    marks = confirmed.select(
        F.col(union), F.coalesce(F.trim(counterparty), F.lit("")).alias("_cp"),
        F.col("gap_from").alias("_from"), F.col("gap_to").alias(date)).distinct()
    previous = df.withColumn("_from", F.lag(date).over(_line(keys, date)))
    exact = marks.where("_cp <> ''").select(
        union, F.col("_cp").alias(counterparty), "_from", date, F.lit(True).alias("_exact"))
    main = marks.where("_cp = ''").select(union, "_from", date, F.lit(True).alias("_main"))
    return (
        previous.join(exact, [union, counterparty, "_from", date], "left")
        .join(main, [union, "_from", date], "left")
        .withColumn("gap_confirmed", F.coalesce("_exact", F.lit(False))
                    | (F.coalesce("_main", F.lit(False)) & F.coalesce(F.col(is_main).cast("boolean"), F.lit(False))))
        .drop("_from", "_exact", "_main")
    )


def continuity(df: DataFrame, keys: Sequence[str] = LINE, date: str = DATE,
               months: int = X.GAP_MONTHS, confirmed: str | None = None) -> DataFrame:
    """Newest stretch without a gap, counted back from the last row.

    Adds its first date, its number of points, whole years covered, the number
    of breaks in the whole line, a 0/1 flag per row and the grade.
    """
    whole = Window.partitionBy(*keys)
    gap = month_gap(F.lag(date).over(_line(keys, date)), F.col(date))
    break_here = F.coalesce(F.col("_gap") > months, F.lit(False))
    if confirmed:
        break_here = break_here & ~F.coalesce(F.col(confirmed), F.lit(False))
    years = F.year("_last") - F.year("stretch_from")
    return (
        df.withColumn("_gap", gap)
        .withColumn("_break", break_here)
        .withColumn("stretch_from", F.coalesce(F.max(F.when(F.col("_break"), F.col(date))).over(whole),
                                               F.min(date).over(whole)))
        .withColumn("older_gaps", F.count_if("_break").over(whole))
        .withColumn("_last", F.max(date).over(whole))
        .withColumn("in_stretch", F.when(F.col(date) >= F.col("stretch_from"), 1).otherwise(0))
        .withColumn("stretch_points", F.sum("in_stretch").over(whole))
        .withColumn("stretch_years", years)
        .withColumn("grade", grade(F.col("stretch_points"), F.col("stretch_years")))
        .drop("_gap", "_break", "_last")
    )


def grade(points: Column, years: Column) -> Column:
    return (F.when(points < 3, X.GRADE_TOO_FEW)
            .when(years >= 3, X.GRADE_CONTINUOUS).otherwise(X.GRADE_GAPS))


def rebase_continuous(df: DataFrame, keys: Sequence[str] = LINE, date: str = DATE) -> DataFrame:
    """Index with 100 at the start of the newest stretch, NULL before it."""
    base = F.max(F.when(F.col(date) == F.col("stretch_from"), F.col("index"))).over(
        Window.partitionBy(*keys))
    rebased = F.when((F.col("in_stretch") == 1) & (base != 0), round_places(F.col("index") / base * 100))
    return df.withColumn("stretch_index", rebased)


def build_series(points: DataFrame, confirmed: DataFrame | None = None,
                 keys: Sequence[str] = LINE, date: str = DATE,
                 replaced: Sequence[str] = ("basis", "amount"),
                 is_main: str = "is_main") -> DataFrame:
    """Side marks, then twins, then index, continuity and rebasing, in that order."""
    rows = merge_twins(mark_side(points, keys, date), keys, date, replaced=replaced)
    flag = None
    if confirmed is not None:
        rows, flag = with_confirmed(rows, confirmed, keys, date, is_main), "gap_confirmed"
    return rebase_continuous(continuity(chain_index(rows, keys, date), keys, date, confirmed=flag),
                             keys, date)


# ------------------------------------------------------------------ summaries

def line_summary(series: DataFrame, keys: Sequence[str] = LINE, date: str = DATE,
                 inherited: str | None = None, row: str = "first_row") -> DataFrame:
    """One row per line; where the rows tell when they were first seen, so does the line."""
    seen = [F.min(row).alias(row)] if row in series.columns else []
    extra = [F.max_by(F.nullif(inherited, F.lit("")), F.when(
        F.coalesce(F.col(inherited), F.lit("")) != "", -F.unix_date(date))).alias(inherited)] if inherited else []
    return series.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_increases"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.first("stretch_from").alias("stretch_from"),
        F.first("stretch_years").alias("stretch_years"),
        F.first("stretch_points").alias("stretch_points"),
        F.first("older_gaps").alias("older_gaps"),
        F.max_by("index", date).alias("last_index"),
        F.max_by("stretch_index", F.when(F.col("stretch_index").isNotNull(), F.col(date))).alias("last_stretch_index"),
        F.max("gap_months").alias("longest_gap"),
        F.first("grade").alias("grade"),
        *seen, *extra,
    )


def union_modes(series: DataFrame, key: str = "union_key", name: str = "union_name",
                modes: Sequence[str] = ("union_id", "market", "umbrella"), row: str = "first_row") -> DataFrame:
    """The most frequent non-blank value of each of ``modes`` over all lines of a union; the first seen wins a tie.

    One partial aggregation over (union, column, value), whatever the number of columns.
    """
    listed = F.explode(F.array(*[F.struct(F.lit(m).alias("mode"), F.col(m).cast("string").alias("value")) for m in modes]))
    counted = (series.select(key, row, listed.alias("_m")).where("_m.value <> ''")
               .groupBy(key, "_m.mode", "_m.value").agg(F.count(F.lit(1)).alias("_n"), F.min(row).alias("_first")))
    best = F.struct("_n", -F.col("_first"))
    return counted.groupBy(key).agg(*[F.max_by(F.when(F.col("mode") == m, F.col("value")), F.when(F.col("mode") == m, best)).alias(m) for m in modes])


def union_summary(lines: DataFrame, main: DataFrame, key: str = "union_key",
                  counterparty: str = "counterparty") -> DataFrame:
    """One row per union from its main line, or from its largest line without one; of equally large lines
    the one seen first (``first_row``)."""
    marked = lines.join(main, key, "left").withColumn(
        "is_main", F.coalesce(F.col(counterparty) == F.col("main_counterparty"), F.lit(False)))
    seen = -F.col("first_row") if "first_row" in lines.columns else F.lit(0)
    best = F.struct(F.col("is_main").cast("int").alias("a"), F.col("n_increases").alias("b"), seen.alias("c"))
    shown = ["first_date", "last_date", "n_increases", "stretch_from", "stretch_years",
             "stretch_points", "older_gaps", "last_index", "last_stretch_index",
             "longest_gap", "grade"]
    chosen = F.max(F.struct(best.alias("_best"), *[F.col(c) for c in (counterparty, *shown)]))
    return (
        marked.groupBy(key)
        .agg(chosen.alias("_line"), F.count(F.lit(1)).alias("n_lines"),
             F.sum("n_increases").alias("n_increases_all"))
        .select(key, F.col(f"_line.{counterparty}").alias("main_line"),
                *[F.col(f"_line.{c}").alias(c) for c in shown], "n_lines", "n_increases_all")
    )
