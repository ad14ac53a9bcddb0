"""Wage tables: reading them out of text lines, checking and measuring them."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions import text as T
from ..session import cut_lineage
from .ranking import dealt, grouped_median, keep_first


# ------------------------------------------------------------------ scanner

def table_lines(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Lines of a text that say something about a wage table, with what they say."""
    lines = (
        docs.select(ident, F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "_line"))
        .withColumn("_line", F.regexp_replace("_line", r"(?U)\s+$", "")).where("_line <> ''")
    )
    line = F.col("_line")
    worded = T.make_date(T.group_or_null(line, X.TABLE_DATE_WORDS, 3).try_cast("int"),
                         T.month_number(F.regexp_extract(line, X.TABLE_DATE_WORDS, 2)),
                         T.group_or_null(line, X.TABLE_DATE_WORDS, 1).try_cast("int"))
    numbered = T.make_date(*[T.group_or_null(line, X.TABLE_DATE_NUMBERS, g).try_cast("int") for g in (3, 2, 1)])
    unit = None
    for name, pattern in X.WAGE_UNITS:
        unit = F.when(line.rlike(pattern), name) if unit is None else unit.when(line.rlike(pattern), name)
    is_rate = line.rlike(X.RATE_LINE)
    labels = F.transform(F.regexp_extract_all(line, F.lit(X.STEP_LABEL), F.lit(0)), T.squeeze)
    header = line.rlike(X.STEP_HEADER) & ~is_rate & (F.size(labels) > 0)
    return (
        lines.withColumn("_date", F.coalesce(worded, numbered)).withColumn("_unit", unit)
        .withColumn("_labels", F.when(header, labels))
        .withColumn("_grade", F.when(is_rate, F.regexp_extract(line, X.RATE_LINE, 1)))
        .withColumn("_wages", F.when(is_rate, F.regexp_extract_all(
            F.regexp_extract(line, X.RATE_LINE, 2), F.lit(X.WAGE), F.lit(0))))
        .drop("_line")
        .where("_date is not null or _unit is not null or _labels is not null or _grade is not null")
    )


BLOCK = 512  # lines of a document that are handled together


def _returns(rows: DataFrame, ident: str) -> DataFrame:
    """(document, line_no, _next): for a line with a grade the first later line under its header whose grade has come back since.

    Of all lines from here on it is the earliest at which a grade is met again. Minima and next lines are taken in blocks, and over one row per block
    (and grade), so the lines under one header are shared by several tasks.
    """
    part = [ident, "_headers"]
    rated = rows.where(F.col("_grade").isNotNull()).select(*part, "_block", "line_no", "_grade")
    blocks = rated.groupBy(*part, "_grade", "_block").agg(F.min("line_no").alias("_first"))
    after = blocks.select(*part, "_grade", "_block", F.lead("_first").over(
        Window.partitionBy(*part, "_grade").orderBy("_block")).alias("_after"))
    inside = Window.partitionBy(*part, "_grade", "_block").orderBy("line_no")
    back = rated.join(after.hint("merge"), [*part, "_grade", "_block"]).select(
        *part, "_block", "line_no", F.coalesce(F.lead("line_no").over(inside), "_after").alias("_back"))
    least = back.groupBy(*part, "_block").agg(F.min("_back").alias("_least"))
    below = Window.partitionBy(*part).orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    later = least.select(*part, "_block", F.min("_least").over(below).alias("_later"))
    here = Window.partitionBy(*part, "_block").orderBy(F.desc("line_no")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (back.join(later.hint("merge"), [*part, "_block"])
            .select(*part, "line_no", F.least(F.min("_back").over(here), F.col("_later")).alias("_next")).where("_next is not null"))


def _restarts(rows: DataFrame, ident: str) -> DataFrame:
    """(document, line_no) of the lines whose grade was seen since the last header or restart: there a new table begins.

    From a header's first line on each restart points to the next one. Pointers are doubled: with as many joins as the
    logarithm of the restarts under a header, all of them are reached.
    """
    jump = cut_lineage(_returns(rows, ident))
    first = jump.groupBy(ident, "_headers").agg(F.min("line_no").alias("line_no"))
    jump = jump.drop("_headers")
    reached = first.select(ident, "line_no", F.lit(0).alias("_restart"))
    while True:
        step = cut_lineage(reached.join(jump.hint("merge"), [ident, "line_no"]).select(ident, F.col("_next").alias("line_no"), F.lit(1).alias("_restart")))
        if step.isEmpty():
            return reached.where("_restart = 1")
        reached = reached.unionByName(step)
        further = jump.select(ident, F.col("line_no").alias("_next"), F.col("_next").alias("_further"))
        jump = cut_lineage(jump.join(further.hint("merge"), [ident, "_next"]).select(ident, "line_no", F.col("_further").alias("_next")))


def scan_wage_tables(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per amount: table number, unit, grade, step number and label, wage, date.

    The effective date, unit and step headers are carried forward from the
    lines above; the table number rises with each new date, unit or header and
    when a grade comes back. Lines are handled in blocks: what a block takes over from those
    before it comes from one row per block, so a long document is shared by several tasks. What
    the lines say is kept, because it is read twice. All joins are by rows sorted on both sides: Spark's
    size check takes the size of files, of which a few megabytes hold millions of short rows.
    """
    lines = (cut_lineage(table_lines(docs, ident, text)).withColumn("_block", F.floor(F.col("line_no") / BLOCK))
             .withColumn("_is_header", F.col("_labels").isNotNull()).repartition(ident, "_block"))
    inside = Window.partitionBy(ident, "_block").orderBy("line_no")
    upto, above = (inside.rowsBetween(Window.unboundedPreceding, end) for end in (Window.currentRow, -1))
    blocks = Window.partitionBy(ident).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ["_date", "_unit", "_labels"]
    ends = lines.groupBy(ident, "_block").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("line_no"))).alias(c) for c in carried], F.count_if("_is_header").alias("_n"))
    starts = ends.select(ident, "_block", *[F.last(c, ignorenulls=True).over(blocks).alias(c + "_start") for c in carried],
                         F.coalesce(F.sum("_n").over(blocks), F.lit(0)).alias("_headers_start"))
    value = lambda c, rows: F.coalesce(F.last(c, ignorenulls=True).over(rows), F.col(c + "_start"))
    changed = lambda c: F.when(F.col(c).isNotNull() & ~F.col(c).eqNullSafe(F.col(c + "_above")), 1).otherwise(0)
    state = (
        lines.join(starts.hint("merge"), [ident, "_block"])
        .withColumns({c + "_now": value(c, upto) for c in carried} | {c + "_above": value(c, above) for c in carried[:2]}
                     | {"_headers": F.col("_headers_start") + F.count_if("_is_header").over(upto)})
        .withColumn("_new", changed("_date") + changed("_unit") + F.col("_is_header").cast("int"))
        .select(ident, "_block", "line_no", "_date_now", "_unit_now", "_labels_now", "_headers", "_grade", "_wages", "_new")
    )
    state = cut_lineage(state)
    steps = state.join(_restarts(state, ident).hint("merge"), [ident, "line_no"], "left").withColumn(
        "_new", F.col("_new") + F.coalesce("_restart", F.lit(0))).drop("_restart")
    sums = steps.groupBy(ident, "_block").agg(F.sum("_new").alias("_n")).select(
        ident, "_block", F.coalesce(F.sum("_n").over(blocks), F.lit(0)).alias("_before"))
    numbered = steps.join(sums.hint("merge"), [ident, "_block"]).withColumn("_number", F.col("_before") + F.sum("_new").over(upto))
    first = T.parse_wage(F.get(F.col("_wages"), F.lit(0)))
    unit = F.coalesce("_unit_now", F.when(first >= X.MONTHLY_FROM, X.UNIT_MONTHLY).otherwise(X.UNIT_HOURLY))
    number = F.col("_number")
    amounts = (
        numbered.where("size(_wages) >= 2").withColumn("unit", unit)
        .withColumn("table_no", F.when(number == 0, 1).otherwise(number).cast("int"))
        .select(ident, "line_no", F.col("_date_now").alias("valid_from"), "table_no", "unit",
                F.col("_grade").alias("grade"), "_labels_now", F.posexplode("_wages").alias("_i", "_wage"))
        .withColumn("wage", T.parse_wage(F.col("_wage")))
    )
    return (
        amounts.where(within_bounds(F.col("unit"), F.col("wage")))
        .select(ident, "line_no", "valid_from", "table_no", "unit", "grade", (F.col("_i") + 1).alias("step_no"),
                F.coalesce(F.get(F.col("_labels_now"), F.col("_i")), F.lit("")).alias("step"), "wage")
    )


def within_bounds(unit: Column, wage: Column) -> Column:
    low = T.lookup(unit, {u: float(b[0]) for u, b in X.WAGE_BOUNDS.items()})
    high = T.lookup(unit, {u: float(b[1]) for u, b in X.WAGE_BOUNDS.items()})
    return wage.between(low, high)


def finish_tables(rows: DataFrame, contracts: DataFrame, ident: str = "doc_id") -> DataFrame:
    """Monthly wages only, each once per document; undated rows take the contract's start."""
    monthly = rows.where(F.col("unit") == X.UNIT_MONTHLY)
    once = keep_first(monthly, [ident, "table_no", "grade", "step_no", "wage"], [F.col("line_no")])
    return (once.join(contracts.select(ident, F.col("valid_from").alias("_start")).hint("merge"), ident, "left")
            .withColumn("valid_from", F.coalesce("valid_from", "_start")).drop("_start"))


# ------------------------------------------------------------------- checks

def check_steps(df: DataFrame, keys: Sequence[str] = ("doc_id", "table_no", "grade"),
                step: str = "step_no", wage: str = "wage") -> DataFrame:
    """Remark on a wage lower than an earlier step of the same grade."""
    earlier = (Window.partitionBy(*keys).orderBy(step)
               .rowsBetween(Window.unboundedPreceding, -1))
    return dealt(df, keys).withColumn("remark", F.when(F.col(wage) < F.max(wage).over(earlier), X.STEP_REMARK).otherwise(""))


def valid_rates(df: DataFrame, date: str = "valid_from") -> DataFrame:
    return df.where((F.coalesce("remark", F.lit("")) == "") & F.col(date).isNotNull())


# ------------------------------------------------------------------ changes

def adjacent_change(df: DataFrame, keys: Sequence[str] = ("doc_id", "grade", "step_no"),
                    date: str = "valid_from", wage: str = "wage", row: str = "row_id") -> DataFrame:
    """Percent change between neighbouring dates of one grade and step.

    The table number plays no part; the last row written for a date wins.
    """
    one = df.groupBy(*keys, date).agg(F.max_by(wage, row).alias(wage))
    line = Window.partitionBy(*keys).orderBy(date)
    previous = F.lag(wage).over(line)
    return (
        dealt(one, keys).withColumn("from_date", F.lag(date).over(line)).withColumn("_before", previous)
        .where("_before > 0")
        .select(*keys, "from_date", F.col(date).alias("to_date"),
                ((F.col(wage) / F.col("_before") - 1) * 100).alias("change"))
    )


def rate_changes(changes: DataFrame, document: str = "doc_id", minimum: int = 3,
                 bounds: tuple[float, float] = X.RATE_CHANGE_PERCENT) -> DataFrame:
    """Median change per document and pair of dates, with spread and agreement."""
    kept = changes.where(F.col("change").between(*bounds))
    keys = [document, "from_date", "to_date"]
    spread = kept.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("measurements"), (F.max("change") - F.min("change")).alias("_spread"))
    return (
        spread.where(F.col("measurements") >= minimum)
        .join(grouped_median(kept, keys, "change", "_median").hint("merge"), keys)
        .select(*keys, T.round_places(F.col("_median")).alias("pct"),
                T.round_places(F.col("_spread")).alias("spread"),
                F.when(F.col("_spread") <= 0.5, 1).otherwise(0).alias("consistent"), "measurements")
    )
