"""Gap review: gaps with their context, corrections, proposals, upserts."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions import text as T
from .consensus import DATE
from .ranking import top_k

FILL_IN = ("stada", "dagsetning", "prosenta", "kronur", "a_vid", "heimild", "athugasemd")


def confirmed_key(confirmed: DataFrame, key: str = "union_key") -> DataFrame:
    return confirmed.select(key, "gap_from", "gap_to").distinct()


def find_gaps(main_series: DataFrame, unions: DataFrame, recent_from: Column,
              ending_from: Column, confirmed: DataFrame | None = None,
              months: int = X.GAP_MONTHS, key: str = "union_key", date: str = DATE) -> DataFrame:
    """Gaps of more than ``months`` on each union's main line.

    Unions must have data up to ``recent_from``; gaps must end on or after
    ``ending_from`` and not have been confirmed as real.
    """
    line = Window.partitionBy(key).orderBy(date)
    rows = (
        main_series
        .withColumn("gap_from", F.lag(date).over(line))
        .withColumn("_pct", F.lag("pct").over(line))
        .withColumn("_amount", F.lag("amount").over(line))
        .withColumn("months", T.month_gap(F.col("gap_from"), F.col(date)))
        .where((F.col("months") > months) & (F.col(date) >= ending_from))
        .select(key, "gap_from", F.col(date).alias("gap_to"), "months", F.col("pct").alias("_own_pct"),
                T.describe(F.col("_pct"), F.col("_amount")).alias("before"),
                T.describe(F.col("pct"), F.col("amount")).alias("after"))
    )
    recent = unions.where(F.col("last_date") >= recent_from).select(key)
    gaps = rows.join(recent, key, "left_semi")
    if confirmed is not None:
        gaps = gaps.join(confirmed_key(confirmed, key), [key, "gap_from", "gap_to"], "left_anti")
    return gaps.withColumnRenamed("_own_pct", "own_pct")


def gap_counts(gaps: DataFrame, key: str = "union_key") -> DataFrame:
    return gaps.groupBy(key).agg(F.count(F.lit(1)).alias("gaps"))


def common_in_gap(gaps: DataFrame, main_series: DataFrame, k: int = 4, minimum: int = 3,
                  key: str = "union_key", date: str = DATE, row: str = "first_row") -> DataFrame:
    """What other unions agreed in (gap_from, gap_to]: the top ``k`` values by count,
    of which those below ``minimum`` are then dropped.

    Main-line rows are first counted per (date, percent), a table the calendar
    bounds. Gaps with the same dates share their candidates; of the union's own
    rows only the one that ends the gap lies inside it, so taking it away can
    displace one candidate: ``k + 1`` are enough.
    """
    rows = main_series.where(F.coalesce(F.col("pct"), F.lit(0.0)) != 0.0)
    seen = top_k(rows.select(date, "pct", row), [date, "pct"], [F.col(row)], 2)
    totals = (
        rows.groupBy(date, "pct").agg(F.count(F.lit(1)).alias("n"))
        .join(seen.groupBy(date, "pct").agg(F.min(row).alias("_first"), F.max(row).alias("_second")),
              [date, "pct"])
        .withColumn("_month", F.trunc(date, "MM"))
    )
    spans = (
        gaps.select("gap_from", "gap_to").distinct()
        .withColumn("_month", F.explode(F.sequence(
            F.trunc("gap_from", "MM"), F.trunc("gap_to", "MM"), F.expr("interval 1 month"))))
    )
    inside = spans.join(totals, "_month").where(
        (F.col(date) > F.col("gap_from")) & (F.col(date) <= F.col("gap_to")))
    candidates = top_k(inside, ["gap_from", "gap_to"], [F.desc("n"), F.col("_first")], k + 1)
    own_rows = rows.select(key, F.col(date).alias("gap_to"), F.col(row).alias("_own_row"))
    per_gap = (
        gaps.select(key, "gap_from", "gap_to", "own_pct")
        .join(own_rows, [key, "gap_to"], "left")
        .join(candidates, ["gap_from", "gap_to"])
    )
    own = (F.col(date) == F.col("gap_to")) & F.coalesce(F.col("pct") == F.col("own_pct"), F.lit(False))
    counted = (
        per_gap.withColumn("n", F.when(own, F.col("n") - 1).otherwise(F.col("n")))
        .withColumn("_first", F.when(own & (F.col("_first") == F.col("_own_row")), F.col("_second"))
                    .otherwise(F.col("_first")))
        .where("n > 0")
    )
    order = Window.partitionBy(key, "gap_from", "gap_to").orderBy(F.desc("n"), "_first")
    return (
        counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .where(F.col("n") >= minimum)
        .select(key, "gap_from", "gap_to", "rank", F.col(date).alias("agreed_date"), "pct",
                F.col("n").alias("unions"))
    )


def describe_common(common: DataFrame, key: str = "union_key") -> DataFrame:
    """One text per gap: ``2025-01-01 3,50% (12 félög); …``."""
    text = F.concat(
        F.col("agreed_date").cast("string"), F.lit(" "),
        F.translate(F.format_number("pct", 2), ".", ","), F.lit("% ("),
        F.col("unions").cast("string"), F.lit(" félög)"))
    listed = F.array_sort(F.collect_list(F.struct("rank", text.alias("text"))))
    return common.groupBy(key, "gap_from", "gap_to").agg(
        F.array_join(F.transform(listed, lambda x: x["text"]), "; ").alias("common"))


# ------------------------------------------------------- contracts over a gap

def _grams(col: Column) -> Column:
    """All three-letter pieces, in their order."""
    size = F.greatest(F.length(col) - 2, F.lit(0))
    starts = F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.substring(col, i, F.lit(3)))


def names_in_texts(names: DataFrame, texts: DataFrame, name: str, fields: Sequence[str]) -> DataFrame:
    """Pairs (name, text row) where a field contains the name; up to four
    characters it must stand as a whole word.

    Both sides are first made distinct, and the fields' values are looked up once. A positional index holds each value's
    three-letter pieces with their places. A name is looked up by its two rarest pieces and their distance: values are asked only for
    the distances that names with the same rarest piece have, and a pair is formed only where both pieces stand as they do in the name. So a
    piece that a third of all values share meets distances, not names.
    """
    wanted = names.where(F.length(name) >= 3).select(name).distinct()
    whole = texts.select(*fields).distinct()
    values = whole.select(F.explode(F.array(*[F.col(f) for f in fields])).alias("_value")).where(F.length("_value") >= 3).distinct()
    index = values.select("_value", F.posexplode(_grams(F.col("_value"))).alias("_at", "_gram"))
    frequency = index.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    spelled = (
        wanted.select(name, F.posexplode(_grams(F.col(name))).alias("_place", "_gram")).join(frequency, "_gram")
        .groupBy(name).agg(F.slice(F.array_sort(F.collect_list(F.struct("_n", "_gram", "_place"))), 1, 2).alias("_two"), F.count(F.lit(1)).alias("_known"))
        # a piece that no value has: the name is nowhere
        .where(F.col("_known") == F.length(name) - 2)
    )
    first, second = F.col("_two")[0], F.element_at("_two", -1)
    asked = spelled.select(name, first["_gram"].alias("_gram"), first["_place"].alias("_place"), second["_gram"].alias("_other"),
                           (second["_place"] - first["_place"]).alias("_far"))
    near = index.join(asked.select("_gram", "_far").distinct(), "_gram").where(F.col("_at") + F.col("_far") >= 0).withColumn(
        "_other", F.substring(F.col("_value"), F.col("_at") + F.col("_far") + 1, F.lit(3)))
    word = F.concat(F.lit(r"(?U)(?<!\w)\Q"), F.col(name), F.lit(r"\E(?!\w)"))
    start = F.col("_at") - F.col("_place")
    here = (start >= 0) & (F.substring(F.col("_value"), start + 1, F.length(name)) == F.col(name))
    met = (near.join(asked, ["_gram", "_far", "_other"])
           .where(here & ((F.length(name) > 4) | F.rlike(F.col("_value"), word))).select(name, "_value").distinct())
    found = None
    for f in fields:
        some = whole.join(met, F.col(f) == F.col("_value")).select(name, *fields)
        found = some if found is None else found.unionByName(some)
    return found.distinct()


def contracts_in_gap(gaps: DataFrame, contracts: DataFrame, k: int = 3, key: str = "union_key",
                     name: str = "union_norm", fields: Sequence[str] = ("holder_norm", "holder_raw"),
                     counterparty: str = "counterparty", main: str = "main_counterparty",
                     row: str = "contract_id") -> DataFrame:
    """Up to ``k`` contracts of the union in force at some time in the gap.

    Same counterparty first, then those that start inside the gap, then by
    start date. Contracts that agree in everything the rule looks at are
    interchangeable, so at most ``k`` of each such kind are carried along.
    """
    kinds = [*fields, counterparty, "fra", "til"]
    dated = top_k(contracts.where(F.col("fra").isNotNull()), kinds, [F.col(row)], k)
    pairs = names_in_texts(gaps, contracts, name, fields)
    # contracts meet the gaps of their own years: a contract with an end is copied to each of its years, one without
    # to the year it starts in, where it meets the gaps that end in that year or later by their copies
    met = gaps.join(pairs, name)
    open_until = met.groupBy(*fields).agg(F.max(F.year("gap_to")).alias("_until"))
    held = dated.join(open_until, list(fields)).withColumn(
        "_end", F.least(F.greatest(F.coalesce(F.year("til"), F.col("_until")), F.year("fra")), F.col("_until"))).where(F.year("fra") <= F.col("_end"))
    held = held.withColumn("_year", F.explode(F.sequence(F.year("fra"), F.col("_end")))).drop("_until", "_end")
    spans = met.withColumn("_year", F.explode(F.sequence(F.year("gap_from"), F.year("gap_to"))))
    matched = (
        spans.join(held, [*fields, "_year"])
        .where((F.col("fra") <= F.col("gap_to")) & (F.col("til").isNull() | (F.col("til") >= F.col("gap_from"))))
        # a pair that shares several years counts in the first of them
        .where(F.col("_year") == F.greatest(F.year("gap_from"), F.year("fra")))
    )
    order = [F.col(counterparty) != F.col(main),
             ~F.col("fra").between(F.col("gap_from"), F.col("gap_to")), F.col("fra"), F.col(row)]
    in_year = top_k(matched, [key, "gap_from", "gap_to", "_year"], order, k)
    window = Window.partitionBy(key, "gap_from", "gap_to").orderBy(*order)
    return (in_year.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
            .select(key, "gap_from", "gap_to", "rank", row, "fra", "til", counterparty))


# ------------------------------------------------------- reviewer input

def carry_over(gaps: DataFrame, filled: DataFrame, corrections: DataFrame,
               keys: Sequence[str] = ("felag", "eyda_fra", "eyda_til"),
               inputs: Sequence[str] = FILL_IN) -> DataFrame:
    """Put earlier reviewer input on the regenerated gap list.

    Several inputs for one gap multiply its row. Input whose gap is gone is
    kept unless a correction for the same union and date was already applied.
    """
    keys, inputs = list(keys), list(inputs)
    written = None
    for c in inputs:
        here = T.not_blank(F.col(c))
        written = here if written is None else written | here
    kept = filled.where(F.coalesce(written, F.lit(False)))
    renamed = kept.select(*keys, *[F.col(c).alias("_in_" + c) for c in inputs], F.lit(True).alias("_hit"))
    current = gaps.drop(*inputs).join(renamed, keys, "left")
    for c in inputs:
        current = current.withColumn(c, F.when(F.col("_hit"), F.col("_in_" + c)).otherwise(F.lit("")))
    current = current.drop("_hit", *["_in_" + c for c in inputs])
    applied = corrections.select(keys[0], F.col("gildir_fra").cast("string").alias("_date")).distinct()
    orphans = (
        kept.join(gaps.select(*keys).distinct(), keys, "left_anti")
        .withColumn("_date", F.trim(F.coalesce("dagsetning", F.lit(""))))
        .join(applied, [keys[0], "_date"], "left_anti").drop("_date")
    )
    return current.unionByName(orphans, allowMissingColumns=True)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New rows replace old rows with the same key."""
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(
        new, allowMissingColumns=True)


def _values(currency: bool):
    return (T.parse_review_percent(F.col("prosenta")),
            T.parse_review_amount(F.col("kronur"), currency))


def _basis() -> Column:
    return F.coalesce(T.blank_to_null(F.trim("a_vid")), F.lit(X.BASIS_UNSPECIFIED))


def _range_checks(basis_ok: Sequence[str]) -> list[tuple[Column, str]]:
    low, high = X.REVIEW_PERCENT
    return [
        (T.unreadable(F.col("prosenta"), F.col("pct")) | T.unreadable(F.col("kronur"), F.col("amount")),
         "ólæsileg tala"),
        (F.col("pct").isNull() & F.col("amount").isNull(), "hvorki prósenta né krónutala"),
        (~((F.col("pct") > low) & (F.col("pct") <= high)), "prósenta utan marka"),
        (~F.col("amount").between(*X.REVIEW_AMOUNT), "krónutala utan marka"),
        (~F.col("basis").isin(*basis_ok), "óþekkt viðmið"),
    ]


def _first_error(checks: Sequence[tuple[Column, str]]) -> Column:
    return F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), m) for c, m in checks])


def validate_corrections(df: DataFrame, basis_ok: Sequence[str] = tuple(X.BASIS_PRIORITY)) -> DataFrame:
    """State of each reviewed row: ``skip``, ``error`` (with its reason) or ``ok``."""
    status = F.lower(F.trim(F.coalesce("stada", F.lit(""))))
    written = F.trim(F.coalesce("dagsetning", F.lit("")))
    iso = written.rlike(r"^\d{4}-\d{2}-\d{2}$")
    pct, amount = _values(currency=False)
    checked = (
        df.withColumn("pct", pct).withColumn("amount", amount).withColumn("basis", _basis())
        .withColumn("date", F.when(iso, written.try_cast("date")))
    )
    skip = ((status == "") & (written == "")) | status.isin(*X.REVIEW_SKIP_STATES)
    error = _first_error([
        (written == "", "engin dagsetning"),
        (~iso, "dagsetning ekki á forminu ÁÁÁÁ-MM-DD"),
        (F.col("date").isNull(), "ekki gild dagsetning"),
        *_range_checks(basis_ok),
        (~T.not_blank(F.coalesce("felag", F.lit(""))), "félag vantar"),
    ])
    return (checked.withColumn("error", F.when(~skip, error))
            .withColumn("state", F.when(skip, "skip").when(F.col("error").isNotNull(), "error").otherwise("ok")))


def accepted_corrections(validated: DataFrame) -> DataFrame:
    """The valid rows — or none at all when any row has an error."""
    errors = validated.agg(F.count_if(F.col("state") == "error")).scalar()
    return validated.where((F.col("state") == "ok") & (errors == 0))


def validate_proposals(forms: DataFrame, basis_ok: Sequence[str] = tuple(X.BASIS_PRIORITY)) -> DataFrame:
    """Proposals from parsed review forms; bad ones carry a reason, good ones go on."""
    days = F.regexp_extract_all(F.coalesce("eyda", F.lit("")), F.lit(r"(\d{4}-\d{2}-\d{2})"), F.lit(1))
    pct, amount = _values(currency=True)
    written = F.trim(F.coalesce("dagsetning", F.lit("")))
    # worked out once per row: copied into the checks, the patterns would be tried for each of them
    dated = T.with_values(forms, _days=days)
    rows = T.with_values(
        dated, gap_from=F.try_element_at("_days", F.lit(1)), gap_to=F.try_element_at("_days", F.lit(2)), pct=pct, amount=amount, basis=_basis(),
        kind=F.when(F.startswith(F.coalesce("tegund", F.lit("")), F.lit(X.FORM_NO_INCREASE)), X.PROPOSAL_NONE).otherwise(X.PROPOSAL_INCREASE),
        date=written).drop("_days")
    shape = _first_error([
        (F.col("gap_to").isNull(), "eyða þarf tvær dagsetningar"),
        (~T.not_blank(F.coalesce("felag", F.lit(""))), "félag vantar"),
    ])
    detail = _first_error([
        (~written.rlike(r"^\d{4}-\d{2}-\d{2}$") | written.try_cast("date").isNull(), "ekki gild dagsetning"),
        (~((written >= F.col("gap_from")) & (written < F.col("gap_to"))), "dagsetning utan eyðu"),
        *_range_checks(basis_ok),
    ])
    return rows.withColumn("error", F.coalesce(
        shape, F.when(F.col("kind") == X.PROPOSAL_INCREASE, detail)))


def approved(proposals: DataFrame, decisions: DataFrame, ident: str = "id") -> DataFrame:
    yes = decisions.where(F.col("decision") == X.APPROVED).select(ident).distinct()
    return proposals.join(yes.hint("merge"), ident, "left_semi")


def split_proposals(accepted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(corrections, confirmed gaps)."""
    return (accepted.where(F.col("kind") == X.PROPOSAL_INCREASE),
            accepted.where(F.col("kind") == X.PROPOSAL_NONE))


def not_applied(proposals: DataFrame, applied: DataFrame, ident: str = "id") -> DataFrame:
    return proposals.join(applied.select(ident).distinct().hint("merge"), ident, "left_anti")


def attach_main(df: DataFrame, unions: DataFrame, key: str = "union_key",
                main: str = "main_line") -> DataFrame:
    """The main counterparty of each row's union, blank where the union is unknown."""
    return (df.join(unions.select(key, F.col(main).alias("main_counterparty")), key, "left")
            .withColumn("main_counterparty", F.coalesce("main_counterparty", F.lit(""))))
