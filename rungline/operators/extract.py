"""Dated increases out of contract texts.

A date is an anchor: its increase stands in the 90 characters after it, or
else in the 90 before, never beyond the neighbouring date. Everything is a
column expression: the text is split at its dates, and since the pieces and
the dates alternate, the place of every date follows from their lengths. No
Python runs per row, and only the short surroundings of each date leave the
document.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions import text as T
from ..functions.years import plausible_window, resolve_within
from .ranking import keep_first

REACH = 90       # where the value may stand, on either side of its date
BEFORE = 290     # reach plus the 200 characters of context before it
AFTER = 210      # reach plus the 120 characters of context after it
CHUNK = 64       # matches handled together; as many on either side are at hand for their surroundings
NEAR = 320       # characters of a gap that can be anyone's surroundings, from either end
MARK = "\uffff"  # no character, by Unicode's rules


def matches(df: DataFrame, part: str, pattern: str) -> DataFrame:
    """The matches of a pattern in a text, ``CHUNK`` to a row, with the text around them.

    Replaces ``part`` by ``_local`` (the text near the row's matches, the middle of long gaps left out), ``_first`` (number of
    the first match), ``_found``, ``_gaps`` (the text before each match and after the last) and ``_ends`` (where each match ends in ``_local``).
    A text is gone through once; each row costs the same, however many matches the text has.
    """
    others = [c for c in df.columns if c != part]
    # the pattern runs once and marks its matches; a text that has the mark itself is gone through twice
    marked = F.when(~F.contains(F.col(part), F.lit(MARK)), F.split(F.regexp_replace(F.col(part), pattern, f"{MARK}$0{MARK}"), MARK, -1))
    df = T.with_values(df, _cut=marked)
    df = T.with_values(
        df.where("_cut is null or size(_cut) > 1"),
        _all=F.when(F.col("_cut").isNull(), F.regexp_extract_all(F.col(part), F.lit(pattern), F.lit(0))).otherwise(F.filter("_cut", lambda _, i: i % 2 == 1)),
        _between=F.when(F.col("_cut").isNull(), F.split(F.col(part), pattern, -1)).otherwise(F.filter("_cut", lambda _, i: i % 2 == 0)))
    short = F.transform("_between", lambda g: F.when(F.length(g) > 2 * NEAR, F.concat(F.left(g, F.lit(NEAR)), F.right(g, F.lit(NEAR)))).otherwise(g))
    df = T.with_values(df.where(F.size("_all") > 0).select(*others, "_all", short.alias("_s")), _short=F.col("_s"))
    count = F.size("_all")

    def chunk(c: Column) -> Column:
        first = c * CHUNK
        last = F.least(first + CHUNK, count)
        low, high = F.greatest(first - CHUNK, F.lit(0)), F.least(last + CHUNK, count)
        gaps, found = F.slice("_short", low + 1, high - low), F.slice("_all", low + 1, high - low)
        steps = F.zip_with(gaps, found, lambda g, m: F.concat(g, m))
        return F.struct(
            first.alias("_first"), F.concat(F.array_join(steps, ""), F.get("_short", high)).alias("_local"),
            F.slice("_all", first + 1, last - first).alias("_found"), F.slice("_short", first + 1, last - first + 1).alias("_gaps"),
            F.transform(steps, lambda x: F.length(x)).alias("_steps"), (first - low).alias("_skip"))

    chunks = F.transform(F.sequence(F.lit(0), F.floor((count - 1) / CHUNK).cast("int")), chunk)
    rows = df.select(*others, F.inline(chunks))
    ends = F.transform("_found", lambda _, i: F.aggregate(
        F.slice("_steps", F.lit(1), F.col("_skip") + i + 1), F.lit(0), lambda total, x: total + x))
    return T.with_values(rows, _ends=ends).drop("_steps", "_skip")


def date_anchors(docs: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """One row per date found in a text, in order, with its surroundings."""
    worth = F.contains(F.col(text), F.lit("%")) | F.col(text).rlike("(?iu)kr")
    parts = matches(docs.where(worth).select(*keep, F.col(text).alias("_part")), "_part", X.DATE_IN_TEXT)

    def anchor(date, i):
        end = F.get("_ends", i)
        start = end - F.length(date)
        before = F.least(start, F.lit(BEFORE))
        return F.struct(
            (F.col("_first") + i).alias("nr"), date.alias("date"),
            F.substring(F.col("_local"), start - before + 1, before).alias("before"),
            F.substring(F.col("_local"), end + 1, F.lit(AFTER)).alias("after"),
            F.least(F.length(F.get("_gaps", i)), F.lit(REACH)).alias("back"),
            F.least(F.length(F.get("_gaps", i + 1)), F.lit(REACH)).alias("forward"))

    return parts.select(*keep, F.inline(F.transform("_found", anchor)))


def _amount(window: Column) -> Column:
    low = F.lower(window)
    found = F.nullif(F.regexp_replace(F.regexp_extract(low, X.AMOUNT_IN_TEXT, 0), "[^0-9]", ""), F.lit("")).try_cast("bigint")
    return F.when(F.contains(low, F.lit("kr")), found)


def _percent(window: Column) -> Column:
    return F.when(F.contains(window, F.lit("%")), T.parse_percent(T.group_or_null(window, X.PERCENT_IN_TEXT, 1)))


def extract_increases(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text",
                      start: str = "validity_from", end: str = "validity_to") -> DataFrame:
    """Increases per document: date, year status, percent, amount, type, basis, quotation.

    ``keep`` names the columns that identify a document (and travel along);
    ``start`` and ``end`` its validity period, either may be NULL.
    """
    keep = list(keep)
    carried = list(dict.fromkeys([*keep, start, end]))
    dated = date_anchors(docs, carried, text)
    dated = T.with_values(dated, _forward=F.left("after", F.col("forward")), _backward=F.right("before", F.col("back")),
                          _last=F.right("before", F.lit(60)))
    dated = T.with_values(dated, _last_low=F.lower(T.squeeze_column("_last")))
    found = T.with_values(dated.where(~T.mentions(F.col("_last_low"), X.CONDITION_BEFORE_DATE)).drop("_last", "_last_low"),
                          _pct=_percent(F.col("_forward")), _amount=_amount(F.col("_forward")))
    ahead = F.col("_pct").isNotNull() | F.col("_amount").isNotNull()
    valued = T.with_values(
        found,
        pct=F.when(ahead, F.col("_pct")).otherwise(_percent(F.col("_backward"))),
        amount=F.when(ahead, F.col("_amount")).otherwise(_amount(F.col("_backward"))),
        # the span runs from the date over the forward reach, or from the
        # start of the backward reach to the end of the date
        _span_back=F.when(ahead, 0).otherwise(F.col("back")),
        _span_ahead=F.when(ahead, F.col("forward")).otherwise(0),
    ).where("pct is not null or amount is not null").drop("_forward", "_backward", "_pct", "_amount")

    def around(before: int, after: int) -> Column:
        return F.concat(F.right("before", F.col("_span_back") + before), F.col("date"), F.left("after", F.col("_span_ahead") + after))

    reach = F.least(F.length("before"), F.col("_span_back") + 150)
    preceding = F.left(F.right("before", reach), reach - F.col("_span_back"))
    in_context = T.with_values(valued, _raw=around(200, 120))
    in_context = T.with_values(in_context, _context=T.squeeze_column("_raw")).drop("_raw")
    in_context = T.with_values(in_context, _low=F.lower("_context")).where(
        T.mentions(F.col("_low"), X.WAGE_WORD) & T.mentions(F.col("_low"), X.CHANGE_WORD)
        & ~T.mentions(F.col("_low"), X.EXCLUDED_PAYMENT))
    # these lie within the context; two of them are worked out only where that has what can be found there
    windows = T.with_values(
        in_context, _near_raw=around(0, 40),
        _wide_raw=F.when(T.may_mention(F.col("_low"), X.ENTITLEMENT_SHARE), around(120, 40)),
        _preceding_raw=F.when(T.may_mention(F.col("_low"), X.PRECEDING_SURCHARGE), preceding))
    names = ("_near", "_wide", "_preceding")
    judged = T.with_values(windows, **{n: F.lower(T.squeeze_column(f"{n}_raw")) for n in names}).drop(*[f"{n}_raw" for n in names])

    def has(name: str, pattern: str) -> Column:
        return F.coalesce(T.mentions(F.col(name), pattern), F.lit(False))

    judged = judged.where(~has("_near", X.WAGE_LEVEL) & ~has("_near", X.FUND_FEE) & ~has("_wide", X.ENTITLEMENT_SHARE)
                          & ~has("_preceding", X.PRECEDING_SURCHARGE))
    return _finish(judged, keep, start, end)


def _finish(judged: DataFrame, keep: list[str], start: str, end: str) -> DataFrame:
    part = [F.regexp_extract("date", X.DATE_IN_TEXT, g) for g in (1, 2, 3)]
    low, high = X.EXTRACT_PERCENT
    earliest, latest = plausible_window(F.col(start), F.col(end))
    dated = T.with_values(judged, _day=part[0].cast("int"), _month=T.month_number(part[1]),
                          _year=F.nullif(part[2], F.lit("")).cast("int"), _earliest=earliest, _latest=latest)
    rows = (
        T.with_values(dated, _when=resolve_within(F.col("_day"), F.col("_month"), F.col("_year"),
                                                  F.col("_earliest"), F.col("_latest")))
        .where(F.col("_when.date").isNotNull())
        .withColumn("pct", F.when((F.col("pct") > low) & (F.col("pct") <= high), F.col("pct")))
        .withColumn("amount", F.when(F.col("amount").between(*X.EXTRACT_AMOUNT), F.col("amount")))
        .where("pct is not null or amount is not null")
        .select(
            *keep, F.col("_when.date").alias("valid_from"), F.col("_when.status").alias("year_status"),
            "pct", "amount",
            T.increase_type(F.col("pct"), F.col("amount"), F.col("_context"), F.col("_low")).alias("type"),
            T.classify_basis(F.col("_context"), F.col("_low")).alias("basis"),
            F.left("_context", F.lit(400)).alias("quotation"),
            F.col("nr").alias("_place"))
    )
    first = keep_first(rows, [*keep, "valid_from", "pct", "amount"], [F.col("_place")])
    return first.drop("_place")


def clamp_values(df: DataFrame, pct: str = "pct", amount: str = "amount") -> DataFrame:
    """Null out implausible values; a row without any value left is dropped."""
    low, high = X.EXTRACT_PERCENT
    return (
        df.withColumn(pct, F.when((F.col(pct) > low) & (F.col(pct) <= high), F.col(pct)))
        .withColumn(amount, F.when(F.col(amount).between(*X.EXTRACT_AMOUNT), F.col(amount)))
        .where(F.col(pct).isNotNull() | F.col(amount).isNotNull())
    )


# ------------------------------------------------------------- coverage profile

def profile_hits(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """A simpler matcher, to see how much there is to find: a dated percent in
    either order with a word for an increase nearby; distinct per document."""
    hits = None
    for pattern, groups in ((X.PROFILE_DATE_FIRST, (1, 2, 3, 4)), (X.PROFILE_PERCENT_FIRST, (2, 3, 4, 1))):
        def hit(match, i):
            end = F.get("_ends", i)
            start = F.greatest(end - F.length(match) - 160, F.lit(0))
            return F.struct(match.alias("match"),
                            F.substring(F.col("_local"), start + 1, end + 60 - start).alias("around"))

        texts = docs.where(F.contains(F.col(text), F.lit("%"))).select(*keep, F.col(text).alias("_text"))
        rows = (
            matches(texts, "_text", pattern)
            .select(*keep, F.explode(F.transform("_found", hit)).alias("_h"))
            .where(T.mentions(F.lower("_h.around"), X.PROFILE_WORD))
        )
        day, month, year, pct = [F.regexp_extract("_h.match", pattern, g) for g in groups]
        rows = rows.select(
            *keep, day.try_cast("int").alias("day"), T.lookup(F.lower(month), X.PROFILE_MONTHS).alias("month"),
            F.nullif(year, F.lit("")).try_cast("int").alias("year"), T.parse_percent(pct).alias("pct"))
        hits = rows if hits is None else hits.unionByName(rows)
    low, high = X.PROFILE_PERCENT
    return hits.where(
        F.col("year").between(*X.PROFILE_YEARS) & F.col("day").between(1, 31)
        & (F.col("pct") > low) & (F.col("pct") <= high)
    ).select(*keep, F.format_string("%04d-%02d-%02d", "year", "month", "day").alias("date"), "pct").distinct()


def decade(date: Column) -> Column:
    return F.when(date.isNotNull(), F.concat((F.floor(F.year(date) / 10) * 10).cast("string"), F.lit("s"))
                  ).otherwise(X.UNKNOWN)


def coverage(docs: DataFrame, hits: DataFrame, ident: str = "doc_id", date: str = "fra") -> DataFrame:
    """Documents with text, documents with a hit and hits, per decade of the contract."""
    per_doc = hits.groupBy(ident).agg(F.count(F.lit(1)).alias("_hits"))
    return (
        docs.where(T.not_blank(F.col("text"))).select(ident, decade(F.col(date)).alias("decade"))
        .join(per_doc, ident, "left").groupBy("decade")
        .agg(F.count(F.lit(1)).alias("documents"), F.count("_hits").alias("with_hit"),
             F.coalesce(F.sum("_hits"), F.lit(0)).alias("hits"))
    )


def top_unions(docs: DataFrame, hits: DataFrame, k: int = 15, ident: str = "doc_id",
               union: str = "union_key") -> DataFrame:
    return (
        hits.join(docs.select(ident, F.coalesce(T.blank_to_null(F.col(union)), F.lit(X.UNKNOWN)).alias(union)), ident)
        .groupBy(union).agg(F.count(F.lit(1)).alias("hits")).orderBy(F.desc("hits"), union).limit(k)
    )
