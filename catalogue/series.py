"""Consensus, index, continuity: groups C7–C10, D1–D7, E1–E7."""
from __future__ import annotations

from pyspark.sql import functions as F

from rungline.operators import consensus as C
from rungline.operators import series as S

from .views import PRIORITY, TRUSTED, cte, iso, view

R2 = "CAST(round(CAST({} AS DECIMAL(28,8)), 2) AS DOUBLE)"
TRUSTED_SQL = "year_status IN ('text', 'corrected', 'inferred')"
RANK_SQL = "list_position(['general','table','rates','floor','entry','unspecified'], basis)"

# consensus points of the trusted rows
POINTS = f"""
t AS (SELECT *, {RANK_SQL} AS rk FROM v_increase WHERE {TRUSTED_SQL}),
b AS (SELECT *, min(rk) OVER (PARTITION BY union_key, counterparty, valid_from) AS best FROM t),
points AS (
  SELECT union_key, counterparty, valid_from,
         min(basis) FILTER (rk = best) AS basis,
         {R2.format("median(pct) FILTER (rk = best)")} AS pct,
         CAST(trunc(median(amount) FILTER (rk = best)) AS BIGINT) AS amount,
         count(*) AS sources,
         count(DISTINCT pct) FILTER (rk = best) AS distinct_pcts,
         min(row_id) AS first_row
  FROM b GROUP BY union_key, counterparty, valid_from)
"""
SIDE = """
side AS (
  SELECT *, CASE WHEN m >= 3 * sources AND m >= 3 THEN 0 ELSE 1 END AS in_chain
  FROM (SELECT *, max(sources) OVER (PARTITION BY union_key, counterparty ORDER BY valid_from
                  RANGE BETWEEN INTERVAL 100 DAYS PRECEDING AND INTERVAL 100 DAYS FOLLOWING) AS m
        FROM points) x)
"""
# rows of one (line, percent) in order; a kept row absorbs those within 90 days
TWINS = """
ord AS (SELECT *, row_number() OVER (PARTITION BY union_key, counterparty, pct ORDER BY valid_from) AS rn
        FROM side WHERE pct IS NOT NULL),
walk AS (
  SELECT union_key, counterparty, pct, rn, valid_from AS kept, true AS is_kept FROM ord WHERE rn = 1
  UNION ALL
  SELECT o.union_key, o.counterparty, o.pct, o.rn,
         CASE WHEN date_diff('day', w.kept, o.valid_from) <= 90 THEN w.kept ELSE o.valid_from END,
         date_diff('day', w.kept, o.valid_from) > 90
  FROM walk w JOIN ord o ON o.union_key = w.union_key AND o.counterparty = w.counterparty
       AND o.pct = w.pct AND o.rn = w.rn + 1),
twins AS (
  SELECT w.union_key, w.counterparty, w.kept AS valid_from, w.pct,
         max(o.sources) AS sources,
         arg_max(o.basis, (o.sources, -o.rn)) AS basis,
         arg_max({'v': o.amount}, (o.sources, -o.rn)).v AS amount,
         max(o.in_chain) FILTER (w.is_kept) AS in_chain,
         max(o.distinct_pcts) FILTER (w.is_kept) AS distinct_pcts,
         max(o.first_row) FILTER (w.is_kept) AS first_row,
         count(*) - 1 AS merged
  FROM walk w JOIN ord o USING (union_key, counterparty, pct, rn)
  GROUP BY w.union_key, w.counterparty, w.kept, w.pct
  UNION ALL
  SELECT union_key, counterparty, valid_from, pct, sources, basis, amount, in_chain, distinct_pcts, first_row, 0
  FROM side WHERE pct IS NULL)
"""
CHAIN = f"""
numbered AS (
  SELECT *, row_number() OVER w AS rn,
         (year(valid_from) * 12 + month(valid_from))
           - lag(year(valid_from) * 12 + month(valid_from)) OVER w AS gap_months
  FROM twins WINDOW w AS (PARTITION BY union_key, counterparty ORDER BY valid_from)),
chain AS (
  SELECT *, {R2.format("100 * product(CASE WHEN rn > 1 AND in_chain = 1 AND pct IS NOT NULL THEN 1 + pct / 100 ELSE 1 END) OVER (PARTITION BY union_key, counterparty ORDER BY valid_from ROWS UNBOUNDED PRECEDING)")} AS "index",
         CASE WHEN rn = 1 THEN 'grunnur' WHEN in_chain = 0 THEN 'hliðarsamningur - ekki keðjað'
              WHEN pct IS NULL THEN 'krónutöluhækkun - vísitala stendur í stað'
              WHEN gap_months > 24 THEN 'löng eyða á undan' ELSE '' END AS note
  FROM numbered)
"""
CONT = f"""
cont0 AS (
  SELECT *, coalesce(gap_months > 18, false) AS brk FROM chain),
cont1 AS (
  SELECT *, coalesce(max(CASE WHEN brk THEN valid_from END) OVER w, min(valid_from) OVER w) AS stretch_from,
         CAST(count(*) FILTER (brk) OVER w AS BIGINT) AS older_gaps,
         max(valid_from) OVER w AS last_date
  FROM cont0 WINDOW w AS (PARTITION BY union_key, counterparty)),
cont2 AS (
  SELECT *, CASE WHEN valid_from >= stretch_from THEN 1 ELSE 0 END AS in_stretch,
         CAST(count(*) FILTER (valid_from >= stretch_from) OVER w AS BIGINT) AS stretch_points,
         CAST(year(last_date) - year(stretch_from) AS INTEGER) AS stretch_years,
         max("index") FILTER (valid_from = stretch_from) OVER w AS base
  FROM cont1 WINDOW w AS (PARTITION BY union_key, counterparty)),
series AS (
  SELECT *, CASE WHEN stretch_points < 3 THEN 'of fáir punktar' WHEN stretch_years >= 3 THEN 'samfelld' ELSE 'eyður' END AS grade,
         CASE WHEN in_stretch = 1 THEN {R2.format('"index" / base * 100')} END AS stretch_index
  FROM cont2)
"""
SERIES = ",\n".join([cte("v_increase"), POINTS, SIDE, TWINS, CHAIN, CONT])


def trusted(spark, sf):
    return C.trusted(view(spark, sf, "v_increase"), accepted=TRUSTED)


def points(spark, sf):
    return C.consensus(trusted(spark, sf), priority=PRIORITY)


def series(spark, sf):
    return S.build_series(points(spark, sf))


def q_trusted(spark, sf):
    return trusted(spark, sf).groupBy("year_status").agg(
        F.count(F.lit(1)).alias("n"), F.sum("row_id").alias("row_sum"))


def q_consensus(spark, sf):
    return iso(points(spark, sf))


def q_side(spark, sf):
    return iso(S.mark_side(points(spark, sf)).select(
        "union_key", "counterparty", "valid_from", "sources", "in_chain"))


def q_twins(spark, sf):
    merged = S.merge_twins(S.mark_side(points(spark, sf)))
    return iso(merged.select("union_key", "counterparty", "valid_from", "pct", "sources", "basis",
                             "amount", "in_chain", "merged"))


def q_chain(spark, sf):
    rows = S.chain_index(S.merge_twins(S.mark_side(points(spark, sf))))
    return iso(rows.select("union_key", "counterparty", "valid_from", "gap_months", "index", "note"))


def q_continuity(spark, sf):
    return iso(series(spark, sf).select(
        "union_key", "counterparty", "valid_from", "stretch_from", "older_gaps", "in_stretch",
        "stretch_points", "stretch_years", "grade"))


def q_series(spark, sf):
    return iso(series(spark, sf).select(
        "union_key", "counterparty", "valid_from", "basis", "pct", "amount", "sources",
        "distinct_pcts", "merged", "in_chain", "gap_months", "index", "note", "stretch_index"))


def q_lines(spark, sf):
    return iso(S.line_summary(series(spark, sf)).drop("first_row").withColumnRenamed("last_index", "final_index"))


SUMMARY = """
lines AS (
  SELECT union_key, counterparty, count(*) AS n_increases, min(valid_from) AS first_date,
         max(valid_from) AS last_date, any_value(stretch_from) AS stretch_from,
         any_value(stretch_years) AS stretch_years, any_value(stretch_points) AS stretch_points,
         any_value(older_gaps) AS older_gaps, arg_max("index", valid_from) AS final_index,
         arg_max(stretch_index, valid_from) FILTER (stretch_index IS NOT NULL) AS last_stretch_index,
         max(gap_months) AS longest_gap, any_value(grade) AS grade
  FROM series GROUP BY union_key, counterparty)
"""
TEXT_DATES = "* REPLACE (CAST(first_date AS VARCHAR) AS first_date, CAST(last_date AS VARCHAR) AS last_date, CAST(stretch_from AS VARCHAR) AS stretch_from)"

ENTRIES = {
    "trusted_rows": (q_trusted, cte("v_increase") + f"""
SELECT year_status, count(*) AS n, CAST(sum(row_id) AS BIGINT) AS row_sum
FROM v_increase WHERE {TRUSTED_SQL} GROUP BY year_status"""),
    "consensus_points": (q_consensus, ",\n".join([cte("v_increase"), POINTS]) + """
SELECT * REPLACE (CAST(valid_from AS VARCHAR) AS valid_from) FROM points"""),
    "side_agreements": (q_side, ",\n".join([cte("v_increase"), POINTS, SIDE]) + """
SELECT union_key, counterparty, CAST(valid_from AS VARCHAR) AS valid_from, sources, in_chain FROM side"""),
    "merged_twins": (q_twins, ",\n".join([cte("v_increase"), POINTS, SIDE, TWINS]) + """
SELECT union_key, counterparty, CAST(valid_from AS VARCHAR) AS valid_from, pct, sources, basis, amount,
       in_chain, CAST(merged AS INTEGER) AS merged FROM twins"""),
    "chained_index": (q_chain, ",\n".join([cte("v_increase"), POINTS, SIDE, TWINS, CHAIN]) + """
SELECT union_key, counterparty, CAST(valid_from AS VARCHAR) AS valid_from,
       CAST(gap_months AS INTEGER) AS gap_months, "index", note FROM chain"""),
    "continuity": (q_continuity, SERIES + """
SELECT union_key, counterparty, CAST(valid_from AS VARCHAR) AS valid_from,
       CAST(stretch_from AS VARCHAR) AS stretch_from, older_gaps, in_stretch, stretch_points, stretch_years, grade
FROM series"""),
    "full_series": (q_series, SERIES + """
SELECT union_key, counterparty, CAST(valid_from AS VARCHAR) AS valid_from, basis, pct, amount, sources,
       distinct_pcts, CAST(merged AS INTEGER) AS merged, in_chain, CAST(gap_months AS INTEGER) AS gap_months,
       "index", note, stretch_index FROM series"""),
    "line_summary": (q_lines, SERIES + "," + SUMMARY + f"SELECT {TEXT_DATES} FROM lines"),
}
