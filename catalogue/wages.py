"""Wage tables: D8, E9–E12, H18, B7, C17 input."""
from __future__ import annotations

from pyspark.sql import functions as F

from rungline.operators import ranking as R
from rungline.operators import rates as W

from .views import cte, iso, spread, table, view



def rates(spark, sf):
    return view(spark, sf, "v_rate").withColumn("row_id", F.col("grade") * 100 + F.col("step_no") * 10 + (F.col("yr") - 2020))


def q_steps(spark, sf):
    return iso(W.check_steps(rates(spark, sf), ("doc_id", "yr", "grade"), wage="wage").select(
        "doc_id", "yr", "grade", "step_no", "wage", "remark"))


def valid(spark, sf):
    return W.valid_rates(W.check_steps(rates(spark, sf), ("doc_id", "yr", "grade")))


def q_valid(spark, sf):
    return valid(spark, sf).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


def q_adjacent(spark, sf):
    rows = W.adjacent_change(valid(spark, sf))
    return iso(rows.withColumn("change", F.round("change", 6)))


def q_changes(spark, sf):
    return iso(W.rate_changes(W.adjacent_change(valid(spark, sf))))


def q_first(spark, sf):
    rows = view(spark, sf, "v_increase")
    return iso(R.keep_first(rows, ["union_key", "valid_from", "pct", "amount"], [F.col("row_id")]).select(
        "row_id", "union_key", "valid_from", "pct", "amount"))


def q_top(spark, sf):
    rows = view(spark, sf, "v_increase")
    return R.top_k(rows, ["counterparty"], [F.desc_nulls_last("amount"), F.col("row_id")], 3).select(
        "counterparty", "row_id", "amount")


# contract texts with wage tables, a block of lines per part: a date, a unit, a
# header with two steps, two grades, and then the same grades again for a
# second table that only the repetition shows
TABLE_TEXT = """
SELECT p_partkey AS doc_id,
  concat('Kjarasamningur nr. ', CAST(p_partkey AS string), chr(10),
    CASE WHEN p_partkey % 4 = 0 THEN '' ELSE concat('Gildir frá 1. apríl ', CAST(2001 + p_partkey % 20 AS string)) END, chr(10),
    CASE p_partkey % 3 WHEN 0 THEN 'Mánaðarlaun í dagvinnu' WHEN 1 THEN 'Yfirvinnukaup' ELSE '' END, chr(10),
    CASE WHEN p_partkey % 5 = 0 THEN 'ekkert' ELSE 'Starfsaldur   Byrjunarl.   Eftir 3 ár' END, chr(10), chr(10),
    'Launaflokkur 4   ', CAST(200 + p_partkey % 100 AS string), '.100  ', CAST(210 + p_partkey % 100 AS string), '.200', chr(10),
    '5 | ', CAST(220 + p_partkey % 100 AS string), '.300 | 4500000', chr(10),
    'lfl. 4  ', CAST(230 + p_partkey % 100 AS string), '.100,50  ', CAST(240 + p_partkey % 100 AS string), '.200', chr(10),
    'Almennur texti 12 um vinnutíma', chr(10),
    'Taflan tekur gildi 1.5.2030 eins og áður', chr(10), 'Launatafla 1.5.', CAST(2030 + p_partkey % 2 AS string), chr(10),
    '4  250.100 260.200', chr(10), '6  35.000', chr(10)) AS text
FROM part
"""


def scanned(spark, sf):
    docs = spark.sql(TABLE_TEXT.replace("FROM part", "FROM {part}"), part=spread(table(spark, sf, "part"), "p_partkey"))
    return W.scan_wage_tables(docs)


def q_scan(spark, sf):
    return iso(scanned(spark, sf).drop("line_no"))


def q_finish(spark, sf):
    starts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("doc_id"), F.make_date(F.lit(1999), F.lit(1), F.lit(1)).alias("valid_from"))
    return iso(W.finish_tables(scanned(spark, sf), starts).select("doc_id", "valid_from", "table_no", "grade", "step_no", "wage"))


SCANNED = """
WITH p AS (SELECT p_partkey AS doc_id, p_partkey % 100 AS k, CASE WHEN p_partkey % 4 <> 0 THEN concat(2001 + p_partkey % 20, '-04-01') END AS d0,
                  CASE p_partkey % 3 WHEN 0 THEN 'mánaðarlaun' WHEN 1 THEN 'yfirvinnukaup' END AS u0, p_partkey % 5 <> 0 AS hdr,
                  concat(2030 + p_partkey % 2, '-05-01') AS d1 FROM part),
b AS (SELECT *, (d0 IS NOT NULL)::INT + (u0 IS NOT NULL)::INT + hdr::INT AS base FROM p),
cells AS (
  SELECT doc_id, d0 AS valid_from, greatest(base, 1) AS t, u0, hdr, '4' AS grade, 1 AS step_no, (200 + k) * 1000 + 100.0 AS wage FROM b
  UNION ALL SELECT doc_id, d0, greatest(base, 1), u0, hdr, '4', 2, (210 + k) * 1000 + 200 FROM b
  UNION ALL SELECT doc_id, d0, greatest(base, 1), u0, hdr, '5', 1, (220 + k) * 1000 + 300 FROM b
  UNION ALL SELECT doc_id, d0, greatest(base, 1), u0, hdr, '5', 2, 4500000 FROM b
  UNION ALL SELECT doc_id, d0, base + 1, u0, hdr, '4', 1, (230 + k) * 1000 + 100.5 FROM b
  UNION ALL SELECT doc_id, d0, base + 1, u0, hdr, '4', 2, (240 + k) * 1000 + 200 FROM b
  UNION ALL SELECT doc_id, d1, base + 3, u0, hdr, '4', 1, 250100 FROM b
  UNION ALL SELECT doc_id, d1, base + 3, u0, hdr, '4', 2, 260200 FROM b),
scan AS (SELECT doc_id, valid_from, CAST(t AS INTEGER) AS table_no, coalesce(u0, 'mánaðarlaun') AS unit, grade, step_no,
                CASE WHEN NOT hdr THEN '' WHEN step_no = 1 THEN 'Byrjunarl.' ELSE 'Eftir 3 ár' END AS step, CAST(wage AS DOUBLE) AS wage
         FROM cells WHERE CASE coalesce(u0, 'mánaðarlaun') WHEN 'mánaðarlaun' THEN wage BETWEEN 15000 AND 3000000 ELSE wage BETWEEN 100 AND 40000 END)
"""
REMARK = "CASE WHEN wage < max(wage) OVER (PARTITION BY doc_id, yr, grade ORDER BY step_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 'lægra en fyrra þrep' ELSE '' END"
CHANGES = f"""
r AS (SELECT *, {REMARK} AS remark FROM v_rate),
l AS (SELECT doc_id, grade, step_no, valid_from, wage, lag(wage) OVER w AS w0, lag(valid_from) OVER w AS from_date
      FROM r WHERE remark = '' WINDOW w AS (PARTITION BY doc_id, grade, step_no ORDER BY valid_from)),
ch AS (SELECT doc_id, grade, step_no, from_date, valid_from AS to_date, (wage / w0 - 1) * 100 AS change FROM l WHERE w0 > 0)
"""

ENTRIES = {
    "step_check": (q_steps, cte("v_rate") + f"SELECT doc_id, yr, grade, step_no, wage, {REMARK} AS remark FROM v_rate"),
    "valid_rates": (q_valid, cte("v_rate") + f", r AS (SELECT *, {REMARK} AS remark FROM v_rate) SELECT doc_id, count(*) AS n FROM r WHERE remark = '' GROUP BY doc_id"),
    "adjacent_rate_change": (q_adjacent, cte("v_rate") + "," + CHANGES + """
SELECT doc_id, grade, step_no, CAST(from_date AS VARCHAR) AS from_date, CAST(to_date AS VARCHAR) AS to_date, round(change, 6) AS change FROM ch"""),
    "rate_changes": (q_changes, cte("v_rate") + "," + CHANGES + """
SELECT doc_id, CAST(from_date AS VARCHAR) AS from_date, CAST(to_date AS VARCHAR) AS to_date,
       CAST(round(CAST(median(change) AS DECIMAL(28,8)), 2) AS DOUBLE) AS pct, CAST(round(CAST(max(change) - min(change) AS DECIMAL(28,8)), 2) AS DOUBLE) AS spread,
       CASE WHEN max(change) - min(change) <= 0.5 THEN 1 ELSE 0 END AS consistent, count(*) AS measurements
FROM ch WHERE change BETWEEN -2 AND 25 GROUP BY ALL HAVING count(*) >= 3"""),
    "first_per_value": (q_first, cte("v_increase") + """
SELECT row_id, union_key, CAST(valid_from AS VARCHAR) AS valid_from, pct, amount FROM (
  SELECT *, row_number() OVER (PARTITION BY union_key, valid_from, pct, amount ORDER BY row_id) AS k FROM v_increase) WHERE k = 1"""),
    "top_amounts": (q_top, cte("v_increase") + """
SELECT counterparty, row_id, amount FROM (
  SELECT *, row_number() OVER (PARTITION BY counterparty ORDER BY amount DESC NULLS LAST, row_id) AS k FROM v_increase) WHERE k <= 3"""),
    "wage_table_scan": (q_scan, SCANNED + "SELECT * FROM scan"),
    "monthly_wage_rows": (q_finish, SCANNED + """
SELECT DISTINCT doc_id, coalesce(valid_from, '1999-01-01') AS valid_from, table_no, grade, step_no, wage FROM scan WHERE unit = 'mánaðarlaun'"""),
}
