"""Step look-ups, rebasing and benchmark comparison: B9–B11, C13, C18, E15, E16, F2, J1–J3."""
from __future__ import annotations

from pyspark.sql import functions as F

from rungline.functions import fixed as X
from rungline.operators import compare as K

from . import lines as L
from . import series as Q
from .views import cte, iso, table, view

AT = "DATE '1998-06-15'"
LATE = "DATE '2001-03-10'"
NOW = "DATE '2000-05-20'"


def main_series(spark, sf):
    return L.with_main(spark, sf).where("is_main = 1")


def index(spark, sf):
    return view(spark, sf, "v_month_index")


def prices(spark, sf):
    """A second index on the same months, growing more slowly."""
    return index(spark, sf).select("month", (100 + (F.col("value") - 100) * 0.5).alias("value"))


def ids(df):
    """Every union; a reader may ask for fewer."""
    return df.select("union_key").distinct()


def asked(spark, sf):
    """The ids of a request: one per supplier, not all of which exist."""
    return table(spark, sf, "supplier").select(F.concat(F.lit("u"), (F.col("s_suppkey") * 13).cast("string")).alias("union_key"))


def q_as_of(spark, sf):
    """Index of each contract's line when the contract starts."""
    contracts = view(spark, sf, "v_contract")
    looked_up = K.as_of(Q.series(spark, sf), contracts, ["union_key", "counterparty"], "valid_from",
                        "index", "fra", "index_then")
    rows = contracts.join(looked_up, ["union_key", "counterparty", "fra"])
    return rows.select("contract_id", F.col("index_then"))


def q_rebase(spark, sf):
    rows = K.rebase_at(Q.series(spark, sf), ["union_key", "counterparty"], "valid_from", "index", F.expr(AT))
    return iso(rows.withColumn("rebased", F.round("rebased", 6)))


def q_dropped(spark, sf):
    return K.dropped_at(Q.series(spark, sf), ["union_key", "counterparty"], "valid_from", "index", F.expr(AT))


def q_year_end(spark, sf):
    rows = K.until_year_end(Q.points(spark, sf), F.expr(NOW))
    return rows.groupBy("union_key").agg(F.count(F.lit(1)).alias("n"), F.max("valid_from").cast("string").alias("last"))


def q_selected(spark, sf):
    points = Q.points(spark, sf)
    wanted = asked(spark, sf)
    found = K.select_ids(points, wanted).groupBy("union_key").agg(F.count(F.lit(1)).alias("n"))
    missing = K.unknown_ids(points, wanted).select("union_key", F.lit(None).cast("bigint").alias("n"))
    return found.unionByName(missing)


def q_default(spark, sf):
    return K.default_unions(L.unions(spark, sf), X.GRADE_CONTINUOUS).select("union_key", "n_increases")


def q_benchmark_member(spark, sf):
    both = index(spark, sf).withColumn("unit", F.lit("Vísitölugildi")).unionByName(
        index(spark, sf).select("month", (F.col("value") / 10).alias("value")).withColumn("unit", F.lit("Breyting")))
    return iso(K.benchmark(both, unit="Vísitölugildi").select("month", F.round("value", 6).alias("value")))


def q_benchmark_change(spark, sf):
    rows = K.benchmark_change(index(spark, sf), view(spark, sf, "v_contract").where("til is not null"), "fra", "til")
    return rows.select("contract_id", F.round("benchmark_ratio", 6).alias("benchmark_ratio"))


def q_benchmark_rebased(spark, sf):
    own = K.benchmark_rebased(index(spark, sf), F.expr(AT), F.expr(LATE))
    common = K.benchmark_rebased(index(spark, sf), F.expr(AT), F.expr(LATE), F.expr("DATE '1997-02-01'"))
    rows = own.withColumn("base", F.lit("first")).unionByName(common.withColumn("base", F.lit("common")))
    return iso(rows.withColumn("rebased", F.round("rebased", 6)))


def q_summary(spark, sf):
    return iso(K.benchmark_summary(main_series(spark, sf), index(spark, sf), F.expr(NOW)))


def q_real(spark, sf):
    return K.real_change(main_series(spark, sf), prices(spark, sf), F.expr(AT), F.expr(LATE))


def q_compare(spark, sf):
    rows = main_series(spark, sf)
    both = {"index": index(spark, sf), "prices": prices(spark, sf)}
    out = K.compare(rows, ids(rows), both, F.expr(NOW), F.expr(AT))
    return iso(out.withColumn("rebased", F.round("rebased", 6)))


def q_compare_single(spark, sf):
    rows = main_series(spark, sf)
    out = K.compare(rows, rows.where("union_key = 'u12'").select("union_key"), {"index": index(spark, sf)}, F.expr(NOW))
    return iso(out.withColumn("rebased", F.round("rebased", 6)))


MS = "ms AS (SELECT s.* FROM series s JOIN main USING (union_key) WHERE counterparty = main_counterparty)"
SM = L.SERIES_MAIN + "," + MS + ", " + cte("v_month_index", "v_contract").removeprefix("WITH RECURSIVE ")
PRICES = "prices AS (SELECT month, 100 + (value - 100) * 0.5e0 AS value FROM v_month_index)"
R6 = "round({}, 6)"
KEY = "strftime({}, '%YM%m')"

ENTRIES = {
    "as_of_lookup": (q_as_of, Q.SERIES + "," + cte("v_contract").removeprefix("WITH RECURSIVE ") + """
SELECT contract_id, "index" AS index_then FROM v_contract c ASOF LEFT JOIN series s
  ON c.union_key = s.union_key AND c.counterparty = s.counterparty AND c.fra >= s.valid_from"""),
    "rebased_series": (q_rebase, Q.SERIES + f""",
base AS (SELECT union_key, counterparty, arg_max("index", valid_from) AS b FROM series WHERE valid_from <= {AT} GROUP BY ALL)
SELECT union_key, counterparty, CAST({AT} AS VARCHAR) AS valid_from, 100e0 AS rebased FROM base WHERE b > 0
UNION ALL SELECT union_key, counterparty, CAST(valid_from AS VARCHAR), {R6.format('"index" / b * 100')}
FROM series JOIN base USING (union_key, counterparty) WHERE valid_from > {AT} AND b > 0"""),
    "series_without_base": (q_dropped, Q.SERIES + f"""
SELECT DISTINCT union_key, counterparty FROM series EXCEPT SELECT union_key, counterparty FROM series WHERE valid_from <= {AT}"""),
    "until_year_end": (q_year_end, cte("v_increase") + "," + Q.POINTS + """
SELECT union_key, count(*) AS n, CAST(max(valid_from) AS VARCHAR) AS last FROM points WHERE valid_from <= DATE '2000-12-31' GROUP BY union_key"""),
    "selected_unions": (q_selected, cte("v_increase") + "," + Q.POINTS + """
SELECT concat('u', s_suppkey * 13) AS union_key, nullif(count(points.union_key), 0) AS n
FROM supplier LEFT JOIN points ON points.union_key = concat('u', s_suppkey * 13) GROUP BY ALL"""),
    "default_unions": (q_default, L.SERIES_MAIN + """
SELECT union_key, n_increases FROM unions WHERE grade = 'samfelld' ORDER BY n_increases DESC, union_key LIMIT 4"""),
    "benchmark_member": (q_benchmark_member, cte("v_month_index") + "SELECT CAST(month AS VARCHAR) AS month, round(value, 6) AS value FROM v_month_index"),
    "benchmark_change": (q_benchmark_change, cte("v_contract", "v_month_index") + f"""
SELECT contract_id, {R6.format('b.value / a.value * 100')} AS benchmark_ratio FROM v_contract
JOIN v_month_index a ON {KEY.format('a.month')} = {KEY.format('fra')} JOIN v_month_index b ON {KEY.format('b.month')} = {KEY.format('til')}"""),
    "benchmark_rebased": (q_benchmark_rebased, cte("v_month_index") + f""",
w AS (SELECT * FROM v_month_index WHERE {KEY.format('month')} BETWEEN '1998M06' AND '2001M03')
SELECT 'first' AS base, CAST(month AS VARCHAR) AS month, {R6.format('value / (SELECT arg_min(value, month) FROM w) * 100')} AS rebased FROM w
UNION ALL SELECT 'common', CAST(month AS VARCHAR), {R6.format("value / (SELECT arg_max(value, month) FROM v_month_index WHERE month <= DATE '1997-02-01') * 100")}
FROM w WHERE EXISTS (SELECT 1 FROM v_month_index WHERE month <= DATE '1997-02-01')"""),
    "union_vs_index": (q_summary, SM + f""",
pts AS (SELECT * FROM ms WHERE stretch_index IS NOT NULL AND valid_from <= DATE '2000-12-31'),
sp AS (SELECT union_key, count(*) AS points, min(valid_from) AS span_from, max(valid_from) AS last_date,
              arg_min(stretch_index, valid_from) AS f, arg_max(stretch_index, valid_from) AS l,
              least(max(valid_from), (SELECT max(month) FROM v_month_index)) AS span_to
       FROM pts GROUP BY union_key HAVING count(*) >= 2),
own AS (SELECT sp.union_key, arg_max(stretch_index, valid_from) AS v FROM sp JOIN pts USING (union_key) WHERE valid_from <= span_to GROUP BY sp.union_key),
bench AS (SELECT union_key, (SELECT arg_max(value, month) FROM v_month_index WHERE month <= span_from) AS m0,
             (SELECT arg_max(value, month) FROM v_month_index WHERE month <= span_to) AS m1 FROM sp)
SELECT union_key, CAST(span_from AS VARCHAR) AS span_from, CAST(span_to AS VARCHAR) AS span_to, points,
       CAST(round(CAST(v / f * 100 - 100 AS DECIMAL(28,8)), 4) AS DOUBLE) AS own_change,
       CAST(round(CAST(m1 / m0 * 100 - 100 AS DECIMAL(28,8)), 4) AS DOUBLE) AS benchmark_change,
       CAST(round(CAST(l / f * 100 - 100 AS DECIMAL(28,8)), 4) AS DOUBLE) AS total_change,
       last_date > (SELECT max(month) FROM v_month_index) AS agreed_beyond
FROM sp LEFT JOIN own USING (union_key) LEFT JOIN bench USING (union_key)"""),
    "real_change": (q_real, SM + "," + PRICES + f""",
a AS (SELECT union_key, arg_max(stretch_index, valid_from) AS v0 FROM ms WHERE valid_from <= {AT} AND stretch_index IS NOT NULL GROUP BY union_key),
z AS (SELECT union_key, arg_max(stretch_index, valid_from) AS v1 FROM ms WHERE valid_from <= {LATE} AND stretch_index IS NOT NULL GROUP BY union_key),
p AS (SELECT (SELECT arg_max(value, month) FROM prices WHERE month <= {AT}) AS p0, (SELECT arg_max(value, month) FROM prices WHERE month <= {LATE}) AS p1)
SELECT union_key, CAST(round(CAST((v1 / v0 - 1) * 100 AS DECIMAL(28,8)), 4) AS DOUBLE) AS nominal_change,
       CAST(round(CAST((p1 / p0 - 1) * 100 AS DECIMAL(28,8)), 4) AS DOUBLE) AS price_change,
       CAST(round(CAST((v1 / v0 / (p1 / p0) - 1) * 100 AS DECIMAL(28,8)), 4) AS DOUBLE) AS real_change
FROM a JOIN z USING (union_key), p WHERE v0 > 0 AND p0 IS NOT NULL AND p1 IS NOT NULL"""),
    "compare_on_base_date": (q_compare, SM + "," + PRICES + f""",
pts AS (SELECT union_key, valid_from, stretch_index FROM ms WHERE stretch_index IS NOT NULL AND valid_from <= DATE '2000-12-31'),
ok AS (SELECT union_key, arg_max(stretch_index, valid_from) FILTER (valid_from <= {AT}) AS b FROM pts GROUP BY union_key HAVING count(*) > 1),
reb AS (SELECT union_key, {AT} AS d, 100e0 AS rebased FROM ok WHERE b > 0
        UNION ALL SELECT union_key, valid_from, {R6.format('stretch_index / b * 100')} FROM pts JOIN ok USING (union_key) WHERE b > 0 AND valid_from > {AT}),
full_lines AS (SELECT * FROM reb WHERE union_key IN (SELECT union_key FROM reb GROUP BY union_key HAVING count(*) > 1)),
marks AS (SELECT 'index' AS name, * FROM v_month_index UNION ALL SELECT 'prices', * FROM prices)
SELECT union_key AS name, 'union' AS kind, CAST(d AS VARCHAR) AS date, rebased FROM full_lines
UNION ALL SELECT name, 'benchmark', CAST(month AS VARCHAR),
  {R6.format(f"value / (SELECT arg_max(m.value, m.month) FROM marks m WHERE m.name = marks.name AND {KEY.format('m.month')} <= '1998M06') * 100")}
FROM marks WHERE {KEY.format('month')} BETWEEN '1998M06' AND (SELECT {KEY.format('max(d)')} FROM full_lines)"""),
    "compare_single_union": (q_compare_single, SM + f""",
pts AS (SELECT union_key, valid_from, stretch_index FROM ms WHERE stretch_index IS NOT NULL AND valid_from <= DATE '2000-12-31' AND union_key = 'u12'),
ok AS (SELECT * FROM pts WHERE (SELECT count(*) FROM pts) > 1),
w AS (SELECT * FROM v_month_index WHERE {KEY.format('month')} BETWEEN (SELECT {KEY.format('min(valid_from)')} FROM ok) AND (SELECT {KEY.format('max(valid_from)')} FROM ok))
SELECT union_key AS name, 'union' AS kind, CAST(valid_from AS VARCHAR) AS date, round(stretch_index, 6) AS rebased FROM ok
UNION ALL SELECT 'index', 'benchmark', CAST(month AS VARCHAR), {R6.format('value / (SELECT arg_min(value, month) FROM w) * 100')} FROM w"""),
}
