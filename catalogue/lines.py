"""Main lines, company folding, federations, summaries: C8–C10, C14, D2–D7."""
from __future__ import annotations

from pyspark.sql import functions as F

from rungline.operators import consensus as C
from rungline.operators import series as S

from . import series as Q
from .views import PRIORITY, TRUSTED, cte, iso, view

AS_OF = "DATE '2005-06-30'"
LOOSE = ("4-NOT SPECIFIED", "5-LOW")
RULES = dict(unknown="5-LOW", public_order=["1-URGENT", "2-HIGH"],
             private_order=["3-MEDIUM"], other_order=["3-MEDIUM", "1-URGENT"])


def sector(spark, sf):
    return C.trusted(view(spark, sf, "v_sector"), accepted=TRUSTED)


def main_lines(spark, sf):
    return C.choose_main(sector(spark, sf), F.expr(AS_OF), **RULES)


MAIN = """
s AS (SELECT * FROM v_sector WHERE year_status IN ('text', 'corrected', 'inferred')),
cnt AS (SELECT union_key, counterparty, count(*) AS n, count(*) FILTER (valid_from >= DATE '1995-01-01') AS recent,
               min(row_id) AS first_row
        FROM s WHERE counterparty <> '5-LOW' GROUP BY ALL),
umb AS (SELECT union_key, umbrella FROM (
          SELECT union_key, umbrella, row_number() OVER (PARTITION BY union_key ORDER BY count(*) DESC, min(row_id)) AS k
          FROM s WHERE umbrella IS NOT NULL GROUP BY union_key, umbrella) WHERE k = 1),
mar AS (SELECT union_key, market FROM (
          SELECT union_key, market, row_number() OVER (PARTITION BY union_key ORDER BY count(*) DESC, min(row_id)) AS k
          FROM s WHERE market IS NOT NULL GROUP BY union_key, market) WHERE k = 1),
most AS (SELECT union_key, counterparty AS most FROM (
           SELECT *, row_number() OVER (PARTITION BY union_key ORDER BY recent DESC, n DESC, first_row) AS k FROM cnt) WHERE k = 1),
hs AS (SELECT union_key, bool_or(counterparty = '1-URGENT' AND n >= 3) AS u, bool_or(counterparty = '2-HIGH' AND n >= 3) AS h,
              bool_or(counterparty = '3-MEDIUM' AND n >= 3) AS m FROM cnt GROUP BY union_key),
main AS (
  SELECT a.union_key,
         coalesce(CASE WHEN umbrella IN ('BSRB', 'BHM', 'KÍ') OR (umbrella IS DISTINCT FROM 'ASÍ' AND market = 'opinber')
                       THEN CASE WHEN u THEN '1-URGENT' WHEN h THEN '2-HIGH' END
                       WHEN umbrella = 'ASÍ' THEN CASE WHEN m THEN '3-MEDIUM' END
                       ELSE CASE WHEN m THEN '3-MEDIUM' WHEN u THEN '1-URGENT' END END,
                  most, '5-LOW') AS main_counterparty
  FROM (SELECT DISTINCT union_key FROM s) a LEFT JOIN umb USING (union_key) LEFT JOIN mar USING (union_key)
       LEFT JOIN most USING (union_key) LEFT JOIN hs USING (union_key))
"""
GENERAL = """
general AS (
  SELECT counterparty, valid_from, pct, amount, count(DISTINCT union_key) AS unions FROM points
  WHERE counterparty NOT IN ('4-NOT SPECIFIED', '5-LOW') GROUP BY ALL HAVING count(DISTINCT union_key) >= 3)
"""


def same_sql(a, b):
    return (f"(abs(date_diff('day', {a}.valid_from, {b}.valid_from)) <= 31 AND CASE WHEN {a}.pct IS NOT NULL AND {b}.pct IS NOT NULL "
            f"THEN abs({a}.pct - {b}.pct) < 0.005 ELSE coalesce({a}.amount = {b}.amount AND {a}.amount <> 0, false) END)")


FOLD = f"""
pl AS (SELECT p.*, main_counterparty, min(first_row) OVER (PARTITION BY union_key, counterparty) AS line_row
       FROM points p JOIN main USING (union_key)),
mainrows AS (SELECT * FROM pl WHERE counterparty = main_counterparty),
loose AS (SELECT * FROM pl WHERE counterparty <> main_counterparty AND counterparty IN ('4-NOT SPECIFIED', '5-LOW')),
cand AS (SELECT * FROM loose l
         WHERE EXISTS (SELECT 1 FROM general g WHERE g.counterparty = l.main_counterparty AND {same_sql('g', 'l')})
           AND NOT EXISTS (SELECT 1 FROM mainrows a WHERE a.union_key = l.union_key
                           AND abs(date_diff('day', a.valid_from, l.valid_from)) <= 45)),
seq AS (SELECT union_key, first_row, valid_from,
               row_number() OVER (PARTITION BY union_key ORDER BY line_row, first_row) AS rn FROM cand),
greedy AS (
  SELECT union_key, rn, [valid_from] AS taken, [first_row] AS rows FROM seq WHERE rn = 1
  UNION ALL
  SELECT s.union_key, s.rn,
         CASE WHEN len(list_filter(g.taken, lambda d: abs(date_diff('day', d, s.valid_from)) <= 45)) > 0
              THEN g.taken ELSE list_append(g.taken, s.valid_from) END,
         CASE WHEN len(list_filter(g.taken, lambda d: abs(date_diff('day', d, s.valid_from)) <= 45)) > 0
              THEN g.rows ELSE list_append(g.rows, s.first_row) END
  FROM greedy g JOIN seq s ON s.union_key = g.union_key AND s.rn = g.rn + 1),
fillrow AS (SELECT unnest(arg_max(rows, rn)) AS first_row FROM greedy GROUP BY union_key),
targets AS (
  SELECT *, 0 AS is_fill, CAST(NULL AS VARCHAR) AS filled_from FROM mainrows
  UNION ALL BY NAME
  SELECT * REPLACE (main_counterparty AS counterparty), 1 AS is_fill, counterparty AS filled_from
  FROM loose WHERE first_row IN (SELECT first_row FROM fillrow)),
unfilled AS (SELECT * FROM loose WHERE first_row NOT IN (SELECT first_row FROM fillrow)),
hits AS (
  SELECT l.first_row, l.sources, arg_min(t.first_row, (t.is_fill, t.line_row, t.first_row)) AS target
  FROM unfilled l JOIN targets t ON t.union_key = l.union_key AND {same_sql('t', 'l')}
       AND (t.is_fill = 0 OR (t.line_row, t.first_row) < (l.line_row, l.first_row))
  GROUP BY ALL),
added AS (SELECT target, sum(sources) AS more FROM hits GROUP BY target),
folded AS (
  SELECT union_key, counterparty, valid_from, pct, amount, CAST(sources + coalesce(more, 0) AS BIGINT) AS sources, filled_from, first_row
  FROM targets t LEFT JOIN added a ON a.target = t.first_row
  UNION ALL BY NAME
  SELECT union_key, counterparty, valid_from, pct, amount, sources, CAST(NULL AS VARCHAR) AS filled_from, first_row
  FROM unfilled WHERE first_row NOT IN (SELECT first_row FROM hits)
  UNION ALL BY NAME
  SELECT union_key, counterparty, valid_from, pct, amount, sources, CAST(NULL AS VARCHAR) AS filled_from, first_row
  FROM pl WHERE counterparty <> main_counterparty AND counterparty NOT IN ('4-NOT SPECIFIED', '5-LOW'))
"""


def is_loose():
    return F.col("counterparty").isin(*LOOSE)


def general(points):
    return C.general_increases(points, excluded=is_loose())


def folded(spark, sf):
    return S.fold_company_lines(Q.points(spark, sf), main_lines(spark, sf), is_loose())


def members(df):
    number = F.substring("union_key", 2, 10).cast("int")
    return (df.select("union_key").distinct().where(number >= 3)
            .select(F.col("union_key").alias("member"),
                    F.concat(F.lit("u"), (number % 3).cast("string")).alias("federation"),
                    F.lit("1-URGENT").alias("counterparty")))


def q_general(spark, sf):
    return iso(general(Q.points(spark, sf)))


def q_main(spark, sf):
    return main_lines(spark, sf)


def q_assigned(spark, sf):
    rows = sector(spark, sf).drop("counterparty").withColumnRenamed("named_counterparty", "counterparty")
    return C.assign_line(rows, main_lines(spark, sf), unknown="5-LOW").select("row_id", "union_key", "counterparty")


def q_fold(spark, sf):
    return iso(folded(spark, sf).select("union_key", "counterparty", "valid_from", "pct", "amount",
                                        "sources", "filled_from"))


def q_inherit(spark, sf):
    points = Q.points(spark, sf)
    return iso(S.inherit(points, members(points)).select(
        "union_key", "counterparty", "valid_from", "pct", "amount", "sources", "inherited_from"))


def q_described(spark, sf):
    rows = C.consensus(sector(spark, sf), priority=PRIORITY, describe=("doc", "union_name"),
                       origin="origin", name="counterparty_label")
    return iso(rows.select("union_key", "counterparty", "valid_from", "basis", "sources", "doc", "union_name",
                           "counterparty_label", F.array_join("origins", ",").alias("origins")))


def q_names(spark, sf):
    return C.display_names(sector(spark, sf))


def with_main(spark, sf):
    rows = S.build_series(Q.points(spark, sf))
    return rows.join(main_lines(spark, sf), "union_key", "left").withColumn(
        "is_main", F.coalesce(F.col("counterparty") == F.col("main_counterparty"), F.lit(False)).cast("int"))


def unions(spark, sf):
    return S.union_summary(S.line_summary(S.build_series(Q.points(spark, sf))), main_lines(spark, sf))


def q_unions(spark, sf):
    return iso(unions(spark, sf).withColumnRenamed("last_index", "final_index"))


def confirmed_gaps(points):
    """Every third gap over 18 months, by day of its end, taken as reviewed;
    one half of them for the main line only (blank counterparty)."""
    from pyspark.sql import Window
    line = Window.partitionBy("union_key", "counterparty").orderBy("valid_from")
    day = F.unix_date("valid_from")
    return (
        points.withColumn("gap_from", F.lag("valid_from").over(line))
        .where((F.months_between("valid_from", "gap_from") > 18) & (day % 3 == 0))
        .select("union_key", F.when(day % 2 == 0, "").otherwise(F.col("counterparty")).alias("counterparty"),
                "gap_from", F.col("valid_from").alias("gap_to"))
    )


def q_confirmed(spark, sf):
    points = Q.points(spark, sf).join(main_lines(spark, sf), "union_key").withColumn(
        "is_main", F.col("counterparty") == F.col("main_counterparty"))
    rows = S.continuity(S.with_confirmed(points, confirmed_gaps(points)), confirmed="gap_confirmed")
    return iso(rows.select("union_key", "counterparty", "valid_from", "gap_confirmed", "stretch_from",
                           "stretch_points", "older_gaps", "grade"))


P = cte("v_increase") + "," + Q.POINTS
UNIONS = """
seen AS (SELECT union_key, counterparty, min(first_row) AS seen FROM series GROUP BY ALL),
marked AS (SELECT l.*, coalesce(counterparty = main_counterparty, false) AS is_main, seen
           FROM lines l LEFT JOIN main USING (union_key) JOIN seen USING (union_key, counterparty)),
unions AS (
  SELECT union_key, counterparty AS main_line, first_date, last_date, n_increases, stretch_from, stretch_years,
         stretch_points, older_gaps, final_index, last_stretch_index, longest_gap, grade,
         n_lines, CAST(n_all AS BIGINT) AS n_increases_all
  FROM (SELECT *, row_number() OVER (PARTITION BY union_key ORDER BY is_main DESC, n_increases DESC, seen, counterparty DESC) AS k,
               count(*) OVER (PARTITION BY union_key) AS n_lines, sum(n_increases) OVER (PARTITION BY union_key) AS n_all
        FROM marked) WHERE k = 1)
"""
WITH_SECTOR = cte("v_increase", "v_sector")
SERIES_MAIN = ",\n".join([WITH_SECTOR, Q.POINTS, Q.SIDE, Q.TWINS, Q.CHAIN, Q.CONT, MAIN, Q.SUMMARY, UNIONS])

ENTRIES = {
    "general_increases": (q_general, P + "," + GENERAL + "SELECT * REPLACE (CAST(valid_from AS VARCHAR) AS valid_from) FROM general"),
    "main_counterparty": (q_main, cte("v_sector") + "," + MAIN + "SELECT union_key, main_counterparty FROM main"),
    "line_assignment": (q_assigned, cte("v_sector") + "," + MAIN + """
SELECT row_id, union_key, CASE WHEN named_counterparty = '' OR (named_counterparty = '5-LOW' AND own_site = 1)
                               THEN main_counterparty ELSE named_counterparty END AS counterparty
FROM s LEFT JOIN main USING (union_key)"""),
    "company_fold": (q_fold, ",".join([WITH_SECTOR, Q.POINTS, MAIN, GENERAL, FOLD]) + """
SELECT union_key, counterparty, CAST(valid_from AS VARCHAR) AS valid_from, pct, amount, sources, filled_from FROM folded"""),
    "federation_inheritance": (q_inherit, P + """,
mem AS (SELECT DISTINCT union_key AS member, concat('u', CAST(CAST(substr(union_key, 2) AS INT) % 3 AS VARCHAR)) AS federation
        FROM points WHERE CAST(substr(union_key, 2) AS INT) >= 3),
taken AS (SELECT member AS union_key, counterparty, valid_from, pct, amount, sources, federation AS inherited_from
          FROM mem JOIN points p ON p.union_key = federation AND counterparty = '1-URGENT'),
own AS (SELECT union_key, counterparty, valid_from, pct, amount, sources, CAST(NULL AS VARCHAR) AS inherited_from FROM points p
        WHERE NOT EXISTS (SELECT 1 FROM taken t WHERE t.union_key = p.union_key AND t.counterparty = p.counterparty
                          AND abs(date_diff('day', t.valid_from, p.valid_from)) <= 45))
SELECT * REPLACE (CAST(valid_from AS VARCHAR) AS valid_from) FROM (SELECT * FROM own UNION ALL SELECT * FROM taken)"""),
    "described_points": (q_described, cte("v_sector") + f""",
t AS (SELECT *, {Q.RANK_SQL} AS rk FROM v_sector WHERE {Q.TRUSTED_SQL}),
b AS (SELECT *, min(rk) OVER (PARTITION BY union_key, counterparty, valid_from) AS best FROM t),
lab AS (SELECT union_key, counterparty, valid_from, counterparty_label FROM (
          SELECT union_key, counterparty, valid_from, counterparty_label,
                 row_number() OVER (PARTITION BY union_key, counterparty, valid_from ORDER BY count(*) DESC, min(row_id)) AS k
          FROM t GROUP BY union_key, counterparty, valid_from, counterparty_label) WHERE k = 1)
SELECT union_key, counterparty, CAST(valid_from AS VARCHAR) AS valid_from, min(basis) FILTER (rk = best) AS basis,
       count(*) AS sources, arg_min(doc, row_id) FILTER (rk = best) AS doc,
       arg_min(union_name, row_id) FILTER (rk = best) AS union_name,
       any_value(lab.counterparty_label) AS counterparty_label,
       list_aggregate(list_sort(list(DISTINCT origin)), 'string_agg', ',') AS origins
FROM b JOIN lab USING (union_key, counterparty, valid_from) GROUP BY union_key, counterparty, valid_from"""),
    "display_names": (q_names, cte("v_sector") + f"""
SELECT union_key, union_name FROM (
  SELECT union_key, union_name, row_number() OVER (PARTITION BY union_key ORDER BY count(*) DESC, min(row_id)) AS k
  FROM v_sector WHERE {Q.TRUSTED_SQL} GROUP BY union_key, union_name) WHERE k = 1"""),
    "union_summary": (q_unions, SERIES_MAIN + f"SELECT {Q.TEXT_DATES} FROM unions"),
    "confirmed_gaps": (q_confirmed, ",".join([WITH_SECTOR, Q.POINTS, MAIN]) + """,
lagged AS (SELECT p.*, lag(valid_from) OVER w AS prev, counterparty = main_counterparty AS is_main,
                  (year(valid_from) * 12 + month(valid_from)) - lag(year(valid_from) * 12 + month(valid_from)) OVER w AS gap
           FROM points p JOIN main USING (union_key) WINDOW w AS (PARTITION BY union_key, counterparty ORDER BY valid_from)),
conf AS (SELECT DISTINCT union_key, CASE WHEN date_diff('day', DATE '1970-01-01', valid_from) % 2 = 0 THEN '' ELSE counterparty END AS cp,
                prev, valid_from FROM lagged WHERE gap > 18 AND date_diff('day', DATE '1970-01-01', valid_from) % 3 = 0),
flags AS (SELECT l.*, EXISTS (SELECT 1 FROM conf c WHERE c.union_key = l.union_key AND c.prev = l.prev AND c.valid_from = l.valid_from
                              AND (c.cp = l.counterparty OR (c.cp = '' AND l.is_main))) AS gap_confirmed FROM lagged l),
c1 AS (SELECT *, coalesce(gap > 18, false) AND NOT gap_confirmed AS brk FROM flags),
c2 AS (SELECT *, coalesce(max(CASE WHEN brk THEN valid_from END) OVER w, min(valid_from) OVER w) AS stretch_from,
              CAST(count(*) FILTER (brk) OVER w AS BIGINT) AS older_gaps, max(valid_from) OVER w AS last_date
       FROM c1 WINDOW w AS (PARTITION BY union_key, counterparty)),
c3 AS (SELECT *, CAST(count(*) FILTER (valid_from >= stretch_from) OVER (PARTITION BY union_key, counterparty) AS BIGINT) AS stretch_points FROM c2)
SELECT union_key, counterparty, CAST(valid_from AS VARCHAR) AS valid_from, gap_confirmed, CAST(stretch_from AS VARCHAR) AS stretch_from,
       stretch_points, older_gaps, CASE WHEN stretch_points < 3 THEN 'of fáir punktar'
            WHEN year(last_date) - year(stretch_from) >= 3 THEN 'samfelld' ELSE 'eyður' END AS grade FROM c3"""),
}
