"""Outputs and the quality gate: A1, A6–A12, D12, D13, F1, I1–I11."""
from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from rungline import session
from rungline.operators import quality as G
from rungline.operators import ranking as R
from rungline.operators import series as S
from rungline.sources import sinks, tables

from . import comparison as K
from . import lines as L
from . import series as Q
from . import wages as W
from .views import cte, iso, table, view

COLUMNS = ["row_id", "union_key", "counterparty", "valid_from", "pct", "amount", "basis"]


def folder(spark, name):
    """A new place for written tables, in the folder the cluster shares."""
    return f"{session.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def q_csv(spark, sf):
    """Written as compressed CSV with a header in output order, read back as text, typed."""
    path = folder(spark, "increases")
    sinks.write_table(view(spark, sf, "v_increase"), path, COLUMNS, ["valid_from", "union_key", "row_id"], "csv", "gzip")
    text = tables.read_table(spark, path, COLUMNS)
    return tables.apply_types(text, ints=["row_id", "amount"], floats=["pct"])


def q_missing(spark, sf):
    """Tables that may be missing: one written from the given rows, one that was never written."""
    path = folder(spark, "orders")
    rows = view(spark, sf, "v_increase").select(*COLUMNS)
    sinks.write_table(rows, path, COLUMNS)
    there, missing = tables.read_table(spark, path, COLUMNS), tables.read_table(spark, path + "-none", COLUMNS)
    return there.unionByName(missing).groupBy("union_key").agg(F.count(F.lit(1)).alias("n"))


def q_years(spark, sf):
    """Year documents: every row in its place."""
    return iso(sinks.year_documents(view(spark, sf, "v_increase"), "valid_from", COLUMNS, "row_id", block=500))


def q_years_written(spark, sf):
    path = folder(spark, "years")
    sinks.write_by_year(view(spark, sf, "v_increase"), path, "valid_from", COLUMNS, "row_id")
    schema = "saeti bigint, row_id bigint, union_key string, counterparty string, valid_from string, pct double, amount int, basis string, ar string"
    counts = spark.read.schema("ar string, fjoldi bigint").json(f"{path}/fjoldi")
    return spark.read.schema(schema).json(f"{path}/haekkanir").join(counts, "ar")


def union_docs(spark, sf):
    series = session.cut_lineage(Q.series(spark, sf))
    lines = session.cut_lineage(S.line_summary(series))
    main = L.main_lines(spark, sf)
    unions = S.union_summary(lines, main)
    rates = W.W.rate_changes(W.W.adjacent_change(W.valid(spark, sf))).select(
        F.concat(F.lit("u"), F.col("doc_id").cast("string")).alias("union_key"), "from_date", "to_date")
    return sinks.union_documents(unions, lines, series, rates, ["valid_from", "pct", "index", "stretch_index"],
                                 ["n_increases", "grade"])


def q_union_documents(spark, sf):
    """Nested documents, opened again: each entry of each array in its place."""
    d = session.cut_lineage(union_docs(spark, sf))
    row = ["r.valid_from", "r.pct", "r.index", "r.stretch_index"]
    empty = [F.lit(None).cast(t).alias(n) for n, t in (("pct", "double"), ("index", "double"), ("stretch_index", "double"))]
    lines = d.select("union_key", F.posexplode("samningar").alias("line", "s")).select(
        "union_key", F.lit("samningar").alias("part"), "line", "s.counterparty", "s.n_increases", "s.grade", F.posexplode("s.haekkanir").alias("place", "r"))
    plain = [F.lit(None).cast(t).alias(n) for n, t in (("line", "int"), ("counterparty", "string"), ("n_increases", "bigint"), ("grade", "string"))]
    main = d.select("union_key", F.lit("haekkanir").alias("part"), *plain, F.posexplode("haekkanir").alias("place", "r"))
    changes = d.select("union_key", F.lit("taxtahaekkanir").alias("part"), *plain, F.posexplode("taxtahaekkanir").alias("place", "r")).select(
        "union_key", "part", "line", "counterparty", "n_increases", "grade", "place", F.col("r.to_date").alias("valid_from"), *empty,
        F.col("r.from_date").cast("string").alias("from_date"))
    named = ["union_key", "part", "line", "counterparty", "n_increases", "grade", "place"]
    opened = lines.unionByName(main).select(*named, *row).withColumn("from_date", F.lit(None).cast("string"))
    return iso(opened.unionByName(changes).withColumnRenamed("index", "index_value"))


def q_union_index(spark, sf):
    unions = L.unions(spark, sf).withColumn("order", F.substring("union_key", 2, 10).cast("bigint"))
    named = sinks.with_slugs(unions.withColumn("name", F.concat(F.lit("Félag Ö"), (F.col("order") % 40).cast("string"))), "name", "order", block=100)
    return sinks.union_index(named, "https://data.example/api").select("union_key", "slug", "slod", "n_increases")


def q_index_documents(spark, sf):
    both = K.index(spark, sf).withColumn("series", F.lit("wages")).unionByName(K.prices(spark, sf).withColumn("series", F.lit("prices")))
    d = sinks.index_documents(both)
    return d.select("heiti", "fjoldi", F.element_at("gildi", 1)["month"].cast("string").alias("first"),
                    F.round(F.element_at("gildi", -1)["value"], 6).alias("last_value"))


def q_manifest(spark, sf):
    series = session.cut_lineage(Q.series(spark, sf))
    lines = S.line_summary(series)
    rates = W.W.rate_changes(W.W.adjacent_change(W.valid(spark, sf)))
    return sinks.manifest(lines.select("union_key").distinct(), view(spark, sf, "v_increase"), series, lines, rates)


def q_order(spark, sf):
    """Output order of the series (main line first, then counterparty, then date),
    as each row's place within its union."""
    rows = L.with_main(spark, sf)
    order = Window.partitionBy("union_key").orderBy(F.desc("is_main"), "counterparty", "valid_from")
    placed = sinks.order_output(rows.withColumn("place", F.row_number().over(order)), ["union_key", "place"])
    return iso(placed.select("union_key", "is_main", "counterparty", "valid_from", "place"))


def q_upper_median(spark, sf):
    return R.upper_median(view(spark, sf, "v_increase"), "pct", "median")


def planted(spark, sf):
    rows = view(spark, sf, "v_increase")
    return rows.select(
        "row_id", "union_key", "counterparty",
        F.when(F.col("row_id") % 1000 == 1, F.lit("2031-05-01").cast("date")).when(F.col("row_id") % 1500 == 2, F.lit("1950-01-01").cast("date"))
        .otherwise(F.col("valid_from")).alias("valid_from"),
        F.when(F.col("row_id") % 500 == 0, 99.0).otherwise(F.col("pct")).alias("pct"),
        F.when(F.col("row_id") % 400 == 0, 300).otherwise(F.col("amount")).alias("amount"),
        F.when(F.col("row_id") % 700 != 0, "tilvitnun").otherwise(" ").alias("quotation"))


def checks(spark, sf):
    bad = planted(spark, sf)
    series = session.cut_lineage(L.with_main(spark, sf))
    unions = session.cut_lineage(S.union_summary(S.line_summary(series), L.main_lines(spark, sf)))
    doubled = series.unionByName(series.where("first_row % 50 = 0"))
    swapped = unions.withColumn("main_line", F.when(F.col("union_key").endswith("7"), "x").otherwise(F.col("main_line")))
    two_main = series.withColumn("is_main", F.when(F.col("union_key").endswith("3"), 1).otherwise(F.col("is_main")))
    no_main = series.withColumn("is_main", F.when(F.col("union_key").endswith("5"), 0).otherwise(F.col("is_main")))
    compared = G.over_ceiling(series.where("is_main = 1"), unions, K.index(spark, sf), F.expr("DATE '2000-07-01'"))
    date = lambda d: F.lit(d).cast("date")
    return [
        G.check_nonempty(bad, "increases exist"),
        G.check_nonempty(bad.where("row_id < 0"), "prices exist", G.WARNING),
        G.check_range(bad, "percent range", "pct", 0, 15, open_low=True),
        G.check_range(bad, "amount range", "amount", 500, 100_000),
        G.check_median(bad, "percent median", "pct", 2.0, 5.0),
        G.check_dates(bad, "future dates", high=date("2030-01-01")),
        G.check_dates(bad, "past dates", low=date("1960-01-01")),
        G.check_unique(series, "unique points"),
        G.check_unique(doubled, "unique points, planted"),
        G.check_single_main(two_main, "one main line"),
        G.check_has_main(no_main, "has main line"),
        G.check_main_reference(series, swapped, "main reference"),
        G.check_ceiling(compared, "ceiling"),
        G.check_not_blank(bad, "quotations", "quotation"),
    ]


def q_report(spark, sf):
    return G.quality_report(checks(spark, sf)).select("check", "passed", "severity", "violations", "message")


def q_overall(spark, sf):
    return G.overall(G.quality_report(checks(spark, sf)))


def q_ceiling(spark, sf):
    series = session.cut_lineage(L.with_main(spark, sf))
    unions = S.union_summary(S.line_summary(series), L.main_lines(spark, sf))
    rows = G.over_ceiling(series.where("is_main = 1"), unions, K.index(spark, sf), F.expr("DATE '2000-07-01'"))
    return iso(rows.withColumn("benchmark_index", F.round("benchmark_index", 6)))


SM = K.SM
CEILING = """
sp AS (SELECT union_key, stretch_from AS span_from, least(last_date, DATE '2000-07-01') AS span_to FROM unions WHERE grade = 'samfelld' AND stretch_from < least(last_date, DATE '2000-07-01')),
ow AS (SELECT sp.union_key, arg_max(stretch_index, valid_from) AS own_index FROM sp JOIN ms USING (union_key) WHERE valid_from <= span_to AND stretch_index IS NOT NULL GROUP BY sp.union_key),
ceil AS (SELECT sp.union_key, span_from, span_to, own_index, b.value / a.value * 100 AS benchmark_index, own_index > b.value / a.value * 100 * 1.02e0 AS over
         FROM sp JOIN ow USING (union_key) JOIN v_month_index a ON a.month = date_trunc('month', span_from) JOIN v_month_index b ON b.month = date_trunc('month', span_to))
"""
CHECKS = SM + "," + CEILING + """,
bad AS (SELECT row_id, CASE WHEN row_id % 1000 = 1 THEN DATE '2031-05-01' WHEN row_id % 1500 = 2 THEN DATE '1950-01-01' ELSE valid_from END AS valid_from,
               CASE WHEN row_id % 500 = 0 THEN 99 ELSE pct END AS pct, CASE WHEN row_id % 400 = 0 THEN 300 ELSE amount END AS amount FROM v_increase),
sm AS (SELECT s.*, counterparty = main_counterparty AS is_main FROM series s JOIN main USING (union_key)),
res AS (
  SELECT 'increases exist' AS "check", 'VILLA' AS severity, 0 AS violations
  UNION ALL SELECT 'prices exist', 'aðvörun', 1
  UNION ALL SELECT 'percent range', 'VILLA', count(*) FILTER (NOT (pct > 0 AND pct <= 15)) FROM bad
  UNION ALL SELECT 'amount range', 'VILLA', count(*) FILTER (NOT (amount BETWEEN 500 AND 100000)) FROM bad
  UNION ALL SELECT 'percent median', 'VILLA', CASE WHEN list_sort(list(pct) FILTER (pct IS NOT NULL))[count(pct) // 2 + 1] BETWEEN 2 AND 5 THEN 0 ELSE 1 END FROM bad
  UNION ALL SELECT 'future dates', 'VILLA', count(*) FILTER (valid_from > DATE '2030-01-01') FROM bad
  UNION ALL SELECT 'past dates', 'VILLA', count(*) FILTER (valid_from < DATE '1960-01-01') FROM bad
  UNION ALL SELECT 'unique points', 'VILLA', count(*) - count(DISTINCT (union_key, counterparty, valid_from)) FROM series
  UNION ALL SELECT 'unique points, planted', 'VILLA', count(*) FROM series WHERE first_row % 50 = 0
  UNION ALL SELECT 'one main line', 'VILLA', count(*) FROM (SELECT union_key FROM sm WHERE is_main OR union_key LIKE '%3' GROUP BY union_key HAVING count(DISTINCT counterparty) > 1)
  UNION ALL SELECT 'has main line', 'VILLA', count(*) FROM (SELECT union_key FROM sm GROUP BY union_key HAVING NOT bool_or(is_main AND union_key NOT LIKE '%5'))
  UNION ALL SELECT 'main reference', 'VILLA', count(DISTINCT union_key) FROM sm WHERE is_main AND union_key LIKE '%7'
  UNION ALL SELECT 'ceiling', 'VILLA', count(*) FILTER (over) FROM ceil
  UNION ALL SELECT 'quotations', 'VILLA', count(*) FILTER (row_id % 700 = 0) FROM bad)
"""

YEARS = """
SELECT CAST(year(valid_from) AS VARCHAR) AS ar, count(*) OVER (PARTITION BY year(valid_from)) AS fjoldi,
       row_number() OVER (PARTITION BY year(valid_from) ORDER BY row_id) AS saeti,
       row_id, union_key, counterparty, CAST(valid_from AS VARCHAR) AS valid_from, pct, amount, basis FROM v_increase"""

ENTRIES = {
    "csv_round_trip": (q_csv, cte("v_increase") + """
SELECT row_id, union_key, counterparty, CAST(valid_from AS VARCHAR) AS valid_from, pct, CAST(amount AS BIGINT) AS amount, basis FROM v_increase"""),
    "missing_table": (q_missing, cte("v_increase") + "SELECT union_key, count(*) AS n FROM v_increase GROUP BY ALL"),
    "year_documents": (q_years, cte("v_increase") + YEARS),
    "year_documents_written": (q_years_written, cte("v_increase") + YEARS),
    "union_documents": (q_union_documents, L.SERIES_MAIN + "," + cte("v_rate").removeprefix("WITH RECURSIVE ") + "," + W.CHANGES + """,
chg AS (SELECT concat('u', doc_id) AS union_key, from_date, to_date FROM ch WHERE change BETWEEN -2 AND 25 GROUP BY ALL HAVING count(*) >= 3),
rws AS (SELECT s.union_key, counterparty, valid_from, pct, "index" AS index_value, stretch_index, row_number() OVER (PARTITION BY s.union_key, counterparty ORDER BY valid_from) - 1 AS place,
               dense_rank() OVER (PARTITION BY s.union_key ORDER BY counterparty) - 1 AS line FROM series s)
SELECT union_key, 'samningar' AS part, CAST(line AS INTEGER) AS line, counterparty, l.n_increases, l.grade, CAST(place AS INTEGER) AS place,
       CAST(valid_from AS VARCHAR) AS valid_from, pct, index_value, stretch_index, CAST(NULL AS VARCHAR) AS from_date
FROM rws JOIN lines l USING (union_key, counterparty) WHERE union_key IN (SELECT union_key FROM unions)
UNION ALL SELECT union_key, 'haekkanir', NULL, NULL, NULL, NULL, CAST(place AS INTEGER), CAST(valid_from AS VARCHAR), pct, index_value, stretch_index, NULL
FROM rws JOIN unions u USING (union_key) WHERE counterparty = u.main_line
UNION ALL SELECT union_key, 'taxtahaekkanir', NULL, NULL, NULL, NULL, CAST(row_number() OVER (PARTITION BY union_key ORDER BY to_date, from_date) - 1 AS INTEGER),
       CAST(to_date AS VARCHAR), NULL, NULL, NULL, CAST(from_date AS VARCHAR) FROM chg WHERE union_key IN (SELECT union_key FROM unions)"""),
    "union_index": (q_union_index, L.SERIES_MAIN + """,
x AS (SELECT union_key, n_increases, CAST(substr(union_key, 2) AS INT) AS o FROM unions),
y AS (SELECT *, row_number() OVER (PARTITION BY o % 40 ORDER BY o) AS k FROM x),
z AS (SELECT *, concat('felag-o', o % 40, CASE WHEN k > 1 THEN concat('-', k) ELSE '' END) AS slug FROM y)
SELECT union_key, slug, concat('https://data.example/api/felog/', slug, '.json') AS slod, n_increases FROM z"""),
    "index_documents": (q_index_documents, cte("v_month_index") + "," + K.PRICES + """
SELECT 'wages' AS heiti, count(*) AS fjoldi, CAST(min(month) AS VARCHAR) AS first, round(arg_max(value, month), 6) AS last_value FROM v_month_index
UNION ALL SELECT 'prices', count(*), CAST(min(month) AS VARCHAR), round(arg_max(value, month), 6) FROM prices"""),
    "manifest": (q_manifest, Q.SERIES + "," + cte("v_rate").removeprefix("WITH RECURSIVE ") + "," + W.CHANGES + """
SELECT (SELECT count(*) FROM v_increase) AS haekkanir, (SELECT CAST(min(year(valid_from)) AS INTEGER) FROM v_increase) AS fyrsta_ar,
  (SELECT CAST(max(year(valid_from)) AS INTEGER) FROM v_increase) AS sidasta_ar, (SELECT count(DISTINCT union_key) FROM series) AS felog,
  (SELECT count(*) FROM series) AS maelipunktar, (SELECT count(DISTINCT (union_key, counterparty)) FROM series) AS samningslinur,
  (SELECT count(*) FROM (SELECT 1 FROM ch WHERE change BETWEEN -2 AND 25 GROUP BY doc_id, from_date, to_date HAVING count(*) >= 3)) AS taxtahaekkanir"""),
    "series_order": (q_order, L.SERIES_MAIN + """,
o AS (SELECT union_key, CASE WHEN counterparty = main_counterparty THEN 1 ELSE 0 END AS is_main, counterparty, valid_from FROM series LEFT JOIN main USING (union_key))
SELECT union_key, is_main, counterparty, CAST(valid_from AS VARCHAR) AS valid_from,
       CAST(row_number() OVER (PARTITION BY union_key ORDER BY is_main DESC, counterparty, o.valid_from) AS INTEGER) AS place FROM o"""),
    "upper_median": (q_upper_median, cte("v_increase") + """
SELECT list_sort(list(pct) FILTER (pct IS NOT NULL))[count(pct) // 2 + 1] AS median FROM v_increase"""),
    "ceiling_comparison": (q_ceiling, SM + "," + CEILING + """
SELECT union_key, CAST(span_from AS VARCHAR) AS span_from, CAST(span_to AS VARCHAR) AS span_to, own_index, round(benchmark_index, 6) AS benchmark_index, over FROM ceil"""),
    "quality_report": (q_report, CHECKS + """
SELECT "check", violations = 0 AS passed, severity, CAST(violations AS BIGINT) AS violations, CASE WHEN violations > 0 THEN concat(violations, ' frávik') ELSE '' END AS message FROM res"""),
    "quality_status": (q_overall, CHECKS + """
SELECT count(*) FILTER (violations > 0 AND severity = 'VILLA') AS errors, count(*) FILTER (violations > 0 AND severity <> 'VILLA') AS warnings,
  count(*) FILTER (violations > 0 AND severity = 'VILLA') = 0 AS passed FROM res"""),
}
