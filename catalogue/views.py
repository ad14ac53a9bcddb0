"""Inputs of the registered queries, derived from the given tables.

Each view is one SQL text that both engines run: Spark over the parquet
tables, the checking engine as a leading common table expression.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

V_INCREASE = """
SELECT o_orderkey AS row_id,
       concat('u', CASE WHEN o_custkey % 2 = 0 THEN o_custkey % 30 ELSE 30 + CAST(floor(o_custkey / 3e0) AS bigint) END) AS union_key,
       o_orderpriority AS counterparty,
       CAST(date_trunc('month', o_orderdate) AS date) AS valid_from,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE ((o_orderkey % 12) + 4) * 0.25e0 END AS pct,
       CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 THEN 1000 * (o_orderkey % 20 + 1) END AS amount,
       CASE o_orderkey % 6 WHEN 0 THEN 'general' WHEN 1 THEN 'table' WHEN 2 THEN 'rates' WHEN 3 THEN 'floor' WHEN 4 THEN 'entry' ELSE 'unspecified' END AS basis,
       CASE WHEN o_orderkey % 10 < 7 THEN 'text' WHEN o_orderkey % 10 = 7 THEN 'corrected' WHEN o_orderkey % 10 = 8 THEN 'inferred' ELSE 'doubtful' END AS year_status
FROM {orders}
"""

V_TEXT = """
SELECT o_orderkey AS doc_id,
       concat('2. gr. Launahækkanir. Laun hækka um ', CAST(o_orderkey % 9 + 1 AS string), ',5% þann 1. ',
              CASE o_orderkey % 4 WHEN 0 THEN 'janúar' WHEN 1 THEN 'apríl' WHEN 2 THEN 'júní' ELSE 'september' END, ' ',
              CAST(year(o_orderdate) AS string), '.') AS text,
       CAST(date_trunc('year', o_orderdate) AS date) AS validity_from,
       (o_orderkey % 9 + 1) + 0.5e0 AS true_pct,
       make_date(CAST(year(o_orderdate) AS int), CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 4 WHEN 2 THEN 6 ELSE 9 END, 1) AS true_date
FROM {orders}
"""

V_CONTRACT = """
SELECT o_orderkey AS contract_id,
       concat('u', CASE WHEN o_custkey % 2 = 0 THEN o_custkey % 30 ELSE 30 + CAST(floor(o_custkey / 3e0) AS bigint) END) AS union_key,
       o_orderpriority AS counterparty,
       CAST(o_orderdate AS date) AS fra,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderdate + INTERVAL '2' YEAR AS date) END AS til
FROM {orders}
"""

V_RATE = """
SELECT CAST(floor(p_partkey / 40e0) AS bigint) AS doc_id, s.step AS step_no, y.yr AS yr, make_date(CAST(y.yr AS int), 1, 1) AS valid_from,
       p_partkey AS grade,
       round(300000 + p_retailprice * 100 + s.step * 4000 * (CASE WHEN p_partkey % 97 = 0 THEN -1 ELSE 1 END)
             + (y.yr - 2020) * 12000, 0) AS wage
FROM {part} CROSS JOIN (VALUES (1),(2),(3)) AS s(step) CROSS JOIN (VALUES (2020),(2021),(2022)) AS y(yr)
"""

# v_increase with sector columns; a blank or own-site unknown counterparty occurs too
V_SECTOR = f"""
SELECT *, CASE row_id % 4 WHEN 0 THEN 'BSRB' WHEN 1 THEN 'ASÍ' WHEN 2 THEN NULL ELSE 'Sérfélög' END AS umbrella,
       CASE row_id % 3 WHEN 0 THEN 'opinber' WHEN 1 THEN 'almennur' END AS market,
       CASE WHEN row_id % 13 = 0 THEN '' ELSE counterparty END AS named_counterparty,
       CASE WHEN row_id % 17 = 0 THEN 1 ELSE 0 END AS own_site,
       concat('Félag ', union_key, CASE row_id % 3 WHEN 0 THEN ' stéttarfélag' ELSE '' END) AS union_name,
       concat(counterparty, CASE row_id % 5 WHEN 0 THEN ' hf.' ELSE ' samtök' END) AS counterparty_label,
       CASE row_id % 3 WHEN 0 THEN 'vefskjal' ELSE 'ríkissáttasemjari' END AS origin,
       concat('skjal-', CAST(row_id AS string)) AS doc
FROM ({V_INCREASE}) i
"""

V_MONTH_INDEX = """
SELECT m AS month, 100e0 + 0.6e0 * (row_number() OVER (ORDER BY m) - 1) AS value
FROM (SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS date) AS m FROM {lineitem}) t
"""

# the literal steps and years of v_rate, which Spark generates per row
LITERAL_ROWS = {
    "CROSS JOIN (VALUES (1),(2),(3)) AS s(step)": "LATERAL VIEW explode(array(1, 2, 3)) s AS step",
    "CROSS JOIN (VALUES (2020),(2021),(2022)) AS y(yr)": "LATERAL VIEW explode(array(2020, 2021, 2022)) y AS yr",
}

VIEWS = {
    "v_increase": (V_INCREASE, "orders"),
    "v_sector": (V_SECTOR, "orders"),
    "v_text": (V_TEXT, "orders"),
    "v_contract": (V_CONTRACT, "orders"),
    "v_rate": (V_RATE, "part"),
    "v_month_index": (V_MONTH_INDEX, "lineitem"),
}

# the basis values and trusted year states of v_increase
PRIORITY = ["general", "table", "rates", "floor", "entry", "unspecified"]
TRUSTED = ["text", "corrected", "inferred"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows over all shuffle partitions; the given tables are single small files, which one task reads.

    The number is named, or adaptive execution would join partitions by their bytes: a few megabytes of keys become texts that take minutes.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text, base = VIEWS[name]
    for fixed_rows, exploded in LITERAL_ROWS.items():
        text = text.replace(fixed_rows, exploded)
    return spark.sql(text, **{base: table(spark, sf_dir, base)})


def cte(*names: str) -> str:
    """``WITH a AS (…), b AS (…)`` for the checking engine."""
    parts = []
    for name in names:
        text, base = VIEWS[name]
        parts.append(f"{name} AS ({text.replace('{' + base + '}', base)})")
    return "WITH RECURSIVE " + ",\n".join(parts)


def iso(df: DataFrame) -> DataFrame:
    """Dates leave as ISO text, the form every output of the data set uses."""
    return df.select(*[
        F.col(f.name).cast("string").alias(f.name) if f.dataType.typeName() == "date" else F.col(f.name)
        for f in df.schema.fields
    ])
