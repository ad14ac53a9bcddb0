"""Gaps, their context, reviewer input, corrections: C11, C12, C14, C15, C19, D14, E8, G2, I12–I15."""
from __future__ import annotations

from pyspark.sql import functions as F

from rungline.functions import text as T
from rungline.operators import review as V
from rungline.session import cut_lineage

from . import comparison as K
from . import lines as L
from . import series as Q
from .views import cte, iso, spread, table, view

RECENT, ENDING = "DATE '1998-01-01'", "DATE '1992-01-01'"
NAME = """CASE WHEN CAST(substr(union_key, 2) AS INT) % 2 = 0 THEN union_key ELSE concat('félag ', union_key) END"""


def main_rows(spark, sf):
    """Main-line series, kept for the several passes of a gap query."""
    return cut_lineage(K.main_series(spark, sf))


def gaps(main):
    last = main.groupBy("union_key").agg(F.max("valid_from").alias("last_date"))
    day = F.unix_date("gap_to")
    all_gaps = V.find_gaps(main, last, F.expr(RECENT), F.expr(ENDING))
    confirmed = all_gaps.where(day % 5 == 0).select("union_key", "gap_from", "gap_to")
    return V.find_gaps(main, last, F.expr(RECENT), F.expr(ENDING), confirmed)


def q_gaps(spark, sf):
    return iso(gaps(main_rows(spark, sf)).drop("own_pct"))


def q_gap_counts(spark, sf):
    return V.gap_counts(gaps(main_rows(spark, sf)))


def common(spark, sf):
    main = main_rows(spark, sf)
    return V.common_in_gap(cut_lineage(gaps(main)), main)


def q_common(spark, sf):
    return iso(common(spark, sf))


def q_common_text(spark, sf):
    return iso(V.describe_common(common(spark, sf)))


def q_contracts(spark, sf):
    """Names as the register has them: the holder in two spellings."""
    rows = view(spark, sf, "v_contract")
    # a union has many contracts: its name is written in both spellings once, by all tasks, and what the look-ups read several times is kept
    unions = spread(rows.select("union_key").distinct(), "union_key").withColumn("_name", F.expr(NAME))
    named = cut_lineage(unions.select(
        "union_key", T.normalize_union(F.concat("_name", F.lit(" stéttarfélag"))).alias("holder_norm"),
        F.lower(F.concat(F.lit("Stéttarfélagið "), "_name", F.lit(" ; "), "_name")).alias("holder_raw")))
    contracts = cut_lineage(rows.join(named.hint("merge"), rows["union_key"].eqNullSafe(named["union_key"]), "left")
                            .select("contract_id", "counterparty", "fra", "til", "holder_norm", "holder_raw"))
    main = main_rows(spark, sf)
    asked = cut_lineage(gaps(main).join(main.select("union_key", "main_counterparty").distinct(), "union_key")
                        .withColumn("union_norm", T.normalize_union(F.expr(NAME))))
    return iso(V.contracts_in_gap(asked, contracts).select("union_key", "gap_from", "gap_to", "rank", "contract_id"))


def gap_table(spark, sf):
    """A regenerated gap list with empty input columns: a union for every three customers, a gap per month with an order."""
    return table(spark, sf, "orders").select(
        F.concat(F.lit("u"), F.floor(F.col("o_custkey") / 3).cast("string")).alias("felag"),
        F.trunc("o_orderdate", "YEAR").cast("string").alias("eyda_fra"),
        F.trunc("o_orderdate", "MM").cast("string").alias("eyda_til"),
        *[F.lit("").alias(c) for c in V.FILL_IN]).distinct()


def filled(spark, sf):
    """Reviewer input: an order is one filled row; some rows are blank, and the gaps of some have moved by a month or two since."""
    moved = F.add_months(F.to_date("o_orderdate"), (F.col("o_orderkey") % 3).cast("int"))
    return table(spark, sf, "orders").select(
        F.concat(F.lit("u"), F.floor(F.col("o_custkey") / 3).cast("string")).alias("felag"),
        F.trunc("o_orderdate", "YEAR").cast("string").alias("eyda_fra"),
        F.trunc(moved, "MM").cast("string").alias("eyda_til"),
        F.lit("").alias("stada"),
        F.when(F.col("o_orderkey") % 3 != 0, F.to_date("o_orderdate").cast("string")).otherwise("").alias("dagsetning"),
        F.when(F.col("o_orderkey") % 3 == 1, "3,5%").otherwise("").alias("prosenta"),
        F.lit("").alias("kronur"), F.lit("").alias("a_vid"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey").cast("string")).otherwise("").alias("heimild"),
        F.lit(" ").alias("athugasemd"))


def applied(spark, sf):
    """A correction per order, up to three days after it."""
    return table(spark, sf, "orders").select(
        F.concat(F.lit("u"), F.floor(F.col("o_custkey") / 3).cast("string")).alias("felag"),
        F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 4).cast("int")).alias("gildir_fra"))


def q_carry(spark, sf):
    out = V.carry_over(gap_table(spark, sf), filled(spark, sf), applied(spark, sf))
    return out.select("felag", "eyda_fra", "eyda_til", "dagsetning", "prosenta", "heimild")


def q_upsert(spark, sf):
    rows = view(spark, sf, "v_increase").groupBy("union_key", "valid_from").agg(
        F.min("row_id").alias("row_id"), F.max("row_id").alias("last_row"))
    old = rows.where("last_row % 2 = 0").withColumn("source", F.lit("old"))
    new = rows.where("row_id % 3 = 0").withColumn("source", F.lit("new"))
    return iso(V.upsert(old, new, ["union_key", "valid_from"]))


REVIEW_SQL = """
SELECT o_orderkey AS row_id,
       CASE o_orderkey % 10 WHEN 0 THEN 'Rétt ' WHEN 1 THEN 'óvisst' WHEN 2 THEN 'vantar' ELSE '' END AS stada,
       CASE o_orderkey % 9 WHEN 0 THEN '' WHEN 1 THEN '2001-02-30' WHEN 2 THEN '1.5.2001'
            ELSE strftime_or_format END AS dagsetning,
       CASE o_orderkey % 8 WHEN 0 THEN '' WHEN 1 THEN 'x,5' WHEN 2 THEN '26' WHEN 3 THEN '3,25 %' WHEN 4 THEN '25'
            ELSE CAST(o_orderkey % 7 AS string) END AS prosenta,
       CASE o_orderkey % 6 WHEN 0 THEN '23.750' WHEN 1 THEN '400' WHEN 2 THEN '200.001' ELSE '' END AS kronur,
       CASE o_orderkey % 5 WHEN 0 THEN 'kauptaxtar' WHEN 1 THEN 'eitthvað' ELSE ' ' END AS a_vid,
       CASE WHEN o_orderkey % 23 = 0 THEN ' ' ELSE concat('Félag ', CAST(o_custkey AS string)) END AS felag
FROM orders
"""


def reviewed(spark, sf):
    text = REVIEW_SQL.replace("strftime_or_format", "date_format(o_orderdate, 'yyyy-MM-dd')").replace("FROM orders", "FROM {orders}")
    return spark.sql(text, orders=table(spark, sf, "orders"))


def q_validate(spark, sf):
    return V.validate_corrections(reviewed(spark, sf)).select("row_id", "state", "error", "pct", "amount", "basis")


def q_gate(spark, sf):
    """All or nothing: one set with errors, one without."""
    checked = V.validate_corrections(reviewed(spark, sf))
    none = V.accepted_corrections(checked).select("row_id", F.lit("with errors").alias("case"))
    clean = V.accepted_corrections(checked.where("state <> 'error'")).select("row_id", F.lit("clean").alias("case"))
    return none.unionByName(clean)


FORM_SQL = """
SELECT o_orderkey AS id,
       concat('Inngangur', chr(10), '### Félag', chr(10), chr(10), CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE concat('Félag ', CAST(o_custkey AS string)) END, chr(10),
              '### Eyða', chr(10), chr(10), 'FROM_ til TO_', chr(10),
              '### Óþekkt fyrirsögn', chr(10), 'annað', chr(10),
              '### Tegund', chr(10), chr(10), CASE WHEN o_orderkey % 4 = 0 THEN 'Engin hækkun á tímabilinu' ELSE 'Hækkun vantar' END, chr(10),
              '### Gildistaka', chr(10), chr(10), CASE WHEN o_orderkey % 7 = 0 THEN '2001-13-01' ELSE 'DAY_' END, chr(10),
              '### Prósenta', chr(10), chr(10), CASE o_orderkey % 5 WHEN 0 THEN '_No response_' WHEN 1 THEN '30%' ELSE '3,5 %' END, chr(10),
              '### Krónur', chr(10), chr(10), CASE o_orderkey % 3 WHEN 0 THEN '_No response_' WHEN 1 THEN '23.750 kr.' ELSE 'kr. 18.000' END, chr(10),
              '### Á við', chr(10), chr(10), '_No response_') AS body
FROM orders
"""
FORM_PARTS = {
    "spark": ("', date_format(date_trunc('YEAR', o_orderdate), 'yyyy-MM-dd'), '", "', date_format(date_trunc('YEAR', o_orderdate) + INTERVAL '180' DAY, 'yyyy-MM-dd'), '",
              "date_format(o_orderdate, 'yyyy-MM-dd')"),
    "duck": ("', strftime(date_trunc('year', o_orderdate), '%Y-%m-%d'), '", "', strftime(date_trunc('year', o_orderdate) + INTERVAL 180 DAY, '%Y-%m-%d'), '",
             "strftime(o_orderdate, '%Y-%m-%d')"),
}


def form_sql(engine):
    start, end, day = FORM_PARTS[engine]
    return FORM_SQL.replace("FROM_", start).replace("TO_", end).replace("'DAY_'", day)


def forms(spark, sf):
    bodies = spark.sql(form_sql("spark").replace("FROM orders", "FROM {orders}"), orders=spread(table(spark, sf, "orders"), "o_orderkey"))
    fields = T.parse_form(F.col("body"))
    parsed = T.with_values(bodies.select("id", "body"), f=fields)
    names = ["felag", "eyda", "tegund", "dagsetning", "prosenta", "kronur", "a_vid"]
    return parsed.select("id", *[F.try_element_at("f", F.lit(n)).alias(n) for n in names])


def q_forms(spark, sf):
    return forms(spark, sf)


def proposals(spark, sf):
    return V.validate_proposals(forms(spark, sf))


def q_proposals(spark, sf):
    return proposals(spark, sf).select("id", "kind", "gap_from", "gap_to", "error", "pct", "amount", "basis")


def q_approved(spark, sf):
    orders = table(spark, sf, "orders")
    good = proposals(spark, sf).where("error is null")
    decisions = orders.select(F.col("o_orderkey").alias("id"), F.expr(
        "CASE WHEN o_orderstatus = 'F' THEN 'samthykkt' ELSE 'hafnad' END").alias("decision"))
    done = orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("id"))
    # kept, as both parts read it: the forms are parsed once
    increases, none = V.split_proposals(cut_lineage(V.not_applied(V.approved(good, decisions), done)))
    return increases.unionByName(none).select("id", "kind")


def q_attach_main(spark, sf):
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("u"), (F.col("c_custkey") % 800).cast("string")).alias("union_key"))
    return V.attach_main(customers, L.main_lines(spark, sf), main="main_counterparty").select("c_custkey", "main_counterparty")


GAPS = f"""
mg AS (SELECT *, lag(valid_from) OVER w AS gap_from, lag(pct) OVER w AS p0, lag(amount) OVER w AS a0,
              (year(valid_from) * 12 + month(valid_from)) - lag(year(valid_from) * 12 + month(valid_from)) OVER w AS months
       FROM ms WINDOW w AS (PARTITION BY union_key ORDER BY valid_from)),
gaps AS (SELECT union_key, gap_from, valid_from AS gap_to, months, p0, a0, pct, amount FROM mg
         WHERE months > 18 AND valid_from >= {ENDING}
           AND union_key IN (SELECT union_key FROM ms GROUP BY union_key HAVING max(valid_from) >= {RECENT})
           AND date_diff('day', DATE '1970-01-01', valid_from) % 5 <> 0)
"""


def describe_sql(p, a):
    thousands = f"translate(format('{{:,}}', {a}), ',', '.')"
    return (f"coalesce(nullif(concat_ws(' / ', replace(printf('%.2f', {p}), '.', ',') || '%', {thousands} || ' kr'), ''), '-')")


SPANS = "CAST(gap_from AS VARCHAR) AS gap_from, CAST(gap_to AS VARCHAR) AS gap_to"
COMMON = """
others AS (
  SELECT g.union_key, gap_from, gap_to, r.valid_from AS agreed_date, r.pct, count(*) AS unions, min(r.first_row) AS f
  FROM gaps g JOIN ms r ON r.union_key <> g.union_key AND r.valid_from > gap_from AND r.valid_from <= gap_to AND r.pct IS NOT NULL
  GROUP BY ALL),
common AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY union_key, gap_from, gap_to ORDER BY unions DESC, f) AS rank FROM others)
           WHERE rank <= 4 AND unions >= 3)
"""
BASE = K.SM + "," + GAPS

CHECKED = """
r AS (SELECT *, lower(trim(stada)) AS st, trim(dagsetning) AS d,
             TRY_CAST(replace(nullif(regexp_replace(prosenta, '[% ]', '', 'g'), ''), ',', '.') AS DOUBLE) AS pct,
             TRY_CAST(nullif(regexp_replace(kronur, '[% .]', '', 'g'), '') AS BIGINT) AS amount,
             coalesce(nullif(trim(a_vid), ''), 'óskilgreint') AS basis FROM raw),
v AS (SELECT *, CASE
        WHEN (st = '' AND d = '') OR st IN ('rétt', 'rett', 'óvisst', 'ovisst', 'óvíst') THEN NULL
        WHEN d = '' THEN 'engin dagsetning'
        WHEN NOT regexp_matches(d, '^\\d{4}-\\d{2}-\\d{2}$') THEN 'dagsetning ekki á forminu ÁÁÁÁ-MM-DD'
        WHEN TRY_CAST(d AS DATE) IS NULL THEN 'ekki gild dagsetning'
        WHEN (nullif(regexp_replace(prosenta, '[% ]', '', 'g'), '') IS NOT NULL AND pct IS NULL)
          OR (nullif(regexp_replace(kronur, '[% ]', '', 'g'), '') IS NOT NULL AND amount IS NULL) THEN 'ólæsileg tala'
        WHEN pct IS NULL AND amount IS NULL THEN 'hvorki prósenta né krónutala'
        WHEN NOT (pct > 0 AND pct <= 25) THEN 'prósenta utan marka'
        WHEN NOT amount BETWEEN 500 AND 200000 THEN 'krónutala utan marka'
        WHEN basis NOT IN ('almenn laun', 'kauptaxtar', 'launatafla', 'lágmarkstekjur', 'byrjunarlaun', 'óskilgreint') THEN 'óþekkt viðmið'
        WHEN trim(felag) = '' THEN 'félag vantar' END AS error,
      (st = '' AND d = '') OR st IN ('rétt', 'rett', 'óvisst', 'ovisst', 'óvíst') AS skip FROM r),
checked AS (SELECT row_id, CASE WHEN skip THEN 'skip' WHEN error IS NOT NULL THEN 'error' ELSE 'ok' END AS state, error, pct, amount, basis FROM v)
"""
RAW = "WITH RECURSIVE raw AS (" + REVIEW_SQL.replace("strftime_or_format", "strftime(o_orderdate, '%Y-%m-%d')") + ")," + CHECKED

PROPOSED = """
f AS (SELECT o_orderkey AS id, o_orderstatus, o_orderpriority,
             CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE concat('Félag ', CAST(o_custkey AS VARCHAR)) END AS felag,
             concat(strftime(date_trunc('year', o_orderdate), '%Y-%m-%d'), ' til ', strftime(date_trunc('year', o_orderdate) + INTERVAL 180 DAY, '%Y-%m-%d')) AS eyda,
             CASE WHEN o_orderkey % 4 = 0 THEN 'Engin hækkun á tímabilinu' ELSE 'Hækkun vantar' END AS tegund,
             CASE WHEN o_orderkey % 7 = 0 THEN '2001-13-01' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS dagsetning,
             CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN '30%' ELSE '3,5 %' END AS prosenta,
             CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '23.750 kr.' ELSE 'kr. 18.000' END AS kronur, '' AS a_vid FROM orders),
pr AS (SELECT *, CASE WHEN o4 THEN 'engin' ELSE 'haekkun' END AS kind, substr(eyda, 1, 10) AS gap_from, substr(eyda, 16, 10) AS gap_to,
              CASE id % 5 WHEN 0 THEN NULL WHEN 1 THEN 30e0 ELSE 3.5e0 END AS pct, CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN 23750 ELSE 18000 END AS amount
       FROM (SELECT *, id % 4 = 0 AS o4 FROM f)),
props AS (SELECT *, CASE WHEN felag = '' THEN 'félag vantar' WHEN kind = 'engin' THEN NULL
             WHEN id % 7 = 0 THEN 'ekki gild dagsetning' WHEN NOT (dagsetning >= gap_from AND dagsetning < gap_to) THEN 'dagsetning utan eyðu'
             WHEN pct IS NULL AND amount IS NULL THEN 'hvorki prósenta né krónutala' WHEN pct > 25 THEN 'prósenta utan marka' END AS error FROM pr)
"""

ENTRIES = {
    "gap_list": (q_gaps, BASE + f"SELECT union_key, {SPANS}, CAST(months AS INTEGER) AS months, "
                 f"{describe_sql('p0', 'a0')} AS before, {describe_sql('pct', 'amount')} AS after FROM gaps"),
    "gap_counts": (q_gap_counts, BASE + "SELECT union_key, count(*) AS gaps FROM gaps GROUP BY union_key"),
    "common_in_gap": (q_common, BASE + "," + COMMON + f"""
SELECT union_key, {SPANS}, CAST(rank AS INTEGER) AS rank, CAST(agreed_date AS VARCHAR) AS agreed_date, pct, unions FROM common"""),
    "common_in_gap_text": (q_common_text, BASE + "," + COMMON + f"""
SELECT union_key, {SPANS}, string_agg(CAST(agreed_date AS VARCHAR) || ' ' || replace(printf('%.2f', pct), '.', ',') || '% (' || unions || ' félög)', '; ' ORDER BY rank) AS common
FROM common GROUP BY union_key, gap_from, gap_to"""),
    "contracts_in_gap": (q_contracts, BASE + f""",
c AS (SELECT *, {NAME} AS nm FROM v_contract),
g AS (SELECT g.*, {NAME} AS nm, main_counterparty FROM gaps g JOIN main USING (union_key)),
hit AS (SELECT g.union_key, gap_from, gap_to, contract_id, row_number() OVER (PARTITION BY g.union_key, gap_from, gap_to
               ORDER BY c.counterparty <> main_counterparty, NOT (fra BETWEEN gap_from AND gap_to), fra, contract_id) AS rank
        FROM g JOIN c ON length(g.nm) >= 3 AND (CASE WHEN length(g.nm) <= 4 THEN c.nm = g.nm OR c.nm = concat('félag ', g.nm) ELSE contains(c.nm, g.nm) END)
          AND fra <= gap_to AND (til IS NULL OR til >= gap_from))
SELECT union_key, {SPANS}, CAST(rank AS INTEGER) AS rank, contract_id FROM hit WHERE rank <= 3"""),
    "reviewer_carry_over": (q_carry, """
WITH g AS (SELECT DISTINCT concat('u', o_custkey // 3) AS felag, strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS eyda_fra,
                  strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS eyda_til FROM orders),
k AS (SELECT concat('u', o_custkey // 3) AS felag, strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS eyda_fra,
             strftime(date_trunc('month', CAST(o_orderdate AS DATE) + to_months(CAST(o_orderkey % 3 AS INTEGER))), '%Y-%m-%d') AS eyda_til,
             strftime(o_orderdate, '%Y-%m-%d') AS dagsetning,
             CASE WHEN o_orderkey % 3 = 1 THEN '3,5%' ELSE '' END AS prosenta, CAST(o_orderkey AS VARCHAR) AS heimild
      FROM orders WHERE o_orderkey % 3 <> 0),
a AS (SELECT DISTINCT concat('u', o_custkey // 3) AS felag, strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 4 AS INTEGER), '%Y-%m-%d') AS d FROM orders)
SELECT felag, eyda_fra, eyda_til, coalesce(dagsetning, '') AS dagsetning, coalesce(prosenta, '') AS prosenta, coalesce(heimild, '') AS heimild
FROM g LEFT JOIN k USING (felag, eyda_fra, eyda_til)
UNION ALL SELECT felag, eyda_fra, eyda_til, dagsetning, prosenta, heimild FROM k
WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.felag = k.felag AND g.eyda_fra = k.eyda_fra AND g.eyda_til = k.eyda_til)
  AND NOT EXISTS (SELECT 1 FROM a WHERE a.felag = k.felag AND a.d = k.dagsetning)"""),
    "upsert_corrections": (q_upsert, cte("v_increase") + """,
r AS (SELECT union_key, valid_from, min(row_id) AS row_id, max(row_id) AS last_row FROM v_increase GROUP BY ALL)
SELECT union_key, CAST(valid_from AS VARCHAR) AS valid_from, row_id, last_row, CASE WHEN row_id % 3 = 0 THEN 'new' ELSE 'old' END AS source
FROM r WHERE row_id % 3 = 0 OR last_row % 2 = 0"""),
    "correction_states": (q_validate, RAW + "SELECT * FROM checked"),
    "correction_gate": (q_gate, RAW + "SELECT row_id, 'clean' AS \"case\" FROM checked WHERE state = 'ok'"),
    "review_forms": (q_forms, "WITH " + PROPOSED.strip() + "SELECT id, felag, eyda, tegund, dagsetning, prosenta, kronur, a_vid FROM f"),
    "proposal_states": (q_proposals, "WITH " + PROPOSED.strip() + """
SELECT id, kind, gap_from, gap_to, error, pct, CAST(amount AS BIGINT) AS amount, 'óskilgreint' AS basis FROM props"""),
    "approved_proposals": (q_approved, "WITH " + PROPOSED.strip() + """
SELECT id, kind FROM props WHERE error IS NULL AND o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT'"""),
    "proposal_main_line": (q_attach_main, cte("v_sector") + "," + L.MAIN + """
SELECT c_custkey, coalesce(main_counterparty, '') AS main_counterparty FROM customer LEFT JOIN main ON union_key = concat('u', c_custkey % 800)"""),
}
