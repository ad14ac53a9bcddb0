"""Text operators and extraction: B2–B4, B12, D10, H1–H3, H9–H22, A13."""
from __future__ import annotations

from pyspark.sql import functions as F

from rungline.functions import fixed as X
from rungline.functions import text as T
from rungline.functions.years import resolve_year
from rungline.operators import extract as E
from rungline.sources import sinks, tables

from .views import cte, iso, spread, table, view

# contracts with one clause of a known kind each; what must be found follows from the key
MONTHS_IS = ["janúar", "febrúar", "mars", "apríl", "ágúst", "september", "október", "nóvember", "desember"]
MONTHS_NO = [1, 2, 3, 4, 8, 9, 10, 11, 12]
MONTH_TEXT = "CASE o_orderkey % 9 " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(MONTHS_IS)) + " END"
MONTH_NO = "CASE o_orderkey % 9 " + " ".join(f"WHEN {i} THEN {n}" for i, n in enumerate(MONTHS_NO)) + " END"
YEAR = "CAST(year(o_orderdate) AS string)"
PCT = "CAST(1 + o_orderkey % 14 AS string)"
CLAUSE = f"""
SELECT o_orderkey AS doc_id, o_custkey, CAST(o_orderdate AS date) AS signed, CAST(date_trunc('year', o_orderdate) AS date) AS validity_from,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(date_trunc('year', o_orderdate) + INTERVAL '2' YEAR AS date) END AS validity_to,
  o_orderkey % 11 AS kind, CAST(year(o_orderdate) AS int) AS yr, {MONTH_NO} AS mon, CAST(1 + o_orderkey % 14 AS double) + 0.25e0 AS p,
  concat('Kjarasamningur um kaup og kjör. Almennt ákvæði nr. ', CAST(o_orderkey AS string), ' um vinnutíma stendur óbreytt til frambúðar. ',
    'Næsta grein fjallar um aðbúnað á vinnustað og samstarf. Hún er óbreytt frá fyrri samningi aðila. ',
    CASE o_orderkey % 11
    WHEN 0 THEN concat('Laun hækka um ', {PCT}, ',25% þann 1. ', {MONTH_TEXT}, ' ', {YEAR}, '.')
    WHEN 1 THEN concat('Kauptaxtar hækka sem hér segir: 1. ', {MONTH_TEXT}, ' ', {YEAR}, ' ', {PCT}, ',25% eða 23.750 kr.')
    WHEN 2 THEN concat('Mánaðarlaun hækka að lágmarki þann 1. ', {MONTH_TEXT}, ' ', {YEAR}, ': ', {PCT}, ',25%, 18.000 kr.')
    WHEN 3 THEN concat('Launatafla hækkar frá 1. ', {MONTH_TEXT}, ' ', {YEAR}, ' um 15.000 kr.')
    WHEN 4 THEN concat('Iðgjald í lífeyrissjóð af launum hækkar um ', {PCT}, ',25% þann 1. ', {MONTH_TEXT}, ' ', {YEAR}, '.')
    WHEN 5 THEN concat('Laun skulu vera kr. 45.000 frá 1. ', {MONTH_TEXT}, ' ', {YEAR}, ' og hækka síðar.')
    WHEN 6 THEN concat('Laun starfsmanna sem hófu störf fyrir 1. ', {MONTH_TEXT}, ' ', {YEAR}, ' hækka um ', {PCT}, ',25%.')
    WHEN 7 THEN concat('Laun hækka um ', {PCT}, ',25% þann 1. ', {MONTH_TEXT}, '.')
    WHEN 8 THEN concat('Laun hækka um 33,25% eða 9.900 kr. þann 1. ', {MONTH_TEXT}, ' ', {YEAR}, '.')
    WHEN 9 THEN concat('Laun hækka um 33,25% þann 1. ', {MONTH_TEXT}, ' ', {YEAR}, '.')
    ELSE concat('Lágmarkslaun hækka um ', {PCT}, ',25% þann 30. febrúar ', {YEAR}, ', og almenn laun hækka um 2,75% hinn 1. ', {MONTH_TEXT}, ' ', {YEAR}, '.') END,
    CASE WHEN o_orderkey % 2 = 0 THEN concat(' ', 'Aðrar greinar samningsins standa óbreyttar út gildistíma hans og skulu endurskoðaðar. ',
         'Þá hafa aðilar sammælst um að skipa nefnd um framhaldið sem skilar áliti. Hún fundar eftir þörfum og kallar til gesti þegar svo ber undir og birtir fundargögn sín jafnóðum. Að auki var rætt um vinnutíma og fleira. ',
         'Áfangahækkanir: laun hækka um ', {PCT}, ',25% 1. ', {MONTH_TEXT}, ' ', {YEAR}) ELSE '' END) AS text
FROM orders
"""


def clauses(spark, sf):
    return spark.sql(CLAUSE.replace("FROM orders", "FROM {orders}"), orders=spread(table(spark, sf, "orders"), "o_orderkey"))


def q_extract(spark, sf):
    rows = E.extract_increases(clauses(spark, sf))
    return iso(rows.drop("quotation"))


def q_extract_single(spark, sf):
    docs = spread(view(spark, sf, "v_text"), "doc_id").withColumn("validity_to", F.lit(None).cast("date"))
    return iso(E.extract_increases(docs).select("doc_id", "valid_from", "pct", "year_status"))


def q_quotation(spark, sf):
    """Quotations hold whole words of their text around the increase."""
    rows = E.extract_increases(clauses(spark, sf))
    return rows.groupBy("type", "basis").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(T.not_blank(F.col("quotation"))).alias("quoted"))


def q_prefilter(spark, sf):
    """The extraction over the given documents, which hold no such contract clauses."""
    docs = spread(table(spark, sf, "documents"), "doc_id").select(
        "doc_id", "text", F.lit(None).cast("date").alias("validity_from"), F.lit(None).cast("date").alias("validity_to"))
    found = E.extract_increases(docs)
    anchors = E.date_anchors(docs, ["doc_id"])
    return found.agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit("increases")).unionByName(
        anchors.agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit("dates")))


def q_clamp(spark, sf):
    rows = view(spark, sf, "v_increase").select(
        "row_id", F.when(F.col("row_id") % 500 == 0, 99.0).otherwise(F.col("pct")).alias("pct"),
        F.when(F.col("row_id") % 300 == 0, 200).otherwise(F.col("amount")).alias("amount"))
    return E.clamp_values(rows)


def q_years(spark, sf):
    """Year resolution: years with one wrong digit, far-off years, none at all."""
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("d"), (F.col("o_orderkey") % 4).alias("k"))
    year = (F.when(F.col("k") == 0, F.year("d")).when(F.col("k") == 1, F.year("d") % 1000 + 5000)
            .when(F.col("k") == 2, F.lit(1871)))
    start = F.when(F.col("o_orderkey") % 7 != 0, F.date_sub("d", 30))
    end = F.when(F.col("o_orderkey") % 5 != 0, F.date_add("d", 30))
    r = resolve_year(F.dayofmonth("d"), F.month("d"), year, start, end)
    return iso(o.select("o_orderkey", r.alias("r")).where("r.date is not null")
               .select("o_orderkey", F.col("r.date").alias("date"), F.col("r.status").alias("status")))


WINDOWS = """
w0 AS (SELECT o_orderkey, d, k,
        CASE WHEN o_orderkey % 7 <> 0 THEN d - 430 END AS lo, CASE WHEN o_orderkey % 5 <> 0 THEN d + 430 END AS hi
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderkey % 4 AS k FROM orders)),
w AS (SELECT o_orderkey, d, k, coalesce(lo, make_date(year(hi)::INT - 8, 1, 1)) AS lo, coalesce(hi, make_date(year(lo)::INT + 6, 12, 31)) AS hi,
             CASE k WHEN 0 THEN year(d) WHEN 1 THEN year(d) % 1000 + 5000 WHEN 2 THEN 1871 END AS y FROM w0),
c AS (SELECT *, list_filter(list_transform(range(year(lo), year(hi) + 1), lambda v: TRY_CAST(format('{:04d}-{:02d}-{:02d}', v, month(d), day(d)) AS DATE)),
              lambda x: x IS NOT NULL AND x BETWEEN lo AND hi) AS fits FROM w WHERE lo IS NOT NULL OR hi IS NOT NULL OR true),
e AS (SELECT *, TRY_CAST(format('{:04d}-{:02d}-{:02d}', y, month(d), day(d)) AS DATE) AS written,
             list_filter(fits, lambda x: hamming(CAST(year(x) AS VARCHAR), CAST(y AS VARCHAR)) = 1) AS off FROM c)
"""


def q_parties(spark, sf):
    docs = table(spark, sf, "supplier").select(
        "s_suppkey",
        F.concat(F.lit("Kjarasamningur milli "), "s_name", F.lit(" annars vegar og Félags "), F.col("s_nationkey").cast("string"),
                 F.lit(" hins vegar um kaup. Samningur þessi gildir frá 1. mars 2001 til 30. nóvember "),
                 (2002 + F.col("s_suppkey") % 5).cast("string"), F.lit(".")).alias("long"),
        F.concat(F.lit("KJARASAMNINGUR\n\n"), "s_name", F.lit("\n\nog\n\nFélag "), F.col("s_nationkey").cast("string"), F.lit("\n")).alias("short"),
        F.concat(F.lit("skjal_"), (1990 + F.col("s_suppkey") % 9).cast("string"), F.lit("-2001.pdf")).alias("file"))
    text = F.when(F.col("s_suppkey") % 2 == 0, F.col("long")).otherwise(F.col("short"))
    p, v = T.extract_parties(text), T.extract_validity(text, F.col("file"))
    return iso(docs.select("s_suppkey", p["party_1"].alias("party_1"), p["party_2"].alias("party_2"),
                           v["valid_from"].alias("valid_from"), v["valid_to"].alias("valid_to")))


def q_contract_test(spark, sf):
    d = table(spark, sf, "documents")
    text = F.concat(F.when(F.col("doc_id") % 2 == 0, "Kjarasamningur. 2. gr. 1 Kauptaxtar, launatafla og gildistími. ").otherwise("Kauptaxtar. "), "text")
    name = F.concat(F.when(F.col("doc_id") % 5 == 0, "Ársskýrsla-").otherwise("samningur-"), F.col("doc_id").cast("string"))
    return d.select("doc_id", T.is_contract(name, text).alias("contract"), T.is_relevant(name).alias("relevant"))


def q_names(spark, sf):
    c = table(spark, sf, "customer")
    raw = F.concat(
        F.when(F.col("c_custkey") % 2 == 0, "Þjónustu- og Öryggis").otherwise("FÉLAG "), "c_mktsegment",
        F.expr("CASE c_custkey % 6 WHEN 0 THEN ' - skýring' WHEN 1 THEN ' (deild 3)' WHEN 2 THEN ' stéttarfélags' WHEN 3 THEN 'sambands' WHEN 4 THEN ' félags' ELSE ', hf.' END"))
    return c.select("c_custkey", T.normalize_union(raw).alias("norm"), T.slug(raw).alias("slug"),
                    T.union_key(F.when(F.col("c_custkey") % 4 != 0, raw),
                                F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey").cast("string"))).alias("key"))


NAME_SQL = """CASE WHEN c_custkey % 2 = 0 THEN 'Þjónustu- og Öryggis' ELSE 'FÉLAG ' END || c_mktsegment ||
 CASE c_custkey % 6 WHEN 0 THEN ' - skýring' WHEN 1 THEN ' (deild 3)' WHEN 2 THEN ' stéttarfélags' WHEN 3 THEN 'sambands' WHEN 4 THEN ' félags' ELSE ', hf.' END"""
NORM_SQL = r"""CASE WHEN c_custkey % 2 = 0 THEN 'þjónustu- og öryggis' ELSE 'félag ' END || lower(c_mktsegment) ||
 CASE c_custkey % 6 WHEN 3 THEN 'samband' WHEN 4 THEN ' félag' WHEN 5 THEN ' hf' ELSE '' END"""


def q_slugs(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    return sinks.with_slugs(parts, "p_name", "p_partkey", block=500).select("p_partkey", "slug")


def q_dates(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    words = F.expr("CASE month(d) " + " ".join(
        f"WHEN {i + 1} THEN '{m}'" for i, m in enumerate(
            ["jan", "febrúar", "MARS", "apríl", "maí", "júní", "JÚLÍ", "ágúst", "sept", "oktober", "nóv", "des"])) + " END")
    text = F.when(F.col("o_orderkey") % 2 == 0, F.concat(
        F.lit("undirritað "), F.dayofmonth("d").cast("string"), F.lit(". "), words, F.lit(". "), F.year("d").cast("string"))).otherwise(
        F.concat(F.lit("gildir "), F.date_format("d", "d.M.yyyy"), F.lit(" og áfram")))
    return iso(o.select("o_orderkey", T.parse_is_date(text).alias("date"), T.month_key(F.col("d")).alias("month_key")))


def q_numbers(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_discount")
    pct = F.regexp_replace(F.format_number(F.col("l_discount") * 10 + 1, 2), r"\.", ",")
    wage = F.translate(F.format_number("l_extendedprice", 2), ".,", ",.")
    amount = F.translate(F.format_number(F.floor("l_extendedprice"), 0), ",", ".")
    rows = li.select(
        "l_orderkey", "l_linenumber",
        T.parse_percent(pct).alias("pct"), T.parse_wage(wage).alias("wage"), T.parse_amount(amount).alias("amount"),
        T.parse_review_percent(F.concat(pct, F.lit(" %"))).alias("review_pct"),
        T.parse_review_amount(F.concat(F.lit("kr. "), amount), currency=True).alias("review_amount"),
        T.describe(F.when(F.col("l_quantity") > 10, F.col("l_quantity")), F.when(F.col("l_linenumber") > 1, F.floor("l_extendedprice"))).alias("described"),
        T.signed_percent(F.col("l_quantity") - 25).alias("signed"))
    return rows.distinct()


def q_basis(spark, sf):
    o = table(spark, sf, "orders")
    context = F.expr("""CASE o_orderkey % 7 WHEN 0 THEN 'KAUPTAXTAR og launatafla hækka' WHEN 1 THEN 'launaflokkar' WHEN 2 THEN 'lágmarkslaun hækka'
        WHEN 3 THEN 'byrjunarlaun' WHEN 4 THEN 'Öll laun' WHEN 5 THEN 'ÁLAG á dagvinnu' ELSE 'almennar launahækkanir, 3% eða 500 kr. að lágmarki' END""")
    pct = F.when(F.col("o_orderkey") % 2 == 0, 3.0)
    amount = F.when(F.col("o_orderkey") % 3 != 1, 500)
    return o.select("o_orderkey", T.classify_basis(context).alias("basis"),
                    T.increase_type(pct, amount, context).alias("type"),
                    T.manual_type(pct, amount).alias("manual_type"))


def profile_docs(spark, sf):
    return clauses(spark, sf).select("doc_id", "text", F.col("signed").alias("fra"),
                                     F.concat(F.lit("u"), (F.col("o_custkey") % 40).cast("string")).alias("union_key"))


def q_profile(spark, sf):
    return E.profile_hits(profile_docs(spark, sf))


def q_coverage(spark, sf):
    docs = profile_docs(spark, sf)
    return E.coverage(docs, E.profile_hits(docs))


def q_top_unions(spark, sf):
    docs = profile_docs(spark, sf)
    return E.top_unions(docs, E.profile_hits(docs))


def q_register(spark, sf):
    docs = table(spark, sf, "documents").withColumnRenamed("text", "ocr_text")
    return tables.register_summary(docs).select("doc_id", "source", "lang", "text_length")


C = "WITH c AS (" + CLAUSE + ")"
# what each kind of clause yields, and what the closing sentence of even keys adds
HITS = """
hit AS (
  SELECT doc_id, CASE WHEN kind = 10 THEN 2.75e0 WHEN kind IN (3, 8) THEN NULL ELSE p END AS pct,
         CASE kind WHEN 1 THEN 23750 WHEN 2 THEN 18000 WHEN 3 THEN 15000 WHEN 8 THEN 9900 END AS amount,
         CASE WHEN kind <> 7 THEN make_date(yr, mon, 1) WHEN mon = 12 THEN make_date(yr - 2, 12, 1) ELSE make_date(yr - 1, mon, 1) END AS d,
         CASE WHEN kind = 7 THEN 'ályktað (óvisst)' ELSE 'úr texta' END AS year_status,
         CASE kind WHEN 1 THEN 'prósenta eða krónutala' WHEN 2 THEN 'prósenta með krónutölulágmarki' WHEN 3 THEN 'krónutala'
              WHEN 8 THEN 'krónutala' ELSE 'prósenta' END AS type,
         CASE kind WHEN 1 THEN 'kauptaxtar' WHEN 3 THEN 'launatafla' WHEN 10 THEN 'lágmarkstekjur' ELSE 'almenn laun' END AS basis
  FROM c WHERE kind IN (0, 1, 2, 3, 7, 8, 10)
  UNION
  SELECT doc_id, p, NULL, make_date(yr, mon, 1), 'úr texta', 'prósenta', 'almenn laun' FROM c WHERE doc_id % 2 = 0)
"""
PROFILE = """
hits AS (
  SELECT doc_id, strftime(make_date(yr, mon, 1), '%Y-%m-%d') AS date, CASE kind WHEN 9 THEN 33.25e0 WHEN 10 THEN 2.75e0 ELSE p END AS pct
  FROM c WHERE kind IN (0, 1, 2, 4, 6, 9, 10)
  UNION SELECT doc_id, concat(yr, '-02-30'), p FROM c WHERE kind = 10
  UNION SELECT doc_id, strftime(make_date(yr, mon, 1), '%Y-%m-%d'), p FROM c WHERE doc_id % 2 = 0)
"""

ENTRIES = {
    "extract_from_documents": (q_prefilter, """
WITH found AS (SELECT unnest(regexp_extract_all(text, '(?i)\\d{1,2}\\s*\\.\\s*(?:dag[i]?\\s+)?(?:""" + "|".join(
        sorted(X.MONTHS, key=len, reverse=True)) + """)')) AS m FROM documents WHERE contains(text, '%') OR text ILIKE '%kr%')
SELECT 'dates' AS what, count(*) AS n FROM found UNION ALL SELECT 'increases', 0"""),
    "extract_increases": (q_extract, C + "," + HITS + """
SELECT doc_id, CAST(d AS VARCHAR) AS valid_from, year_status, pct, CAST(amount AS BIGINT) AS amount, type, basis FROM hit"""),
    "extract_true_values": (q_extract_single, cte("v_text") + """
SELECT doc_id, CAST(true_date AS VARCHAR) AS valid_from, true_pct AS pct, 'úr texta' AS year_status FROM v_text WHERE doc_id % 4 <> 2"""),
    "extract_types": (q_quotation, C + "," + HITS + "SELECT type, basis, count(*) AS n, count(*) AS quoted FROM hit GROUP BY type, basis"),
    "clamped_values": (q_clamp, cte("v_increase") + """,
r AS (SELECT row_id, CASE WHEN row_id % 500 = 0 THEN 99 ELSE pct END AS pct, CASE WHEN row_id % 300 = 0 THEN 200 ELSE amount END AS amount FROM v_increase),
k AS (SELECT row_id, CASE WHEN pct > 0 AND pct <= 15 THEN pct END AS pct, CASE WHEN amount BETWEEN 500 AND 100000 THEN amount END AS amount FROM r)
SELECT row_id, pct, CAST(amount AS BIGINT) AS amount FROM k WHERE pct IS NOT NULL OR amount IS NOT NULL"""),
    "year_resolution": (q_years, "WITH " + WINDOWS.strip() + """,
o AS (SELECT o_orderkey, CASE WHEN y IS NOT NULL AND (lo IS NULL OR written BETWEEN lo AND hi) THEN written
             WHEN y IS NOT NULL AND written IS NOT NULL AND len(off) = 1 THEN off[1] WHEN y IS NOT NULL THEN written ELSE fits[1] END AS date,
             CASE WHEN y IS NOT NULL AND (lo IS NULL OR written BETWEEN lo AND hi) THEN 'úr texta'
             WHEN y IS NOT NULL AND len(off) = 1 THEN 'leiðrétt' WHEN y IS NOT NULL THEN 'grunsamlegt'
             WHEN len(fits) = 1 THEN 'ályktað' ELSE 'ályktað (óvisst)' END AS status FROM e)
SELECT o_orderkey, CAST(date AS VARCHAR) AS date, status FROM o WHERE date IS NOT NULL"""),
    "contract_parties": (q_parties, """
SELECT s_suppkey, s_name AS party_1, concat(CASE WHEN s_suppkey % 2 = 0 THEN 'Félags ' ELSE 'Félag ' END, s_nationkey) AS party_2,
  CASE WHEN s_suppkey % 2 = 0 THEN '2001-03-01' ELSE concat(1990 + s_suppkey % 9, '-01-01') END AS valid_from,
  CASE WHEN s_suppkey % 2 = 0 THEN concat(2002 + s_suppkey % 5, '-11-30') ELSE '2001-12-31' END AS valid_to FROM supplier"""),
    "contract_test": (q_contract_test, """
SELECT doc_id, length(text) + CASE WHEN doc_id % 2 = 0 THEN 62 ELSE 12 END >= 500 AND doc_id % 5 <> 0
  AND len(regexp_extract_all(substr(concat(CASE WHEN doc_id % 2 = 0 THEN 'Kjarasamningur. 2. gr. 1 Kauptaxtar, launatafla og gildistími. ' ELSE 'Kauptaxtar. ' END, text), 1, 20000),
      '(?i)kjarasamning|samningur þessi|gildistími|\\bgr\\.\\s*\\d|kauptaxt|launatafl')) >= 3 AS contract,
  doc_id % 5 <> 0 AS relevant FROM documents"""),
    "union_names": (q_names, f"""
SELECT c_custkey, {NORM_SQL} AS norm, left(trim(regexp_replace(replace(replace(replace(replace(strip_accents(replace(replace(replace(replace(lower({NAME_SQL}), 'þ', 'th'), 'æ', 'ae'), 'ö', 'o'), 'ð', 'd')),
  'þ', 'th'), 'æ', 'ae'), 'ö', 'o'), 'ð', 'd'), '[^a-z0-9]+', '-', 'g'), '-'), 60) AS slug,
  CASE WHEN c_custkey % 4 <> 0 THEN 'nafn:' || {NORM_SQL} WHEN c_custkey % 3 <> 0 THEN 'id:' || c_custkey ELSE 'óþekkt' END AS key FROM customer"""),
    "unique_slugs": (q_slugs, """
SELECT p_partkey, s || CASE WHEN k > 1 THEN '-' || k ELSE '' END AS slug FROM (
  SELECT p_partkey, replace(lower(p_name), ' ', '-') AS s, row_number() OVER (PARTITION BY replace(lower(p_name), ' ', '-') ORDER BY p_partkey) AS k FROM part)"""),
    "date_texts": (q_dates, """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, strftime(o_orderdate, '%YM%m') AS month_key FROM orders"""),
    "number_texts": (q_numbers, """
SELECT DISTINCT l_orderkey, l_linenumber, round(l_discount * 10 + 1, 2) AS pct, l_extendedprice AS wage, CAST(floor(l_extendedprice) AS BIGINT) AS amount,
  round(l_discount * 10 + 1, 2) AS review_pct, CAST(floor(l_extendedprice) AS BIGINT) AS review_amount,
  coalesce(nullif(concat_ws(' / ', CASE WHEN l_quantity > 10 THEN replace(printf('%.2f', l_quantity), '.', ',') || '%' END,
     CASE WHEN l_linenumber > 1 THEN replace(format('{:,}', CAST(floor(l_extendedprice) AS BIGINT)), ',', '.') || ' kr' END), ''), '-') AS described,
  CASE WHEN l_quantity < 25 THEN '−' ELSE '+' END || replace(printf('%.1f', abs(l_quantity - 25)), '.', ',') || '%' AS signed
FROM lineitem"""),
    "basis_and_type": (q_basis, """
WITH x AS (SELECT o_orderkey, o_orderkey % 7 AS k, o_orderkey % 2 = 0 AS p, o_orderkey % 3 <> 1 AS a FROM orders)
SELECT o_orderkey, CASE k WHEN 0 THEN 'kauptaxtar' WHEN 1 THEN 'launatafla' WHEN 2 THEN 'lágmarkstekjur' WHEN 3 THEN 'byrjunarlaun'
         WHEN 4 THEN 'almenn laun' WHEN 5 THEN 'óskilgreint' ELSE 'almenn laun' END AS basis,
  CASE WHEN p AND a THEN CASE WHEN k = 6 THEN 'prósenta eða krónutala' ELSE 'prósenta og krónutala' END WHEN p THEN 'prósenta' ELSE 'krónutala' END AS type,
  CASE WHEN p AND NOT a THEN 'prósenta' WHEN a AND NOT p THEN 'krónutala' ELSE 'prósenta og krónutala' END AS manual_type FROM x"""),
    "coverage_hits": (q_profile, C + "," + PROFILE + "SELECT * FROM hits"),
    "coverage_by_decade": (q_coverage, C + "," + PROFILE + """
SELECT concat(CAST(year(signed) // 10 * 10 AS VARCHAR), 's') AS decade, count(*) AS documents, count(n) AS with_hit, CAST(coalesce(sum(n), 0) AS BIGINT) AS hits
FROM c LEFT JOIN (SELECT doc_id, count(*) AS n FROM hits GROUP BY doc_id) USING (doc_id) GROUP BY ALL"""),
    "coverage_top_unions": (q_top_unions, C + "," + PROFILE + """
SELECT concat('u', o_custkey % 40) AS union_key, count(*) AS hits FROM hits JOIN c USING (doc_id) GROUP BY ALL ORDER BY hits DESC, union_key LIMIT 15"""),
    "register_summary": (q_register, "SELECT doc_id, source, lang, CAST(length(text) AS INTEGER) AS text_length FROM documents"),
}
