"""Unions, counterparties, URLs, merging: B7, C1–C6, C17, C20, D11, G1, H4–H8."""
from __future__ import annotations

from pyspark.sql import functions as F

from rungline.functions import text as T
from rungline.operators import merge as M
from rungline.operators import resolve as R
from rungline.operators import dedup as D

from .views import cte, iso, table, view

# names of known parties by key, and the id each must get
KNOWN = [("Samtök atvinnulífsins, SA", "sa"), ("SAMTAKA ATVINNULÍFSINS", "sa"), ("VSÍ", "sa"), ("Ríkissjóður, SNR", "riki"),
         ("Samband íslenskra sveitarfélaga", "sveitarfelog"), ("Reykjavíkurborg", "reykjavikurborg"),
         ("Félag atvinnurekenda", "fa"), ("Landssamband íslenskra útvegsmanna", "sfs"),
         ("Samninganefnd bankanna", "sa"), ("", "othekktur")]
EMPLOYER = "CASE c_custkey % 12 " + " ".join(f"WHEN {i} THEN '{n}'" for i, (n, _) in enumerate(KNOWN)) + \
    " WHEN 10 THEN concat('Fyrirtækið ', c_mktsegment, ' ', CAST(c_custkey % 50 AS string), ' ehf.') ELSE concat('Verslun ', c_mktsegment, ' (deild), Reykjavík') END"
EMPLOYER_ID = "CASE c_custkey % 12 " + " ".join(f"WHEN {i} THEN '{x}'" for i, (_, x) in enumerate(KNOWN)) + \
    " WHEN 10 THEN concat('fy-fyrirtaekid-', lower(c_mktsegment), '-', CAST(c_custkey % 50 AS string)) ELSE concat('fy-verslun-', lower(c_mktsegment)) END"


def employers(spark, sf):
    return spark.sql(f"SELECT c_custkey, {EMPLOYER} AS employer FROM {{customer}}", customer=table(spark, sf, "customer"))


def q_register(spark, sf):
    rows = T.with_values(employers(spark, sf), who=T.counterparty_from_register(F.col("employer")))
    return rows.select("c_custkey", F.col("who.id").alias("counterparty"),
                       T.counterparty_kind(F.col("who.id")).alias("kind"))


# web documents: party fields, file name and site by key
WEB = """
SELECT o_orderkey AS row_id, o_custkey,
  CASE o_orderkey % 8 WHEN 0 THEN concat('Félag ', CAST(o_custkey AS string)) WHEN 1 THEN 'fylgiskjöl' WHEN 2 THEN concat('Óþekkt, Félag ', CAST(o_custkey AS string), ' og aðrir')
       WHEN 3 THEN NULL WHEN 4 THEN concat('FÉLAG ', CAST(o_custkey AS string), ' stéttarfélag') ELSE 'Annað' END AS party_1,
  CASE o_orderkey % 5 WHEN 0 THEN concat('Félag ', CAST(o_custkey * 3 AS string), ' og Félag ', CAST(o_custkey * 2 AS string)) WHEN 1 THEN 'Samtaka atvinnulífsins'
       WHEN 2 THEN concat('Félag ', CAST(o_custkey AS string)) WHEN 3 THEN 'Stórveldisins hf' ELSE '' END AS party_2,
  CASE WHEN o_orderkey % 6 = 0 THEN 'x/kalfur-rvk-loka.pdf' ELSE 'x/skjal.pdf' END AS document,
  CASE o_orderkey % 4 WHEN 0 THEN 'vr' WHEN 1 THEN 'sa' WHEN 2 THEN 'reykjavik' ELSE 'vefur' END AS site,
  CAST(o_orderdate AS date) AS valid_from, 1.0e0 + o_orderkey % 5 AS pct
FROM orders
"""


def web(spark, sf):
    return spark.sql(WEB.replace("FROM orders", "FROM {orders}"), orders=table(spark, sf, "orders"))


def known(spark, sf):
    """One union per customer occurs in the register, twice, first written with a title. (Texts name others, too.)"""
    twice = table(spark, sf, "customer").select("c_custkey", F.posexplode(F.array(F.lit("Félag "), F.lit("FÉLAG "))).alias("at", "word"))
    return R.known_unions(twice.select((F.col("c_custkey") * 2 + F.col("at")).alias("row_id"),
                                       F.concat("word", F.col("c_custkey").cast("string")).alias("union_name")))


def resolved(spark, sf, whole_first=True):
    return R.resolve_union(web(spark, sf), known(spark, sf), whole_first=whole_first)


def q_resolve(spark, sf):
    return resolved(spark, sf).select("row_id", "union_name", "tracing")


def q_resolve_rates(spark, sf):
    return resolved(spark, sf, whole_first=False).select("row_id", "union_name", "tracing")


def q_tally(spark, sf):
    return R.tally(resolved(spark, sf), "tracing")


def q_document_counterparty(spark, sf):
    companies = spark.sql("SELECT concat(CASE WHEN c_custkey % 2 = 0 THEN 'Stórveldið' ELSE 'Stórveldi' END, ' hf.') AS company FROM {customer}",
                          customer=table(spark, sf, "customer"))
    unions = known(spark, sf).select("union_name")
    stems = R.company_stems(companies, unions)
    return R.counterparty_from_document(web(spark, sf), stems).select("row_id", "counterparty")


def q_stems(spark, sf):
    """Supplier names as companies, looked up in texts that decline them."""
    s = table(spark, sf, "supplier")
    digits = "translate(substr(s_name, 10), '0123456789', 'abcdefghij')"
    companies = s.select(F.expr(f"concat({digits}, 'fold ehf.')").alias("company"), "s_suppkey")
    unions = s.where("s_suppkey % 10 = 0").select(F.expr(f"concat({digits}, 'foldar')").alias("union_name"))
    texts = s.select("s_suppkey", F.expr(f"concat('Samningur við ', {digits}, 'foldar um kjör')").alias("text"))
    found = R.find_company(texts, R.company_stems(companies, unions))
    return texts.join(found, "text").select("s_suppkey", "company_id")


def q_urls(spark, sf):
    o = table(spark, sf, "orders")
    rows = o.select(F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("contract_id"),
                    F.concat(F.lit("s\\"), F.floor(F.col("o_custkey") / 10).cast("string"), F.lit(".pdf")).alias("document"))
    # repeated entries on all lists, in an order that is not that of their URLs; contracts without a URL are listed, too
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("contract_id"))
    listed = lambda site, n, at: c.select(
        "contract_id", F.when(F.col("contract_id") % n == 0, F.concat(F.lit(f"https://{site}.example/"), F.col("contract_id").cast("string"))).alias("url"),
        (F.col("contract_id") + at).alias("place"))
    contracts = listed("r", 3, 0).unionByName(listed("q", 6, 1_000_000_000_000))
    key = F.col("s_suppkey")
    scattered = ((key * 7919) % 10007) * 1_000_000_000 + key
    of = lambda site, n, place: table(spark, sf, "supplier").select(
        F.concat(F.lit("s/"), F.floor(key / n).cast("string"), F.lit(".pdf")).alias("document"),
        F.concat(F.lit(f"https://{site}.example/"), key.cast("string")).alias("url"), place.alias("place"))
    return R.attach_urls(rows, contracts, of("m", 3, scattered), of("x", 2, -key)).select("row_id", "url")


def q_wildcard(spark, sf):
    """Every three customers share a URL, each with a name of its own; orders ask for the next one's, some for one that nobody has."""
    o = table(spark, sf, "orders")
    asked = o.select("o_orderkey", F.floor((F.col("o_custkey") + 5) / 3).cast("string").alias("url"), (F.col("o_orderkey") % 7).cast("string").alias("norm"))
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("row_id"), F.floor(F.col("c_custkey") / 3).cast("string").alias("url"),
        (F.col("c_custkey") % 5).cast("string").alias("norm"), "c_mktsegment")
    return R.lookup_with_default(asked, c, values=("c_mktsegment",)).select("o_orderkey", "c_mktsegment")


def merged(spark, sf):
    o = table(spark, sf, "orders")
    base = o.select(
        F.col("o_orderkey").alias("row_id"), F.to_date(F.date_trunc("month", "o_orderdate")).alias("valid_from"),
        F.concat(F.lit("Félag "), F.floor(F.col("o_custkey") / 20).cast("string")).alias("union_name"),
        F.when(F.col("o_orderkey") % 3 != 1, 2.5).alias("pct"),
        F.when(F.col("o_orderkey") % 3 != 0, F.lit(1000)).cast("bigint").alias("amount"))
    register = base.where("row_id % 3 = 0").withColumn("employer", F.lit("Samtök atvinnulífsins, SA"))
    pages = resolved(spark, sf).where("row_id % 3 = 1").withColumn("amount", F.lit(None).cast("bigint"))
    manual = base.where("row_id % 3 = 2").withColumn("counterparty", F.lit(" ")).withColumn(
        "source", F.when(F.col("row_id") % 2 == 0, "https://s.example/a").otherwise("bréf")).withColumn(
        "note", F.when(F.col("row_id") % 4 == 0, "athugað"))
    return M.merge_sources(register, pages, manual)


def q_merge(spark, sf):
    return iso(merged(spark, sf).select("row_id", "origin", "tracing", "union_name", "valid_from", "type",
                                        "counterparty", "url", "quotation", "own_site"))


def q_override(spark, sf):
    rows = view(spark, sf, "v_increase")
    same = lambda c: F.lower(c)
    kept = M.override(rows, rows.where("row_id % 97 = 0"), "union_key", norm=same)
    return kept.groupBy("union_key").agg(F.count(F.lit(1)).alias("n"))


def q_only_new(spark, sf):
    d = table(spark, sf, "documents").select(
        F.concat(F.lit("https://d.example/"), F.col("doc_id").cast("string")).alias("url"), F.sha2("text", 256).alias("sha256"), "doc_id")
    return D.only_new(d, d.where("doc_id % 4 = 0")).select("doc_id")


K = f"""
WITH web AS ({WEB}),
known AS (SELECT concat('félag ', c_custkey) AS norm, concat('Félag ', c_custkey) AS union_name FROM customer GROUP BY ALL),
parts AS (
  SELECT row_id, 0 AS pos, party_1 AS t FROM web UNION ALL SELECT row_id, 1, party_2 FROM web
  UNION ALL SELECT row_id, 10 + generate_subscripts(l, 1), unnest(l) FROM (SELECT row_id, string_split(replace(party_1, ' og ', ','), ',') AS l FROM web WHERE party_1 IS NOT NULL)
  UNION ALL SELECT row_id, 100 + generate_subscripts(l, 1), unnest(l) FROM (SELECT row_id, string_split(replace(party_2, ' og ', ','), ',') AS l FROM web)),
res AS (SELECT row_id, arg_min(union_name, POS_) AS u FROM parts JOIN known ON regexp_replace(lower(trim(t)), ' stéttarfélag$', '') = norm GROUP BY row_id),
resolved AS (SELECT w.*, coalesce(u, CASE WHEN site = 'vr' THEN 'VR' END) AS union_name,
                    CASE WHEN u IS NOT NULL THEN 'aðili úr skjali' WHEN site = 'vr' THEN 'vefur félagsins' ELSE 'órakið' END AS tracing
             FROM web w LEFT JOIN res USING (row_id))
"""
WHOLE = K.replace("POS_", "pos")
BY_FIELD = K.replace("POS_", "CASE pos WHEN 1 THEN 99 ELSE pos END")

ENTRIES = {
    "register_counterparty": (q_register, f"""
SELECT c_custkey, id AS counterparty, CASE WHEN id IN ('sa', 'fa', 'sfs') THEN 'samtok' WHEN id = 'riki' THEN 'riki' WHEN id IN ('sveitarfelog', 'reykjavikurborg') THEN 'sveitarfelag'
  WHEN id = 'othekktur' THEN 'othekkt' ELSE 'fyrirtaeki' END AS kind FROM (SELECT c_custkey, {EMPLOYER_ID} AS id FROM customer)"""),
    "resolved_unions": (q_resolve, WHOLE + "SELECT row_id, union_name, tracing FROM resolved"),
    "resolved_rate_documents": (q_resolve_rates, BY_FIELD + "SELECT row_id, union_name, tracing FROM resolved"),
    "tracing_tally": (q_tally, WHOLE + "SELECT tracing, count(*) AS n FROM resolved GROUP BY tracing"),
    "document_counterparty": (q_document_counterparty, f"""
WITH web AS ({WEB})
SELECT row_id, CASE WHEN row_id % 5 = 1 THEN 'sa' WHEN row_id % 6 = 0 THEN 'reykjavikurborg' WHEN row_id % 5 = 3 THEN 'fy-storveldid'
  WHEN site = 'sa' THEN 'sa' WHEN site = 'reykjavik' THEN 'reykjavikurborg' ELSE 'othekktur' END AS counterparty FROM web"""),
    "company_stems": (q_stems, """
SELECT s_suppkey, concat('fy-', translate(substr(s_name, 10), '0123456789', 'abcdefghij'), 'fold') AS company_id FROM supplier WHERE s_suppkey % 10 <> 0"""),
    "document_urls": (q_urls, """
WITH c AS (SELECT c_custkey AS id, concat('https://r.example/', c_custkey) AS url, c_custkey AS place FROM customer WHERE c_custkey % 3 = 0
           UNION ALL SELECT c_custkey, concat('https://q.example/', c_custkey), c_custkey + 1000000000000 FROM customer WHERE c_custkey % 6 = 0),
ci AS (SELECT id, arg_max(url, place) AS url FROM c GROUP BY id),
m AS (SELECT s_suppkey // 3 AS d, arg_min(concat('https://m.example/', s_suppkey), ((s_suppkey * 7919) % 10007) * 1000000000 + s_suppkey) AS url FROM supplier GROUP BY ALL),
x AS (SELECT s_suppkey // 2 AS d, arg_min(concat('https://x.example/', s_suppkey), -s_suppkey) AS url FROM supplier GROUP BY ALL)
SELECT o_orderkey AS row_id, coalesce(ci.url, m.url, x.url, '') AS url FROM orders LEFT JOIN ci ON ci.id = o_custkey
LEFT JOIN m ON m.d = o_custkey // 10 LEFT JOIN x ON x.d = o_custkey // 10"""),
    "wildcard_lookup": (q_wildcard, """
WITH c AS (SELECT c_custkey // 3 AS u, c_custkey % 5 AS n, arg_min(c_mktsegment, c_custkey) AS seg FROM customer GROUP BY ALL),
l AS (SELECT c_custkey // 3 AS u, arg_min(c_mktsegment, c_custkey) AS seg FROM customer GROUP BY ALL)
SELECT o_orderkey, coalesce(c.seg, l.seg) AS c_mktsegment FROM orders LEFT JOIN c ON c.u = (o_custkey + 5) // 3 AND c.n = o_orderkey % 7
LEFT JOIN l ON l.u = (o_custkey + 5) // 3"""),
    "merged_sources": (q_merge, WHOLE + """,
base AS (SELECT o_orderkey AS row_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS valid_from, concat('Félag ', o_custkey // 20) AS union_name FROM orders),
man AS (SELECT * FROM base WHERE row_id % 3 = 2),
mach AS (SELECT row_id, 'ríkissáttasemjari' AS origin, 'staðfest lýsigögn' AS tracing, union_name, valid_from, CAST(NULL AS VARCHAR) AS type, 'sa' AS counterparty,
                NULL AS url, NULL AS quotation, 0 AS own_site FROM base WHERE row_id % 3 = 0
         UNION ALL SELECT row_id, 'vefskjal', tracing, union_name, valid_from, NULL, NULL, NULL, NULL, CASE WHEN site = 'vr' THEN 1 ELSE 0 END
         FROM resolved WHERE row_id % 3 = 1 AND union_name IS NOT NULL)
SELECT * REPLACE (CAST(valid_from AS VARCHAR) AS valid_from) FROM mach m WHERE NOT EXISTS (SELECT 1 FROM man WHERE lower(man.union_name) = lower(m.union_name) AND man.valid_from = m.valid_from)
UNION ALL SELECT row_id, 'handvirk leiðrétting', 'yfirfarið handvirkt', union_name, CAST(valid_from AS VARCHAR), 'prósenta og krónutala', '',
  CASE WHEN row_id % 2 = 0 THEN 'https://s.example/a' ELSE '' END, CASE WHEN row_id % 4 = 0 THEN 'athugað' ELSE 'Handvirk leiðrétting við yfirferð eyðu.' END, 0 FROM man"""),
    "correction_override": (q_override, cte("v_increase") + """
SELECT union_key, count(*) AS n FROM v_increase v WHERE NOT EXISTS (SELECT 1 FROM v_increase c WHERE c.row_id % 97 = 0 AND c.union_key = v.union_key AND c.valid_from = v.valid_from)
GROUP BY union_key"""),
    "only_new_documents": (q_only_new, """
SELECT doc_id FROM documents WHERE doc_id % 4 <> 0 AND sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 4 = 0)"""),
}
