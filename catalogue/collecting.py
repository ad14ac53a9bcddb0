"""Inventories, duplicates, links, cubes: A3–A5, B3, B5, B6, C16, D9, E13."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rungline import session
from rungline.operators import dedup as D
from rungline.operators import links as N
from rungline.sources import tables

from .views import table

PRIORITY = ["src3", "src1", "src7"]
#: Customers per JSON array at most, as a power of two.
BLOCK_BITS = 12


def inventory(spark, sf):
    d = table(spark, sf, "documents")
    return d.select(F.concat_ws("/", "source", F.format_string("%09d", "doc_id")).alias("path"), "source",
                    F.octet_length("text").cast("bigint").alias("size"), F.sha2("text", 256).alias("sha256"), "doc_id")


def q_files(spark, sf):
    """Customers' names as a file per nation, in a folder whose name has pattern characters, listed again."""
    path = f"{session.shared_folder(spark)}/skjal+(1)-{uuid.uuid4().hex}"
    c = table(spark, sf, "customer").select("c_name", "c_nationkey", "c_custkey").repartition("c_nationkey")
    c.sortWithinPartitions("c_nationkey", "c_custkey").select("c_name", "c_nationkey").write.partitionBy("c_nationkey").text(path)
    return tables.document_inventory(spark, path, "*.txt").select("source", "size", "sha256")


def q_contracts(spark, sf):
    """Customers as register metadata: JSON arrays of a bounded block of customers each, one a file, read again."""
    path = f"{session.shared_folder(spark)}/contracts-{uuid.uuid4().hex}"
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("launthegi"), F.col("c_mktsegment").alias("markadsflokk"),
        F.when(F.col("c_custkey") % 3 == 0, "x").otherwise(F.concat(F.lit("20"), F.lpad((F.col("c_custkey") % 30).cast("string"), 2, "0"), F.lit("-02-03T00:00"))).alias("fra"),
        F.when(F.col("c_custkey") % 4 > 0, F.concat(F.col("c_name"), F.lit("\n\"þ\""))).alias("ocr_text"))
    # blocks of row numbers, which never reach over two partitions: bounded also where a key is repeated
    blocks = c.groupBy(F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS).alias("block"))
    arrays = blocks.agg(F.to_json(F.array_sort(F.collect_list(F.struct(*c.columns)))).alias("value")).select("value")
    arrays.write.option("maxRecordsPerFile", 1).text(path)
    read = tables.register_summary(tables.read_contracts(spark, path))
    return read.select("id", "launthegi", "markadsflokk", F.col("fra").cast("string").alias("fra"), F.col("til").cast("string").alias("til"), "text_length")


def marked(spark, sf):
    return D.mark_duplicates(inventory(spark, sf), PRIORITY)


def q_inventory(spark, sf):
    return inventory(spark, sf).select("path", "source", "size", "sha256")


def q_duplicates(spark, sf):
    return marked(spark, sf).select("path", "original", "is_duplicate")


def q_hot(spark, sf):
    """The same by the text's first word, a hash with very many copies."""
    rows = D.mark_duplicates(inventory(spark, sf).withColumn("first", F.substring("sha256", 1, 1)), PRIORITY, hash_column="first")
    return rows.groupBy("source").agg(F.sum("is_duplicate").alias("duplicates"))


def q_stats(spark, sf):
    return D.duplicate_stats(marked(spark, sf))


def q_originals(spark, sf):
    return D.originals(inventory(spark, sf), marked(spark, sf)).select("doc_id")


def links(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    sources = pages.select(F.substring_index(N.host(F.col("url")), ".", 1).alias("source"), N.host(F.col("url")).alias("h"))
    registry = sources.groupBy("source").agg(F.collect_set("h").alias("hosts"))
    raw = N.page_links(pages.withColumn("source", F.substring_index(N.host(F.col("url")), ".", 1)), keep=["source", "page_id"])
    return N.on_allowed_host(raw, registry).withColumnRenamed("page_id", "page_order")


def q_links(spark, sf):
    return links(spark, sf).select("page_order", "place", "link")


def q_documents(spark, sf):
    """Everything below a path with an "a" stands for a document here."""
    return N.discover_documents(links(spark, sf), pattern="/[^/]*a[^/]*$").select("source", "link", "text", "found_on")


def q_frontier(spark, sf):
    found = links(spark, sf).withColumn("depth", (F.col("page_order") % 3).cast("int"))
    visited = found.where("page_order % 5 = 0").select("source", "link")
    return N.next_frontier(found, visited, 2, words=["e", "th"], pattern="/[^/]*z[^/]*$")


def q_cube(spark, sf):
    """Customers per nation and segment as one cube per region, a json-stat file each, read back to rows."""
    path = f"{session.shared_folder(spark)}/cubes-{uuid.uuid4().hex}"
    n, c = table(spark, sf, "nation"), table(spark, sf, "customer")
    counts = c.groupBy("c_nationkey", "c_mktsegment").agg(F.sum("c_acctbal").alias("v"))
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    wide = counts.groupBy("c_nationkey").pivot("c_mktsegment", segments).agg(F.first("v"))
    rows = n.join(wide, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    cube = rows.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_name", F.array(*segments).alias("v")))).alias("r"))
    names = F.transform("r", lambda x: x["n_name"])
    members = lambda listed: F.struct(F.struct(F.map_from_arrays(listed, F.transform(listed, lambda x, i: i)).alias("index")).alias("category"))
    body = F.to_json(F.struct(
        F.array(F.lit(1), F.size("r"), F.lit(len(segments))).alias("size"),
        F.struct(members(F.array(F.col("n_regionkey").cast("string"))).alias("region"), members(names).alias("nation"),
                 members(F.array(*[F.lit(s) for s in segments])).alias("segment")).alias("dimension"),
        F.flatten(F.transform("r", lambda x: x["v"])).alias("value")))
    cube.select(body.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    flat = tables.read_cubes(spark, path, ["region", "nation", "segment"], {"segment": ["BUILDING", "MACHINERY"]})
    return flat.select(F.col("region").cast("int").alias("n_regionkey"), "nation", "segment", F.round("value", 2).alias("value"))


def q_types(spark, sf):
    o = table(spark, sf, "orders")
    text = o.select(F.col("o_orderkey").cast("string"),
                    F.when(F.col("o_orderkey") % 3 == 0, " ").when(F.col("o_orderkey") % 3 == 1, "x").otherwise(
                        F.col("o_custkey").cast("string")).alias("n"),
                    F.when(F.col("o_orderkey") % 4 == 0, "").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
                    F.to_date("o_orderdate").cast("string").alias("day"), F.col("o_orderstatus").alias("status"))
    typed = tables.apply_types(text, ints=["o_orderkey", "n"], floats=["price"], dates=["day"])
    return typed.select("o_orderkey", "n", F.round("price", 2).alias("price"), F.year("day").alias("year"), "status")


INV = """
inv AS (SELECT doc_id, concat(source, '/', format('{:09d}', doc_id)) AS path, source, CAST(strlen(text) AS BIGINT) AS size, sha256(text) AS sha256 FROM documents),
ranked AS (SELECT *, first_value(path) OVER (PARTITION BY sha256 ORDER BY CASE source WHEN 'src3' THEN 0 WHEN 'src1' THEN 1 WHEN 'src7' THEN 2 ELSE 3 END, path) AS original FROM inv),
marked AS (SELECT *, CASE WHEN path <> original THEN 1 ELSE 0 END AS is_duplicate FROM ranked)
"""
WITH = "WITH " + INV.strip()
RAW_LINKS = r"""
pg AS (SELECT page_id, url, lower(regexp_extract(url, '^https?://([^/?#]*)', 1)) AS h, html FROM pages),
a AS (SELECT page_id, url, h, unnest(l) AS m, generate_subscripts(l, 1) - 1 AS place
      FROM (SELECT *, regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>') AS l FROM pg)),
hr AS (SELECT *, regexp_extract(m, '(?is)href\s*=\s*["'']([^"'']*)["'']', 1) AS href, trim(regexp_replace(regexp_replace(m, '<[^>]*>', ' ', 'gs'), '\s+', ' ', 'g')) AS text FROM a),
ln AS (SELECT *, split_part(h, '.', 1) AS source, CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN regexp_replace(href, '#.*$', '')
              WHEN href LIKE '/%' THEN concat(regexp_extract(url, '^(https?://[^/?#]*)', 1), regexp_replace(href, '#.*$', '')) ELSE concat(regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', ''), href) END AS link FROM hr),
links AS (SELECT page_id AS page_order, url AS page, source, place, link, text FROM ln
          WHERE link LIKE 'http%' AND EXISTS (SELECT 1 FROM pg WHERE split_part(pg.h, '.', 1) = ln.source AND contains(lower(regexp_extract(link, '^https?://([^/?#]*)', 1)), pg.h)))
"""

ENTRIES = {
    "document_inventory": (q_inventory, WITH + "SELECT path, source, size, sha256 FROM inv"),
    "files_inventory": (q_files, """
SELECT concat('c_nationkey=', c_nationkey) AS source, CAST(sum(strlen(c_name) + 1) AS BIGINT) AS size,
       sha256(string_agg(concat(c_name, chr(10)), '' ORDER BY c_custkey)) AS sha256 FROM customer GROUP BY c_nationkey"""),
    "register_contracts": (q_contracts, """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS launthegi, c_mktsegment AS markadsflokk,
       CASE WHEN c_custkey % 3 <> 0 THEN concat('20', lpad(CAST(c_custkey % 30 AS VARCHAR), 2, '0'), '-02-03') END AS fra, CAST(NULL AS VARCHAR) AS til,
       CAST(CASE WHEN c_custkey % 4 > 0 THEN length(c_name) + 4 ELSE 0 END AS INTEGER) AS text_length FROM customer"""),
    "marked_duplicates": (q_duplicates, WITH + "SELECT path, original, is_duplicate FROM marked"),
    "marked_duplicates_hot": (q_hot, WITH + """, first AS (SELECT source, path, first_value(path) OVER (PARTITION BY substr(sha256, 1, 1) ORDER BY CASE source WHEN 'src3' THEN 0 WHEN 'src1' THEN 1 WHEN 'src7' THEN 2 ELSE 3 END, path) AS original FROM inv)
SELECT source, CAST(count(*) FILTER (path <> original) AS BIGINT) AS duplicates FROM first GROUP BY source"""),
    "duplicate_stats": (q_stats, WITH + """
SELECT source, count(*) AS files, count(*) FILTER (is_duplicate = 0) AS unique_files, count(*) FILTER (is_duplicate = 1) AS duplicates,
  CAST(sum(size) AS BIGINT) AS bytes, CAST(coalesce(sum(size) FILTER (is_duplicate = 1), 0) AS BIGINT) AS duplicate_bytes FROM marked GROUP BY source"""),
    "original_documents": (q_originals, WITH + "SELECT doc_id FROM marked WHERE is_duplicate = 0"),
    "page_links": (q_links, "WITH " + RAW_LINKS.strip() + "SELECT page_order, CAST(place AS INTEGER) AS place, link FROM links"),
    "discovered_documents": (q_documents, "WITH " + RAW_LINKS.strip() + r"""
SELECT source, link, arg_min(text, (page_order, place)) AS text, arg_min(page, (page_order, place)) AS found_on FROM links
WHERE (regexp_matches(link, '/[^/]*a[^/]*$') OR regexp_matches(lower(link), '\.pdf$'))
  AND NOT regexp_matches(lower(concat(link, ' ', text)), 'umsokn|umsóknar|eydublad|eyðublað|arsskyrsla|ársskýrsla|arsreikning|ársreikning|fundargerd|fundargerð|logreglusamthykkt|personuvernd|persónuvernd|sjodfelagi|styrktarsjod|sjukrasjod|sjúkrasjóð|orlofs|logbok|lögbók|samthykktir-felagsins')
GROUP BY source, link"""),
    "next_frontier": (q_frontier, "WITH " + RAW_LINKS.strip() + r"""
SELECT source, link, CAST(min(page_order % 3) + 1 AS INTEGER) AS depth FROM links
WHERE page_order % 3 < 2 AND NOT regexp_matches(link, '/[^/]*z[^/]*$') AND NOT regexp_matches(lower(link), '\.(pdf|jpg|png|gif|svg|zip|docx|doc|xlsx|xls|mp4|css|js|ico|webp)$')
  AND regexp_matches(lower(link), 'e|th') AND (source, link) NOT IN (SELECT (source, link) FROM links WHERE page_order % 5 = 0)
GROUP BY source, link"""),
    "flattened_cube": (q_cube, """
SELECT n_regionkey, n_name AS nation, c_mktsegment AS segment, round(sum(c_acctbal), 2) AS value
FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY ALL"""),
    "late_types": (q_types, """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN o_custkey END AS n, CASE WHEN o_orderkey % 4 <> 0 THEN round(o_totalprice, 2) END AS price,
  CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus AS status FROM orders"""),
}
