"""Review and rate queries at scale: what is worked out once, over how many tasks short rows are dealt."""
import datetime

from pyspark.sql import functions as F

from catalogue import reviewing as Q
from rungline.functions import text as T
from rungline.operators import rates as W
from rungline.operators import review as V


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def orders(spark, path, rows):
    """``rows``: key, customer, date, status, priority."""
    schema = "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp, o_orderstatus string, o_orderpriority string"
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/orders.parquet")
    return str(path)


def test_forms_are_parsed_once_for_both_parts(spark, tmp_path):
    """Corrections and confirmed gaps are parts of the same parsed forms; the parser stood in both branches."""
    day = datetime.datetime(2001, 3, 4)
    rows = [(k, 7, day, "F" if k % 2 == 0 else "O", "1-URGENT" if k == 12 else "5-LOW") for k in (2, 3, 4, 6, 8, 10, 12, 14, 16, 29 * 4)]
    rows += [(None, 7, day, "F", "5-LOW"), (8, 7, day, "F", "5-LOW"), (18, None, day, "F", "5-LOW"), (20, 7, None, "F", "5-LOW")]
    found = Q.q_approved(spark, orders(spark, tmp_path, rows))
    assert "Generate" not in plan(found) and "Join" not in plan(found)
    # 3: not approved; 6: 30%; 12: applied; 14: no such day; 116: no union
    assert sorted((r.id, r.kind) for r in found.collect()) == [(2, "haekkun"), (4, "engin"), (8, "engin"), (8, "engin"), (10, "haekkun"), (16, "engin")]


def test_parse_form_as_before(spark):
    """The last of equal headings counts, blanks may follow a heading but not precede it beyond the marks, unknown headings are left out."""
    bodies = ["### Félag\n\n A \n\u00a0\n### Félag  \n\nB\n### Annað\nx", "### Félag\n_No response_\n### Krónur", "x\n###   Tegund\t\nhér\n### Tegund\nEngin\nhækkun\n",
              "### \tEyða\nþá", "Félag\nA\n###Félag\nB", "", None, "### Á við\r\nx", "\n### Samningur\n \n### Heimild\n_No response_ x"]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    got = {r.i: r.f for r in df.select("i", T.parse_form(F.col("body")).alias("f")).collect()}
    assert got == {0: {"felag": "B"}, 1: {"felag": "", "kronur": ""}, 2: {"tegund": "Engin\nhækkun"}, 3: {"eyda": "þá"}, 4: {}, 5: {}, 6: {}, 7: {},
                   8: {"samningur": "", "heimild": "_No response_ x"}}


def test_union_names_are_written_once(spark, tmp_path, monkeypatch):
    """The look-ups read the contracts several times; each time all contracts' names were written anew, by the few tasks that read the file."""
    rows = [(k, 3 * (k % 5) + 1 - (k % 5) % 2, datetime.datetime(1992 + k % 3 * 3, 1 + k % 12, 5), "O", "1-URGENT") for k in range(1, 400)]
    seen = []
    real = V.contracts_in_gap
    monkeypatch.setattr(V, "contracts_in_gap", lambda asked, contracts, **kw: seen.append(contracts) or real(asked, contracts, **kw))
    Q.q_contracts(spark, orders(spark, tmp_path, rows + [(400, None, datetime.datetime(1995, 1, 1), "O", None)]))
    assert "regexp_replace" not in plan(seen[0]) and "concat" not in plan(seen[0])
    names = {(r.holder_norm, r.holder_raw) for r in seen[0].where("contract_id <> 400").collect()}
    assert len(names) == 5 and all(raw.startswith("stéttarfélagið ") and raw.endswith(" ; " + norm) for norm, raw in names)
    assert [(r.holder_norm, r.holder_raw) for r in seen[0].where("contract_id = 400").collect()] == [("", None)]
    assert seen[0].count() == 400


def test_rates_are_dealt_to_all_tasks(spark):
    """Short rows pack well; adaptive execution put those of many documents into a few tasks, where all were sorted."""
    rates = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit(2020).alias("table_no"), (F.col("id") % 7).alias("grade"), F.explode(F.array(*map(F.lit, (1, 2)))).alias("step_no"),
                                     F.lit("2020-01-01").cast("date").alias("valid_from"), F.lit(300000.0).alias("wage"), F.lit(1).alias("row_id"))
    rates = rates.unionByName(rates.withColumn("valid_from", F.lit("2021-01-01").cast("date")).withColumn("wage", F.lit(303000.0)).withColumn("row_id", F.lit(2)))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for rows, count in ((W.check_steps(rates, ("doc_id", "table_no", "grade", "valid_from")), 16000), (W.adjacent_change(rates), 8000)):
        tasks = [r.n for r in rows.withColumn("t", F.spark_partition_id()).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()]
        assert len(tasks) == n and sum(tasks) == count
