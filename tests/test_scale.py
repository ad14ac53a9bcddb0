"""Plans and inputs at scale: what is broadcast, over how many tasks texts are read, how often rules are tried."""
from pyspark.sql import functions as F

from catalogue import views
from rungline.functions import fixed as X
from rungline.functions import text as T
from rungline.operators import rates as W
from rungline.operators import resolve as R


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rate_rows(spark):
    """Few bytes by Spark's estimate, several rows per source row."""
    return spark.range(40).select(
        F.floor(F.col("id") / 20).alias("doc_id"), F.col("id").alias("grade"), F.lit(1).alias("step_no"), F.explode(F.array(*map(F.lit, (0, 1, 2)))).alias("row_id")
    ).select("*", F.date_add(F.lit("2020-01-01").cast("date"), F.col("row_id") * 365).alias("valid_from"),
             (100000.0 + F.col("row_id") * (1000 + F.col("grade"))).alias("wage"))


def test_rate_changes_broadcast_nothing(spark):
    """Values, middle bins and spreads have rows per document; millions of them broke the driver."""
    changes = W.rate_changes(W.adjacent_change(rate_rows(spark)))
    assert "Broadcast" not in plan(changes)
    assert {(r.doc_id, r.pct, r.measurements) for r in changes.collect()} == {(0, 1.01, 20), (0, 1.0, 20), (1, 1.03, 20), (1, 1.02, 20)}


TABLE = "Gildir frá 1. apríl 2020\nMánaðarlaun í dagvinnu\nLaunaflokkur 4   200.100  210.200\nlfl. 4  230.100  240.200\n"


def test_wage_tables_broadcast_nothing(spark):
    scan = W.scan_wage_tables(spark.range(30).select(F.col("id").alias("doc_id"), F.lit(TABLE).alias("text")))
    assert "Broadcast" not in plan(scan)
    assert scan.groupBy("table_no").count().orderBy("table_no").collect() == [(2, 60), (3, 60)]


def test_contract_starts_are_not_broadcast(spark):
    rows = spark.range(30).select(
        F.col("id").alias("doc_id"), F.col("id").alias("line_no"), F.lit(None).cast("date").alias("valid_from"), F.lit(1).alias("table_no"),
        F.lit(X.UNIT_MONTHLY).alias("unit"), F.lit("4").alias("grade"), F.lit(1).alias("step_no"), F.lit(200100.0).alias("wage"))
    starts = spark.range(30).select(F.col("id").alias("doc_id"), F.lit("1999-01-01").cast("date").alias("valid_from"))
    done = W.finish_tables(rows, starts)
    assert "Broadcast" not in plan(done)
    assert done.where("valid_from = '1999-01-01'").count() == 30


def test_texts_are_read_by_all_tasks(spark):
    """Keys are few bytes; adaptive execution put the texts made of them into one task."""
    rows = views.spread(spark.range(5000).toDF("k"), "k").withColumn("t", F.spark_partition_id())
    assert rows.select("t").distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_squeeze_and_mentions_as_before(spark):
    ranges = ((9, 13), (0x1c, 0x20), (0x85, 0x85), (0xa0, 0xa0), (0x1680, 0x1680), (0x2000, 0x200a), (0x2028, 0x2029), (0x202f, 0x202f), (0x205f, 0x205f), (0x3000, 0x3000))
    spaces = [chr(c) for low, high in ranges for c in range(low, high + 1)]
    old = F.trim(F.regexp_replace("t", r"[ \t-\r\x1c-\x1f\x85\xa0  -     　]+", " "))
    texts = [a + s + u + b for s in spaces for u in ("", " ", "\t ", "\xa0") for a, b in (("", "á"), ("x!", "~b"), ("ð ", " \xa1"), ("\u1681", "\u200b"))]
    df = spark.createDataFrame([(t,) for t in [*texts, "", " ", "a b", "a  b"]], "t string")
    assert df.where(~T.squeeze(F.col("t")).eqNullSafe(old)).count() == 0
    patterns = [X.WAGE_WORD, X.CHANGE_WORD, X.EXCLUDED_PAYMENT, X.WAGE_LEVEL, X.FUND_FEE, X.ENTITLEMENT_SHARE, *[p for _, p in X.BASIS_PATTERNS]]
    said = ["laun", "ólaun", "kaup", "launalið", "breytist", "tak hlutfallsh", "taka hlutfallsh", "í kr. 5", "í 7", "verða 5", "nemur 3", "sjóð", "ríkissjóð", "virkstarfsendurhæf",
            "virk-starfsendurhæf", "virk", "óvirk", "framlag  til", "gjald í x", "greiða 5% af", "orlofsfé er 5 %", "á rétt á 5%", "starfsaldr eða 5 ára aldur",
            "starfsaldri eða 5 ára aldur", "almennar launahækk", "almenn hækk", "almennhækk", ""]
    df = spark.createDataFrame([(t,) for t in said], "t string")
    for p in patterns:
        assert df.where(T.mentions(F.col("t"), p) != F.col("t").rlike(p)).count() == 0, p


def test_windows_are_squeezed_only_where_they_must_be(spark):
    texts = [a + s + b for s in ("", " ", "  ", "\t", "\n", "\r", "\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u2013", "\u3000", "\ufeff", "\U0001f600") for a in ("", "á", " ")
             for b in ("", "b", " ", "\n")]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    assert df.where(~T.squeeze_column("t").eqNullSafe(T.squeeze(F.col("t")))).count() == 0


def test_plain_text_that_a_pattern_needs():
    assert T.needed(r"taka? hlutfallsh") == ["hlutfallsh"] and T.needed(r"(?<!ríkis)sjóð") == ["sjóð"] and T.needed(r"\d+\s*%") == []
    assert T.needed(r"(?:skal\s+(?:hann|hún)|á\s+rétt|fá\s+þó)\d") == ["skal", "rétt", "fá"] and T.needed(r"(?:ab|\d)x?") == []
    words, patterns = T._split(X.EXCLUDED_PAYMENT)
    groups = T._grouped(words)
    # a context without any of them is searched for half as many pieces as there are words
    assert len(groups) * 2 <= len(words) and all(piece in w for piece, some in groups for w in some)
    assert all(any(v in w for _, some in groups for v in some) for w in words)


def test_rules_are_tried_once_per_text(spark, monkeypatch):
    """A text that many sets of texts share is classified in one place, whatever stands beside it."""
    tried = []
    classify = T.classify_counterparty
    monkeypatch.setattr(T, "classify_counterparty", lambda c: tried.append(str(c)) or classify(c))
    docs = spark.createDataFrame([(1, "Samtaka atvinnulífsins", None, "x/skjal.pdf", "vefur"), (2, None, "Samtaka atvinnulífsins", "x/skjal.pdf", "vefur"),
                                  (3, "Félag 1", "Félag 2", "x/kalfur-rvk-loka.pdf", "sa"), (4, "", "Félag 2", None, "sa"), (5, None, None, None, None)],
                                 "row_id int, party_1 string, party_2 string, document string, site string")
    found = {r.row_id: r.counterparty for r in R.counterparty_from_document(docs).collect()}
    assert found == {1: "sa", 2: "sa", 3: "reykjavikurborg", 4: "sa", 5: X.UNKNOWN_COUNTERPARTY}
    assert len(tried) == 1
