"""The whole batch on a handful of records, the wage-table scanner, the intake stream."""
import datetime as dt
import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rungline.operators import links as N
from rungline.operators import rates as W
from rungline.operators import resolve as R
from rungline.plans import build as B
from rungline.sources import sinks, tables
from rungline.streaming import intake

PREFIX = ("Kjarasamningur. 1. gr. 2 Samningur þessi milli Samtaka atvinnulífsins annars vegar og {union} hins vegar "
          "gildir frá 1. janúar 2015 til 31. desember 2020. Um kauptaxta og launatöflu fer eftir lögum. " + "Almenn ákvæði standa óbreytt. " * 20)
CLAUSE = "Laun hækka um {p}% þann 1. {m} {y}. " + "Önnur ákvæði samnings standa óbreytt út gildistíma hans. " * 6


def text(union, *steps):
    return PREFIX.format(union=union) + "".join(CLAUSE.format(p=p, m=m, y=y) for p, m, y in steps)


def test_full_batch(spark, tmp_path):
    steps = [("3,5", "janúar", 2015), ("2,5", "mars", 2016), ("3,0", "apríl", 2017), ("2,0", "mars", 2018), ("2,5", "apríl", 2019)]
    contracts = spark.createDataFrame([
        ("1", "c1", "a.txt", "Efling", None, "7", "Samtök atvinnulífsins, SA", "ASÍ", "almennur", "kjara", dt.date(2015, 1, 1), dt.date(2020, 12, 31), "https://r/1", text("Eflingar", *steps)),
        ("2", "c2", "b.txt", "VR", None, "8", "Síminn hf.", "ASÍ", "almennur", "kjara", dt.date(2015, 1, 1), None, "https://r/2", text("VR", *steps[:2])),
    ], tables.CONTRACT.simpleString().replace("struct<", "").rstrip(">").replace("fra:string", "fra:date").replace("til:string", "til:date"))
    register = B.register_increases(contracts)
    assert register.count() == 7
    web = B.web_increases(spark.createDataFrame([
        ("efling/samningur.pdf", text("Eflingar", *steps[3:])), ("efling/arsskyrsla.pdf", text("Eflingar", *steps)),
    ], "path string, text string"))
    assert {r.party_1 for r in web.collect()} == {"Samtaka atvinnulífsins"}
    manual = spark.createDataFrame([("Efling", dt.date(2019, 4, 1), 2.75, None, "almenn laun", "https://x/1", "", "")],
                                   "union_name string, valid_from date, pct double, amount long, basis string, source string, note string, counterparty string")
    companies = contracts.select(F.col("atvinnurekandi").alias("company"))
    named = contracts.select(F.col("id").alias("contract_id"), F.col("pdf_url").alias("url"), F.col("launthegi_canonical").alias("union_name"))
    no_urls = spark.createDataFrame([("efling/samningur.pdf", "https://w/1")], "document string, url string")
    increases = B.merge(register, web, manual, companies, named, no_urls, no_urls.limit(0))
    rows = increases.collect()
    assert len(rows) == 7 - 1 + 1 + 1  # the correction replaces both readings of 2019-04-01
    built = B.build_series(
        increases, F.lit(dt.date(2020, 1, 1)),
        spark.createDataFrame([], "member string, federation string, counterparty string"),
        spark.createDataFrame([], "union_key string, counterparty string"),
        spark.createDataFrame([], "union_key string, counterparty string, gap_from date, gap_to date"))
    got = [(r.union_key, r.counterparty, str(r.valid_from), r.pct, r["index"], r.sources) for r in
           built.series.where("union_key = 'nafn:efling'").orderBy("valid_from").collect()]
    assert [g[2:] for g in got] == [("2015-01-01", 3.5, 100.0, 1), ("2016-03-01", 2.5, 102.5, 1), ("2017-04-01", 3.0, 105.58, 1),
                                    ("2018-03-01", 2.0, 107.69, 2), ("2019-04-01", 2.75, 110.65, 1)]
    assert {g[1] for g in got} == {"sa"}
    unions = {r.union_key: (r.main_line, r.n_increases, r.grade) for r in built.unions.collect()}
    assert unions["nafn:efling"] == ("sa", 5, "samfelld")
    months = spark.sql("SELECT explode(sequence(DATE '2014-01-01', DATE '2021-01-01', interval 1 month)) AS month").withColumn(
        "value", 100 + 0.6 * F.months_between("month", F.lit("2014-01-01").cast("date")))
    named = {r.union_key: (r.union_name, r.slug) for r in built.unions.collect()}
    assert named["nafn:efling"] == ("Efling", "efling")
    ids = [(r.row_id, r.valid_from, r.union_name) for r in increases.orderBy("row_id").collect()]
    assert [i for i, *_ in ids] == list(range(1, len(ids) + 1)) and ids == sorted(ids, key=lambda r: (r[1], r[2] or "", r[0]))
    rates = spark.createDataFrame([("nafn:efling", dt.date(2015, 1, 1), dt.date(2016, 1, 1), 2.5)], "union_key string, from_date date, to_date date, pct double")
    out = tmp_path / "out"
    folder = Path(B.publish(built, rates, months, months.limit(0), str(out), "https://d.example"))
    told = json.loads((out / "index.json").read_text())
    assert told["utgafa"] == folder.name
    assert (told["tolur"]["haekkanir"], told["tolur"]["felog"], told["tolur"]["taxtahaekkanir"]) == (built.increases.count(), built.unions.count(), 1)
    assert told["tolur"]["ar"] == [2015, 2019]
    assert {f.stem for f in (folder / "felog").iterdir()} == {r.slug for r in built.unions.collect()}
    document = json.loads((folder / "felog" / "efling.json").read_text())
    assert [h["prosenta"] for h in document["haekkanir"]] == [3.5, 2.5, 3.0, 2.0, 2.75]
    assert document["taxtahaekkanir"] == [{"fra_dags": "2015-01-01", "prosenta": 2.5, "til_dags": "2016-01-01"}]
    assert {k: document[k] for k in ("audkenni", "felag", "fyrsta", "sidasta", "fjoldi_haekkana", "heilleiki")} == {
        "audkenni": "efling", "felag": "Efling", "fyrsta": "2015-01-01", "sidasta": "2019-04-01", "fjoldi_haekkana": 5, "heilleiki": "samfelld"}
    assert document["adalsamningur"]["motadili"] == "sa" and document["adalsamningur"]["heiti"]
    assert len(document["samningar"]) == document["fjoldi_samninga"]
    line = document["samningar"][0]
    assert sorted(line) == sorted(["motadili", "motadili_heiti", "tegund", "adalsamningur", "erft_fra", "fjoldi_haekkana", "fyrsta", "sidasta", "samfelld_fra",
                                   "samfelld_ar", "eldri_eydur", "heilleiki", "haekkanir"])
    assert line["adalsamningur"] is True and line["erft_fra"] is None and line["haekkanir"] == document["haekkanir"]
    assert sorted(line["haekkanir"][0]) == sorted(B.ROW_FIELDS)
    years = spark.read.json(f"{folder}/ar/haekkanir")
    assert years.count() == built.increases.count() and set(spark.read.json(f"{folder}/ar/fjoldi").columns) == {"ar", "fjoldi"}
    assert spark.read.json(f"{folder}/felog_skra").where(f"slod = 'https://d.example/{folder.name}/felog/efling.json'").count() == 1
    # a run that stops on its way leaves the publication as it was
    with pytest.raises(Exception, match="lost"):
        broken = rates.withColumn("pct", F.raise_error(F.lit("lost")).cast("double"))
        B.publish(built, broken, months, months.limit(0), str(out), "https://d.example")
    assert json.loads((out / "index.json").read_text()) == told and (folder / "felog" / "efling.json").exists()
    report = B.check(built, months, months.limit(0), F.lit(dt.date(2026, 7, 1)))
    failed = {r.check for r in report.collect() if not r.passed}
    assert failed == {"vísitala neysluverðs til"}


SCAN = """Launatafla 1.5.2015
Mánaðarlaun
Starfsaldur Byrjunarl. 1 ár 3 ár
Launaflokkur 4   476.379 481.143 490.000
5 | 480.000 | 485.000 | 470.000
4 500.000 510.000 520.000
lína án talna
6 35.000
Yfirvinnukaup
4 4.763,79 4.811,43
"""


def test_scanner(spark):
    docs = spark.createDataFrame([(1, SCAN), (2, "4 300.000 310.000\n4 301.000 311.000\n"), (3, "ekkert")], "doc_id long, text string")
    rows = W.scan_wage_tables(docs).orderBy("doc_id", "line_no", "step_no").collect()
    got = [(r.doc_id, str(r.valid_from), r.table_no, r.unit, r.grade, r.step_no, r.step, r.wage) for r in rows]
    day = "2015-05-01"
    assert got == [
        (1, day, 3, "mánaðarlaun", "4", 1, "Byrjunarl.", 476379.0), (1, day, 3, "mánaðarlaun", "4", 2, "1 ár", 481143.0),
        (1, day, 3, "mánaðarlaun", "4", 3, "3 ár", 490000.0),
        (1, day, 3, "mánaðarlaun", "5", 1, "Byrjunarl.", 480000.0), (1, day, 3, "mánaðarlaun", "5", 2, "1 ár", 485000.0),
        (1, day, 3, "mánaðarlaun", "5", 3, "3 ár", 470000.0),
        (1, day, 4, "mánaðarlaun", "4", 1, "Byrjunarl.", 500000.0), (1, day, 4, "mánaðarlaun", "4", 2, "1 ár", 510000.0),
        (1, day, 4, "mánaðarlaun", "4", 3, "3 ár", 520000.0),
        (1, day, 6, "yfirvinnukaup", "4", 1, "Byrjunarl.", 4763.79), (1, day, 6, "yfirvinnukaup", "4", 2, "1 ár", 4811.43),
        (2, "None", 1, "mánaðarlaun", "4", 1, "", 300000.0), (2, "None", 1, "mánaðarlaun", "4", 2, "", 310000.0),
        (2, "None", 1, "mánaðarlaun", "4", 1, "", 301000.0), (2, "None", 1, "mánaðarlaun", "4", 2, "", 311000.0),
    ]
    steps = {(r.grade, r.step_no, r.table_no): r.remark for r in W.check_steps(W.scan_wage_tables(docs).where("doc_id = 1")).collect()}
    assert steps[("5", 3, 3)] == "lægra en fyrra þrep" and steps[("5", 2, 3)] == ""


@pytest.mark.parametrize("names, slugs", [
    (["X", "X 2", "X", "X", "Ö ð", "", "þ-Æ"], ["x", "x-2", "x-3", "x-4", "o-d", "ohekkt", "th-ae"]),
    (["X", "X", "X 2"], ["x", "x-2", "x-2-2"]),
    (["X", "X", "X 2", "X 2", "X 2 2", "X"], ["x", "x-2", "x-2-2", "x-2-3", "x-2-2-2", "x-3"]),
    (["X 3", "X", "X", "X", "X", "X 99999999999", "X"], ["x-3", "x", "x-2", "x-4", "x-5", "x-99999999999", "x-6"]),
    (["Y", "Y 2"] + ["Y"] * 30, ["y", "y-2"] + [f"y-{i}" for i in range(3, 33)]),
])
def test_slugs_are_given_in_order(spark, names, slugs):
    df = spark.createDataFrame(list(enumerate(names)), "i long, name string")
    got = {r.i: r.slug for r in sinks.with_slugs(df, "name", "i", block=2).collect()}
    assert [got[i] for i in range(len(names))] == slugs


def plain_slugs(slugs):
    taken, out = set(), []
    for base in slugs:
        told, n = base, 2
        while told in taken:
            told, n = f"{base}-{n}", n + 1
        taken.add(told)
        out.append(told)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_slugs_are_those_of_one_pass(spark, seed):
    """Runs of numbered names before, between and after the name itself, and names with two numbers."""
    rng = random.Random(seed)
    names = [rng.choice(["A"] * 6 + [f"A {i}" for i in range(2, 40)] + ["A 2 2", "A 2 3", "A 3 2", "A 1", "B 2", "B"]) for _ in range(rng.choice([60, 300]))]
    names += [f"D {i}" for i in range(2, 60)] + ["D"] * 5 + [f"E {i}" for i in range(2, 9)] * 2 + ["E"] * 30
    df = spark.createDataFrame(list(enumerate(names)), "i long, name string")
    got = {r.i: r.slug for r in sinks.with_slugs(df, "name", "i", block=7).collect()}
    assert [got[i] for i in range(len(names))] == plain_slugs([n.lower().replace(" ", "-") for n in names])


def test_one_name_beside_a_large_number(spark):
    """A name that is a large number of another is no reason to go through that one's rows."""
    df = spark.range(200_000).select(F.col("id").alias("i"), F.when(F.col("id") == 5, "felag 90000").otherwise("felag").alias("name"))
    got = sinks.with_slugs(df, "name", "i", block=1000)
    assert got.select("slug").distinct().count() == 200_000
    some = {r.i: r.slug for r in got.where("i in (0, 1, 5, 89999, 90000, 199999)").collect()}
    assert some == {0: "felag", 1: "felag-2", 5: "felag-90000", 89999: "felag-89999", 90000: "felag-90001", 199999: "felag-200000"}


def test_slugs_of_many_names_are_unique(spark):
    rng = random.Random(9)
    names = [rng.choice(["A", "A 2", "A 3", "A 2 2", "B", "", "C 7", "C"]) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(names)), "i long, name string")
    got = [r.slug for r in sinks.with_slugs(df, "name", "i", block=50).collect()]
    assert len(set(got)) == 400


def test_inventory_of_folders_with_pattern_characters(spark, tmp_path):
    root = tmp_path / "a(1) [x] + $"
    for name in ("s1/x.pdf", "s1/deep/y.pdf", "s2/z.pdf"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(name.encode())
    # brackets in a folder to be listed are a glob pattern to the file system and are escaped by the caller
    listed = str(root).replace("[", "\\[").replace("]", "\\]")
    got = {(r.path, r.source, r["size"]) for r in tables.document_inventory(spark, listed, root=str(root)).collect()}
    assert got == {("s1/x.pdf", "s1", 8), ("s1/deep/y.pdf", "s1", 13), ("s2/z.pdf", "s2", 8)}


def test_links_of_pages(spark):
    pages = [(1, "https://a.is/p/", """<script>{"u":"https:\\/\\/a.is\\/k.pdf"}</script>"""),
             (2, "https://a.is/p/", '<a href="/k.pdf">second</a><a href="/x?a=1&amp;b=2">A &amp; B&#39;s &#xe6;</a><a href=/bare>c</a>'
                                    "<a href='/quoted \"x'>d</a>")]
    df = N.page_links(spark.createDataFrame(pages, "page_order long, url string, html string"), keep=["page_order"])
    got = [(r.link, r.text, r.kind) for r in df.orderBy("page_order", "kind", "place").collect()]
    assert got == [("https://a.is/k.pdf", "", 1), ("https://a.is/k.pdf", "second", 0), ("https://a.is/x?a=1&b=2", "A & B's æ", 0),
                   ("https://a.is/bare", "c", 0), ('https://a.is/quoted "x', "d", 0), ("https://a.is/k.pdf", "", 1)]
    first = N.discover_documents(df.withColumn("source", F.lit("s"))).first()
    assert (first.link, first.text, first.found_on) == ("https://a.is/k.pdf", "", "https://a.is/p/")  # the earlier page, though a script


def test_a_path_of_many_steps(spark):
    url = "https://a.is/" + "/".join(["s"] * 10_050)
    got = spark.range(1).select(N.resolve_link(F.lit("https://a.is/"), F.lit(url + "/./x")).alias("u")).first().u
    assert got == url + "/x"


def test_first_and_last_entries_of_url_lists(spark):
    frame = lambda rows, names: spark.createDataFrame(rows, names + ", url string, place long")
    rows = spark.createDataFrame([(1, "7", "a\\x.pdf"), (2, None, "a/x.pdf"), (3, None, "none")], "row long, contract_id string, document string")
    got = R.attach_urls(rows, frame([("7", "zz", 1), ("7", "aa", 2)], "contract_id string"),
                        frame([("a/x.pdf", "z", 1), ("a/x.pdf", "b", 2)], "document string"), frame([("a/x.pdf", "a", 1)], "document string"))
    assert {r.row: r.url for r in got.collect()} == {1: "aa", 2: "z", 3: ""}


def test_intake_reads_each_document_once(spark, tmp_path):
    def put(name, rows):
        spark.createDataFrame(rows, intake.SCHEMA).write.parquet(str(tmp_path / "in" / name))
    a = ("u1", "2. gr. Launahækkanir. Laun hækka um 3,5% þann 1. apríl 2015.", dt.date(2015, 1, 1), None)
    put("x=1", [a])
    intake.read_new_documents(spark, str(tmp_path / "in" / "*"), str(tmp_path / "out"), f"t{tmp_path.name}").awaitTermination()
    put("x=2", [("u2", *a[1:]), ("u3", a[1].replace("3,5", "2,5"), *a[2:])])
    intake.read_new_documents(spark, str(tmp_path / "in" / "*"), str(tmp_path / "out"), f"t{tmp_path.name}").awaitTermination()
    def found():
        return sorted((r.url, r.pct) for r in spark.read.parquet(str(tmp_path / "out" / "increases")).select("url", "pct").collect())
    assert found() == [("u1", 3.5), ("u3", 2.5)]
    progress = next((tmp_path / "out").glob("progress-*"))
    progress.rename(tmp_path / "lost")  # without its progress the stream starts over, the manifest knows what was read
    put("x=3", [("u4", a[1].replace("3,5", "4,5"), *a[2:])])
    intake.read_new_documents(spark, str(tmp_path / "in" / "*"), str(tmp_path / "out"), f"t{tmp_path.name}").awaitTermination()
    assert found() == [("u1", 3.5), ("u3", 2.5), ("u4", 4.5)]


def test_intake_knows_by_its_state_what_it_has_read(spark, tmp_path):
    """The manifest is not read while there is progress: without it known URLs and contents are skipped all the same."""
    text = "2. gr. Launahækkanir. Laun hækka um {}% þann 1. apríl 2015."

    def put(name, rows):
        spark.createDataFrame([(u, text.format(p), dt.date(2015, 1, 1), None) for u, p in rows], intake.SCHEMA).write.parquet(str(tmp_path / "in" / name))
        intake.read_new_documents(spark, str(tmp_path / "in" / "*"), str(tmp_path / "out")).awaitTermination()

    put("x=1", [("u1", "3,5"), ("u2", "2,5"), ("u3", "2,5"), (None, "1,5")])
    (tmp_path / "out" / "manifest").rename(tmp_path / "away")
    put("x=2", [("u1", "4,5"), ("u4", "3,5"), ("", "5,5"), (None, "6,5"), ("u5", "7,5")])
    got = sorted(r.pct for r in spark.read.parquet(str(tmp_path / "out" / "increases")).select("pct").collect())
    assert got == [1.5, 2.5, 3.5, 5.5, 6.5, 7.5]


def test_csv_with_mark_and_blank_rows(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes("﻿felag,prosenta\nEfling,3.5\n,\n\"VR, \"\"x\"\"\",\n".encode())
    rows = tables.read_table(spark, str(path), ["felag", "prosenta"]).collect()
    assert [tuple(r) for r in rows] == [("Efling", "3.5"), ('VR, "x"', None)]


def test_cube_from_text(spark):
    raw = '{"id":["a","b"],"size":[2,2],"dimension":{"a":{"label":"A","category":{"index":{"y":1,"x":0},"label":{"x":"X","y":"Y"}}},"b":{"label":"B","category":{"index":{"1":0,"2":1}}}},"value":[1,null,3,4]}'
    df = tables.cube_columns(spark.createDataFrame([(raw,)], "j string"), "j", ["a", "b"])
    rows = tables.flatten_cube(df, ["a", "b"]).collect()
    assert sorted(tuple(r) for r in rows) == [("X", "1", 1.0), ("Y", "1", 3.0), ("Y", "2", 4.0)]
