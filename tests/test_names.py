"""Counterparties, companies, unions, numbers: expected ids of the regression cases."""
from pyspark.sql import functions as F

from rungline.functions import text as T
from rungline.operators import resolve as R

REGISTER = [
    ("Samtök atvinnulífsins, SA", "sa"),
    ("Samtök atvinnulífsins, SA (millilandaskip)", "sa"),
    ("SA Greiðasala", "sa"),
    ("VSÍ", "sa"),
    ("Vinnuveitendasamband Íslands, Vinnumálasambands samvinnufélaganna", "sa"),
    ("Samtök rafverktaka", "sa"),
    ("Samninganefnd bankanna", "sa"),
    ("Ríkissjóður, SNR", "riki"),
    ("Ríkissjóður, SNR, Landhelgisgæsla Íslands", "riki"),
    ("Samband íslenskra sveitarfélaga", "sveitarfelog"),
    ("Reykjavíkurborg", "reykjavikurborg"),
    ("Félag atvinnurekenda", "fa"),
    ("Landssamband íslenskra útvegsmanna", "sfs"),
    ("Síminn hf.", "fy-siminn"),
    ("Símans hf.", "fy-siminn"),
    ("RARIK ohf.", "fy-rarik"),
    ("RARIK", "fy-rarik"),
    ("Advania Ísland ehf.", "fy-advania-island"),
    ("", "othekktur"),
    (None, "othekktur"),
]
DOCUMENTS = [
    ("", "SAMTAKA ATVINNULÍFSINS", "vr/samningur.pdf", "vr", "sa"),
    ("Samtaka atvinnulífsins", "Starfsgreinasambands Íslands", "sgs/x.pdf", "sgs", "sa"),
    ("", "Félags atvinnurekenda", "vr/fa.pdf", "vr", "fa"),
    ("fjármála- og efnahagsráðherra f.h. ríkissjóðs", "", "x.pdf", "bsrb", "riki"),
    ("SAMBANDS ÍSLENSKRA SVEITARFÉLAGA F.H. ÞEIRRA SVEITARFÉLAGA", "", "x.pdf", "sgs", "sveitarfelog"),
    ("Reykjavíkurborgar", "", "x.pdf", "efling", "reykjavikurborg"),
    ("fylgiskjöl", "miðlunargrein", "sgs/kjarasamningur-sgs-og-sambands-islenskra-sveitarfelaga-2020.pdf", "sgs", "sveitarfelog"),
    ("", "", "reykjavik/kalfur-rvk-sameyki-loka.pdf", "reykjavik", "reykjavikurborg"),
    ("", "", "sa/kjoelfar_loka.pdf", "sa", "sa"),
    ("fylgiskjöl", "ANNARRA AÐILA", "grafia/kynning.pdf", "grafia", "othekktur"),
    ("Landsvirkjunar", "", "x.pdf", "vr", "fy-landsvirkjun"),
]
COMPANIES = ["Landsvirkjun", "Norðurorka hf.", "Rafiðnaðarsamband Íslands"]
UNIONS = ["Rafiðnaðarsamband Íslands"]


def test_register_counterparties(spark):
    rows = spark.createDataFrame([(i, n) for i, (n, _) in enumerate(REGISTER)], "i int, name string")
    got = {r.i: r.c.id for r in rows.select("i", T.counterparty_from_register(F.col("name")).alias("c")).collect()}
    assert got == {i: x for i, (_, x) in enumerate(REGISTER)}


def test_placeholders_are_companies_unless_listed(spark):
    row = spark.createDataFrame([("Ekki tilgreint",)], "n string").select(
        T.counterparty_from_register(F.col("n")).alias("a"),
        T.counterparty_from_register(F.col("n"), ("ekki tilgreint",)).alias("b")).first()
    assert (row.a.id, row.b.id) == ("fy-ekki-tilgreint", "othekktur")


def stems(spark):
    return R.company_stems(spark.createDataFrame([(c,) for c in COMPANIES], "company string"),
                           spark.createDataFrame([(u,) for u in UNIONS], "union_name string"))


def test_document_counterparties(spark):
    rows = spark.createDataFrame([(i, *d[:4]) for i, d in enumerate(DOCUMENTS)],
                                 "row_id long, party_1 string, party_2 string, document string, site string")
    got = {r.row_id: r.counterparty for r in R.counterparty_from_document(rows, stems(spark)).collect()}
    assert got == {i: d[4] for i, d in enumerate(DOCUMENTS)}


def test_company_stems(spark):
    texts = spark.createDataFrame([("Landsvirkjunar",), ("Norðurorku hf",), ("Rafiðnaðarsambands Íslands",)], "text string")
    got = {r.text: r.company_id for r in R.find_company(texts, stems(spark)).collect()}
    assert got == {"Landsvirkjunar": "fy-landsvirkjun", "Norðurorku hf": "fy-nordurorka"}


def test_union_names(spark):
    cases = [("Samiðnar", "samiðn"), ("Samiðn - Samband iðnfélaga", "samiðn"), ("Félag (deild 3) X, Y.", "félag x y"),
             ("Sjómannasambands", "sjómannasamband"), ("Efling stéttarfélag", "efling"), (None, "")]
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, n string")
    got = {r.i: r.x for r in rows.select("i", T.normalize_union(F.col("n")).alias("x")).collect()}
    assert got == {i: c[1] for i, c in enumerate(cases)}


def test_resolution_orders_differ(spark):
    known = spark.createDataFrame([("efling", "Efling"), ("vr", "VR")], "norm string, union_name string")
    docs = spark.createDataFrame([(1, "Efling og aðrir", "VR", "x"), (2, None, None, "vr"), (3, "a", "b", "x")],
                                 "row_id long, party_1 string, party_2 string, site string")
    whole = {r.row_id: (r.union_name, r.tracing) for r in R.resolve_union(docs, known).collect()}
    by_field = {r.row_id: r.union_name for r in R.resolve_union(docs, known, whole_first=False).collect()}
    assert whole == {1: ("VR", "aðili úr skjali"), 2: ("VR", "vefur félagsins"), 3: (None, "órakið")}
    assert by_field == {1: "Efling", 2: "VR", 3: None}


def test_numbers(spark):
    row = spark.range(1).select(
        T.parse_review_percent(F.lit(" 3,5 % ")).alias("p"), T.parse_review_amount(F.lit("kr. 23.750"), True).alias("a"),
        T.describe(F.lit(3.5), F.lit(23750)).alias("d"), T.describe(F.lit(None).cast("double"), F.lit(None).cast("int")).alias("n"),
        T.signed_percent(F.lit(-1.25)).alias("s"), T.parse_is_date(F.lit("31. febrúar 2001")).alias("bad")).first()
    assert (row.p, row.a, row.d, row.n, row.bad) == (3.5, 23750, "3,50% / 23.750 kr", "-", None)
    assert row.s in ("−1,2%", "−1,3%")
