"""Extraction: regression snippets, windows, years, and texts cut into parts."""
import collections
import datetime as dt

from pyspark.sql import functions as F

from rungline.functions import fixed as X
from rungline.functions import text as T
from rungline.functions.years import resolve_year
from rungline.operators import extract as E

# (text, an increase must be found); expected values of the regression cases
CASES = [
    ("launum starfsmanns til Menntunarsjóðs SSF6. 8.4 Starfsendurhæfingarsjóður "
     "8.4.1 Atvinnurekendur greiða 0,13%7 í VIRK-Starfsendurhæfingarsjóð. "
     "6 Gildir frá og með 1. júní 2024. 7 Gjald til VIRK-Starfsendurhæfingarsjóðs "
     "var tímabundið lækkað í 0,1% frá 1. janúar 2016.", False),
    ("7.gr. Orlofssjóður Frá 1. maí 2018 verður gjald í orlofssjóð 0,5% "
     "af heildarlaunum starfsmanns.", False),
    ("Launagreiðandi greiðir 0,55% af heildarlaunum starfsmanns í styrktarsjóð "
     "BHM. Frá og með 1. júlí 2020 breytist grein 14.2.1.", False),
    ("Eftirfarandi gildir frá 1. nóvember 2024: 1.6.1 Vaktaálag reiknast af "
     "dagvinnukaupi. Vaktaálag skal vera: 33,33%", False),
    ("Mánaðarlaun fyrir fullt starf skulu vera sem hér segir: "
     "Frá 1. júní 2018, kr. 300.000.", False),
    ("Launaþróunartrygging starfsmanna sem hófu störf fyrir 1. febrúar 2014.", False),
    ("Við 10 ára starfsaldur eða 35 ára aldur skal hann fá 11,59%. Við 15 ára "
     "starfsaldur eða 50 ára aldur skal hann fá 13,04%. Starfsmenn í "
     "launaflokki 112 - 121 fá þó 11,59%.", False),
    ("Orlofslaun reiknast 10,17% af heildarlaunum frá 1. maí 2020.", False),
    ("Persónuálag tekur eftirfarandi breytingum á samningstímanum: "
     "Frá 1. apríl 2024 — 1,6% Frá 1. apríl 2025 — 1,7% Frá 1. apríl 2027 — 1,8%", False),
    ("1.2.1 Uppgjörsgreiðsla fyrir tímabilið 1. apríl 2019 til "
     "31. október 2019 er kr 75.500, sem greiðist í nóvember.", False),
    ("kjarasamningi fjármálaráðherra f.h. ríkissjóðs og SGS. "
     "Laun hækka um 3,5% þann 1. janúar 2025.", True),
    ("Launabreytingar 1. janúar 2016 Þann 1. janúar 2016 hækka laun og "
     "launatengdir liðir um 6,2%, sbr. launaþróunartryggingu.", True),
    ("Kauptrygging hækkar á samningstímabilinu sem hér segir: "
     "1. janúar 2025 hækkar kauptrygging um 3,5%.", True),
    ("2. gr. Launahækkanir 1. janúar 2025: Laun hækka um 3,50% eða 23.750 kr.", True),
    ("3. grein. Áfangahækkanir. Á samningstímanum hækka laun sem hér segir: "
     "1. júní 1988 3,25% 1. september 1988 2,5%", True),
    ("2. gr. Launahækkanir 1. apríl 2020: Laun hækka um 18.000 kr.", True),
    ("Mánaðarlaun taka eftirfarandi hlutfallshækkunum með krónutöluhækkun að "
     "lágmarki: 1. apríl 2024 3,25% eða 23.750 kr. 1. apríl 2025 3,50% eða "
     "23.750 kr. Persónuálag tekur eftirfarandi breytingum á samningstímanum: "
     "Frá 1. apríl 2024 — 1,6%", True),
    ("Mánaðarlaun samkvæmt grein 1.1.1 skulu hækka hinn 1. september 1989 "
     "um 1.500 kr. Starfsmaður á rétt á orlofi samkvæmt lögum.", True),
]


def docs(spark, texts, start=dt.date(1985, 1, 1), end=dt.date(2028, 12, 31)):
    return spark.createDataFrame(
        [(i, t, start, end) for i, t in enumerate(texts)],
        "doc_id long, text string, validity_from date, validity_to date")


def test_regression_cases(spark):
    found = E.extract_increases(docs(spark, [t for t, _ in CASES])).select("doc_id").distinct().collect()
    assert {r.doc_id for r in found} == {i for i, (_, wanted) in enumerate(CASES) if wanted}


def test_values_do_not_leak_between_list_items(spark):
    rows = E.extract_increases(docs(spark, [CASES[14][0], CASES[13][0]])).collect()
    got = {(r.doc_id, str(r.valid_from), r.pct, r.amount, r.type) for r in rows}
    # "júní 1988" reads as a wage level ("í 1988"), as it does in the published data
    assert got == {
        (0, "1988-09-01", 2.5, None, "prósenta"),
        (1, "2025-01-01", 3.5, 23750, "prósenta eða krónutala")}


def test_long_texts_are_read_whole(spark, monkeypatch):
    filler = "Almenn ákvæði um vinnutíma og aðbúnað. " * 40
    clauses = [f"2. gr. Launahækkanir. Laun hækka um {p},5% þann 1. apríl {1990 + p}. " for p in range(1, 9)]
    text = "".join(filler + c for c in clauses) + filler
    whole = {(r.valid_from, r.pct, r.quotation) for r in E.extract_increases(docs(spark, [text])).collect()}
    assert len(whole) == 8
    for size in (1, 2, 3):
        monkeypatch.setattr(E, "CHUNK", size)
        cut = {(r.valid_from, r.pct, r.quotation) for r in E.extract_increases(docs(spark, [text])).collect()}
        assert cut == whole


def test_a_text_is_searched_for_dates_once(spark):
    texts = [CASES[13][0], CASES[14][0], CASES[16][0], "1. maí 2020", "ekkert", "", None]
    parts = spark.createDataFrame([(i, x) for i, t in enumerate(texts) for x in (t, t and t + E.MARK)], "i int, _part string")
    got = collections.defaultdict(list)
    for r in E.matches(parts, "_part", X.DATE_IN_TEXT).collect():
        got[r.i].append((r._first, r._found, [g.rstrip(E.MARK) for g in r._gaps], r._local.rstrip(E.MARK), r._ends))
    assert sorted(got) == [0, 1, 2, 3] and all(len(v) == 2 and v[0] == v[1] for v in got.values())
    for i, ((_, found, gaps, local, _), _) in got.items():
        assert "".join(g + m for g, m in zip(gaps, [*found, ""])) == local and local == texts[i]


YEARS = [
    (1, 6, 2005, "2004-01-01", "2006-12-31", "2005-06-01", "úr texta"),
    (1, 6, 2005, None, None, "2005-06-01", "úr texta"),
    (31, 2, 2005, None, None, None, None),
    (1, 6, 2095, "2004-01-01", "2006-12-31", "2005-06-01", "leiðrétt"),
    (1, 6, 1954, "2004-01-01", "2006-12-31", "1954-06-01", "grunsamlegt"),
    (1, 6, None, "2004-01-01", "2004-02-01", "2003-06-01", "ályktað (óvisst)"),
    (1, 6, None, None, None, None, None),
    (29, 2, None, "2003-03-01", "2004-03-01", "2004-02-29", "ályktað"),
    (1, 6, None, "2004-01-01", None, "2003-06-01", "ályktað (óvisst)"),
    (1, 6, None, None, "2004-01-01", "1997-06-01", "ályktað (óvisst)"),
]


def test_year_resolution(spark):
    rows = spark.createDataFrame(
        [(i, *[y[k] for k in range(5)]) for i, y in enumerate(YEARS)],
        "i int, day int, month int, year int, start string, end string")
    got = rows.select("i", resolve_year(
        F.col("day"), F.col("month"), F.col("year"), F.to_date("start"), F.to_date("end")).alias("r"))
    found = {r.i: (str(r.r.date) if r.r.date else None, r.r.status if r.r.date else None) for r in got.collect()}
    assert found == {i: (y[5], y[6]) for i, y in enumerate(YEARS)}


def test_parties_and_validity(spark):
    rows = spark.createDataFrame([
        ("Kjarasamningur milli Samtaka atvinnulífsins annars vegar og Eflingar hins vegar um kjör. "
         "Samningur þessi gildir frá 1. janúar 2019 til 1. nóvember 2022.", "vr.pdf"),
        ("milli Eflingar og Reykjavíkurborgar um kaup", "efling_2020-2023.pdf"),
        ("KJARASAMNINGUR\n\nFélag A\n\nog\n\nFélag B\n", "x.pdf"),
        ("ekkert hér", "y.pdf"),
    ], "text string, name string").select(
        T.extract_parties(F.col("text")).alias("p"), T.extract_validity(F.col("text"), F.col("name")).alias("v")).collect()
    assert [(r.p.party_1, r.p.party_2) if r.p else None for r in rows] == [
        ("Samtaka atvinnulífsins", "Eflingar"), ("Eflingar", "Reykjavíkurborgar"), ("Félag A", "Félag B"), None]
    assert [(str(r.v.valid_from), str(r.v.valid_to)) for r in rows] == [
        ("2019-01-01", "2022-11-01"), ("2020-01-01", "2023-12-31"), ("None", "None"), ("None", "None")]
