"""Reading JSON arrays in parts, document files with commit, nested beginnings, positional names, restarts by doubled pointers."""
import json
import os
import random
import sys
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rungline.operators import rates as W  # noqa: E402
from rungline.operators import resolve as R  # noqa: E402
from rungline.operators import review as V  # noqa: E402
from rungline.sources import sinks, tables  # noqa: E402

few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

NASTY = st.text(alphabet=st.sampled_from(list('{}[]",:\\ \n\tþaé ')), max_size=12)


@pytest.fixture()
def small_ranges(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@few
@given(st.lists(st.lists(st.tuples(NASTY, st.one_of(st.none(), NASTY)), max_size=40), min_size=1, max_size=3), st.sampled_from([None, 2]), st.booleans())
def test_objects_of_arrays_read_in_ranges(spark, small_ranges, tmp_path_factory, arrays, indent, ascii_only):
    """What a JSON parser reads, whatever stands inside the strings, and however ranges cut a file."""
    folder = tmp_path_factory.mktemp("arrays")
    for k, rows in enumerate(arrays):
        listed = [{"id": str(i), "filename": a, "nested": {"x": [{}, {"y": a}]}, "ocr_text": b} for i, (a, b) in enumerate(rows)]
        (folder / f"{k}.json").write_text(json.dumps(listed, indent=indent, ensure_ascii=ascii_only) + "\n", encoding="utf-8")
    got = sorted(((r.id, r.filename, r.ocr_text) for r in tables.read_contracts(spark, str(folder)).collect()), key=repr)
    assert got == sorted(((str(i), a, b) for rows in arrays for i, (a, b) in enumerate(rows)), key=repr)


def test_one_large_array_is_read_by_many_tasks(spark, small_ranges, tmp_path):
    rows = [{"id": str(i), "fra": "2020-02-03T00:00", "til": "x", "ocr_text": f"}} {{ \"þ{i}\\" * (i % 50)} for i in range(800)]
    (tmp_path / "a.json").write_text(json.dumps(rows), encoding="utf-8")
    read = tables.read_contracts(spark, str(tmp_path / "a.json"))
    got = {r.id: (str(r.fra), r.til, r.ocr_text) for r in read.collect()}
    assert got == {r["id"]: ("2020-02-03", None, r["ocr_text"]) for r in rows}
    assert spark.read.text(str(tmp_path / "a.json"), lineSep="}").rdd.getNumPartitions() > 8


def test_lines_single_objects_and_nothing(spark, tmp_path):
    (tmp_path / "lines").write_text('{"id": "1"}\n{"id": "2", "tegund": null}\n')
    (tmp_path / "one").write_text('﻿{"id": "3"}')
    (tmp_path / "none").write_text("[]")
    (tmp_path / "empty").write_text("")
    assert sorted(r.id for r in tables.read_contracts(spark, str(tmp_path)).collect()) == ["1", "2", "3"]


@few
@given(st.lists(st.lists(NASTY, min_size=1, max_size=5, unique=True), min_size=1, max_size=3), st.integers(0, 999), st.sampled_from([None, 1]), st.booleans())
def test_cubes_are_read_cell_by_cell(spark, small_ranges, tmp_path_factory, dims, seed, indent, ahead):
    """Any names of members, files in which the values stand before or after them, cut anywhere."""
    rng, folder = random.Random(seed), tmp_path_factory.mktemp("cubes")
    ids, size = [f"d{i}" for i in range(len(dims))], [len(d) for d in dims]
    n = 1
    for k in size:
        n *= k
    want = []
    for file in range(2):
        values = [rng.choice([None, rng.randint(-9, 9), rng.random() * 1e6]) for _ in range(n)]
        described = {i: {"label": "value", "category": {"index": {f"c{k}": k for k in range(len(d))}, "label": {f"c{k}": m for k, m in enumerate(d)}}}
                     for i, d in zip(ids, dims)}
        cube = {"id": ids, "value": values, "size": size, "dimension": described} if ahead else {"id": ids, "size": size, "dimension": described, "value": values}
        (folder / f"{file}.json").write_text(json.dumps(cube, indent=indent, ensure_ascii=False), encoding="utf-8")
        for at, v in enumerate(values):
            members = []
            for d in reversed(dims):
                members.append(d[at % len(d)])
                at //= len(d)
            want += [(*reversed(members), float(v))] if v is not None else []
    got = tables.read_cubes(spark, str(folder), ids)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    some = tables.read_cubes(spark, str(folder), ids, {ids[-1]: [dims[-1][0]]})
    assert sorted(map(tuple, some.collect())) == sorted(w for w in want if w[-2] == dims[-1][0])


def test_a_large_cube_is_many_rows(spark, small_ranges, tmp_path):
    n = 3000
    cube = {"size": [n, 2], "dimension": {"a": {"category": {"index": {str(i): i for i in range(n)}}}, "b": {"category": {"index": {"x": 0, "y": 1}}}},
            "value": list(range(2 * n))}
    (tmp_path / "c.json").write_text(json.dumps(cube))
    got = tables.read_cubes(spark, str(tmp_path / "c.json"), ["a", "b"], {"b": ["y"]})
    assert sorted((int(r.a), r.value) for r in got.collect()) == [(i, 2.0 * i + 1) for i in range(n)]


def test_document_files_are_there_as_a_whole_or_not_at_all(spark, tmp_path):
    rows = spark.range(200).select(F.concat("id", F.lit(".json")).alias("name"), F.concat(F.lit('{"þ":'), "id", F.lit("}")).alias("body")).repartition(7)
    target = str(tmp_path / "v1" / "felog")
    sinks.write_documents(rows, target)
    assert {f: (tmp_path / "v1" / "felog" / f).read_text() for f in os.listdir(target)} == {f"{i}.json": f'{{"þ":{i}}}' for i in range(200)}
    broken = rows.withColumn("body", F.when(F.col("name") == "77.json", F.raise_error(F.lit("lost"))).otherwise(F.col("body")))
    with pytest.raises(Exception, match="lost"):
        sinks.write_documents(broken, str(tmp_path / "v2" / "felog"))
    assert not os.path.exists(tmp_path / "v2" / "felog") and [f for f in os.listdir(tmp_path / "v2") if "writing" in f] == []
    sinks.write_documents(rows.limit(0), str(tmp_path / "v3" / "felog"))
    assert os.listdir(tmp_path / "v3" / "felog") == []


WORD = st.text(alphabet="abc", min_size=1, max_size=9)


@few
@given(st.lists(WORD, max_size=40), st.lists(WORD, max_size=60))
def test_words_begin_with_their_stems(spark, stems, words):
    got = R.beginnings(spark.createDataFrame([(w,) for w in words], "word string"), spark.createDataFrame([(s,) for s in stems], "stem string"))
    long = sorted({s for s in stems if len(s) >= 5}, key=len)
    want = {w: [s for s in long if w.startswith(s)] for w in words}
    assert {r.word: r.stems for r in got.collect()} == {w: s for w, s in want.items() if s}


def test_stems_nest_over_many_blocks(spark):
    random.seed(4)
    stems = ["aaaaa" + "".join(random.choices("ab", k=random.randint(0, 7))) for _ in range(150)] + ["aaaaa"]
    words = [random.choice(stems) + "".join(random.choices("ab", k=random.randint(0, 3))) for _ in range(1500)] + ["baaaa", "aaaa", "é" * 6]
    got = R.beginnings(spark.createDataFrame([(w,) for w in words], "word string"), spark.createDataFrame([(s,) for s in stems], "stem string"))
    want = {w: sorted({s for s in stems if w.startswith(s)}, key=len) for w in words}
    assert {r.word: r.stems for r in got.collect()} == {w: s for w, s in want.items() if s}


def test_company_with_the_longest_stem(spark):
    companies = spark.createDataFrame([("Storveldi ehf.",), ("Storveldisfelag hf.",), ("Eflingarhus ehf.",), ("null",), (None,)], "company string")
    unions = spark.createDataFrame([("Eflingar",), ("Verslun",)], "union_name string")
    stems = R.company_stems(companies, unions)
    assert {r.stem for r in stems.collect()} == {"storveld", "storveldisfela"}
    texts = spark.createDataFrame([("Samningur Storveldisfelagsins",), ("við Stórveldið",), ("Storvel",), ("",), (None,)], "text string")
    assert {r.text: r.company_id for r in R.find_company(texts, stems).collect()} == {
        "Samningur Storveldisfelagsins": "fy-storveldisfelag", "við Stórveldið": "fy-storveldi"}


PIECE = st.text(alphabet="ab ", max_size=9)


@few
@given(st.lists(PIECE, max_size=25), st.lists(st.tuples(st.one_of(st.none(), PIECE), st.one_of(st.none(), PIECE)), max_size=25))
def test_names_stand_in_texts(spark, names, texts):
    got = V.names_in_texts(spark.createDataFrame([(n,) for n in names], "n string"), spark.createDataFrame(texts, "a string, b string"), "n", ["a", "b"])

    def within(name, value):
        if value is None or name not in value:
            return False
        return len(name) > 4 or any(value[i:i + len(name)] == name and not value[max(i - 1, 0):i].isalnum() and not value[i + len(name):i + len(name) + 1].isalnum()
                                    for i in range(len(value)))

    want = {(n, a, b) for n in names if len(n) >= 3 for a, b in texts if within(n, a) or within(n, b)}
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want)


def test_a_piece_that_all_texts_share_forms_no_pairs(spark):
    """Each name has the shared pieces and one of its own; only its own texts are met."""
    names = spark.range(300).select(F.concat(F.lit("félag"), F.lpad("id", 4, "0")).alias("n"))
    texts = spark.range(3000).select(F.concat(F.lit("félag"), F.lpad(F.col("id") % 600, 4, "0"), F.lit(" og félag")).alias("a"), "id")
    assert V.names_in_texts(names, texts, "n", ["a"]).count() == 300


def plain_restarts(grades):
    seen, at = set(), []
    for i, g in enumerate(grades):
        if g in seen:
            at.append(i)
            seen = set()
        seen.add(g)
    return at


@few
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 2), st.lists(st.sampled_from("abcde"), max_size=60)), max_size=5, unique_by=lambda x: x[:2]))
def test_restarts_are_those_of_one_pass(spark, tables_):
    rows, want = [], set()
    for doc, header, grades in tables_:
        start = header * 1000
        rows += [(doc, header, (start + i) // 7, start + i, g) for i, g in enumerate(grades)]
        want |= {(doc, start + i) for i in plain_restarts(grades)}
    df = spark.createDataFrame(rows, "doc_id int, _headers int, _block int, line_no int, _grade string")
    got = [(r.doc_id, r.line_no) for r in W._restarts(df, "doc_id").collect()]
    assert set(got) == want and len(got) == len(want)


def test_many_lines_under_one_header(spark):
    random.seed(2)
    grades = [random.choice("abcdefghij") for _ in range(20_000)]
    df = spark.createDataFrame([(1, 0, i // 512, i, g) for i, g in enumerate(grades)], "doc_id int, _headers int, _block int, line_no int, _grade string")
    assert sorted(r.line_no for r in W._restarts(df, "doc_id").collect()) == plain_restarts(grades)
