import itertools
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rungline.llm import labelled, licenses, quality, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_held_out_rows_are_never_sampled(spark, labels):
    got = {r["__id"] for r in labelled.sample(labels, "toxic").collect()}
    assert got == {r.doc_id for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5}
    assert labelled.sample(labels, "toxic", 10).count() == 10
    odd = spark.createDataFrame([(1, None, 1), (None, 1, 1), (1, 0, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    assert [tuple(r) for r in labelled.sample(odd, "quality").collect()] == [(1, 1)]


def test_toxicity_on_held_out_documents(docs, labels):
    got = toxicity.scored(docs, toxicity.learn(docs, labels)).join(labels, "doc_id")
    kept = got.where("held_out").select("predicted", "toxic", "score").collect()
    right = sum(r.predicted == r.toxic for r in kept)
    assert len(kept) > 50 and right >= 0.95 * len(kept)
    assert got.where((F.col("score") < 0) | (F.col("score") > 1)).isEmpty()
    assert got.where((F.col("predicted") == 1) != (F.col("score") >= 0.5)).isEmpty()


def test_labels_of_held_out_rows_change_nothing(docs, labels):
    turned = labels.withColumn("toxic", F.when(labelled.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.learn(docs, labels) == toxicity.learn(docs, turned)


@pytest.mark.parametrize("text", ["a loser here", "A LOSER here", "a l0ser here", "a 1oser here", "a lo$er here", "a lоsеr here",
                                  "a ｌｏｓｅｒ here", "a lo\u200bser here", "a los3r, here"])
def test_folding_finds_disguised_words(text):
    lexicon = toxicity.Lexicon({toxicity.fold("loser")[:-1]: 3.0})
    assert lexicon.measures(text, lexicon.automaton())[0] == 3.0


def test_exception_phrases_and_length():
    lexicon = toxicity.Lexicon({toxicity.fold("trash")[:-1]: 2.0}, [toxicity.fold("trash can")])
    found = lexicon.automaton()
    assert lexicon.measures("the trash can", found)[0] == 0.0
    assert lexicon.measures("the trash can and trash", found)[0] == 2.0
    assert lexicon.measures("room 101, 3 of 4, 1984", found)[0] == 0.0
    short, long = lexicon.measures("trash", found), lexicon.measures("trash " + "word " * 500, found)
    assert short[0] == long[0] and short[1] > long[1]


def test_learnt_exceptions(spark, make_docs):
    rows = [(i, f"some words number{i} " + ("vilestuff is bad" if i % 3 == 0 else "vilestuff remover works" if i % 3 == 1 else "fine day"), "s")
            for i in range(300)]
    marks = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i, _, _ in rows], "doc_id long, quality int, toxic int")
    lexicon = toxicity.learn(make_docs(rows), marks, ratio=1.5)
    scores = {r.doc_id: r.predicted for r in toxicity.scored(make_docs(rows), lexicon).collect()}
    assert all(scores[i] == int(i % 3 == 0) for i in scores)
    assert any("remover" in e for e in lexicon.exceptions)


def test_repeated_rows_of_an_id_are_learnt_from_once(docs, labels):
    hot = labels.where("toxic > 0").join(docs, "doc_id").where(~labelled.held_out(F.col("doc_id"))).agg(F.min("doc_id")).first()[0]
    copies = docs.where(F.col("doc_id") == hot).crossJoin(docs.sparkSession.range(500).select("id")).drop("id")
    assert toxicity.learn(docs.unionByName(copies), labels) == toxicity.learn(docs, labels)


def test_toxicity_of_hard_rows(spark, hard, nothing, labels, docs):
    lexicon = toxicity.learn(docs, labels)
    got = toxicity.scored(hard, lexicon).collect()
    assert len(got) == hard.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out for r in got if r.doc_id is None)
    assert {r.predicted for r in got if r.doc_id in (2, 3, 4)} == {0}
    kept = toxicity.clean_only(hard, lexicon)
    assert kept.columns == hard.columns and kept.count() == hard.count()
    assert toxicity.scored(nothing, lexicon).collect() == [] and toxicity.clean_only(nothing, lexicon).collect() == []
    empty = toxicity.learn(hard, labels.limit(0))
    assert empty.weights == {} and toxicity.scored(hard, empty).count() == hard.count()


def plain_counts(text):
    text = text or ""
    white = " \t\n\x0b\x0c\r"
    words, word = [], ""
    for c in text:
        if c in white:
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    words += [word] * bool(word)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = text.split("\n")
    with_word = [any(c not in white for c in line) for line in lines]
    dup = sum(w and line in lines[:i] for i, (line, w) in enumerate(zip(lines, with_word)))
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab  \n\n\t\x0b\x1c\x85\xa0é漢#|*"), max_size=60))
def test_counts_are_the_plain_ones(text):
    assert quality.statistics(text)[0] == plain_counts(text)


def test_repeats_with_many_words_in_use(monkeypatch):
    words = [b"w%d" % (i % 1300) for i in range(4000)]
    assert quality.repeated_words(words)[0] == 4000


def test_trees_separate_and_respect_monotone_constraints():
    rng = np.random.default_rng(6)
    x = rng.uniform(size=(3000, 4))
    y = ((x[:, 0] + 0.5 * x[:, 1] + 0.3 * np.sin(9 * x[:, 2]) + rng.normal(0, 0.1, 3000)) < 0.8).astype(float)
    model = quality.fit(x, y, {0: -1, 1: -1, 3: 1})
    assert ((model.probability(x) >= 0.5) == (y > 0)).mean() > 0.9
    some = x[:200]
    for f, sign in ((0, -1), (1, -1), (3, 1)):
        last = None
        for v in np.linspace(0, 1, 21):
            moved = some.copy()
            moved[:, f] = v
            p = model.probability(moved)
            assert last is None or (sign * (p - last) >= -1e-12).all()
            last = p


def test_trees_without_rows_or_with_one_class():
    assert quality.fit(np.zeros((0, 3)), np.zeros(0), {}).probability(np.ones((2, 3))).tolist() == [0.5, 0.5]
    assert (quality.fit(np.ones((9, 3)), np.ones(9), {}).probability(np.ones((2, 3))) > 0.5).all()


def test_quality_accuracy(docs, labels):
    known = quality.described(docs)
    model = quality.train(known, labels)
    rows = known.join(labels, "doc_id").where(labelled.held_out(F.col("doc_id"))).select("features", "quality").collect()
    p = model.probability(np.array([r.features for r in rows]))
    assert np.mean((p >= 0.5) == np.array([r.quality > 0 for r in rows])) > 0.95


def test_quality_of_hard_rows(hard, nothing, labels):
    got = quality.judged(hard, labels)
    found = got.collect()
    assert len(found) == hard.count()
    assert sorted(map(str, (([r[c] for c in quality.BASE]) for r in found))) == sorted(str(plain_counts(r.text)) if len(r.text or "") < 9999 else str(
        quality.statistics(r.text)[0]) for r in hard.collect())
    assert all(r.base_failed and not r.kept for r in found if r.n_words < 50)
    assert quality.judged(nothing, labels).collect() == []
    assert quality.judged(hard, labels.limit(0)).count() == hard.count()


def plain_matches(text):
    """Whether any stretch of 1.25 times a template's shingles holds 80 % of them."""
    words = licenses.words_of(text)
    shingles = licenses._shingles(words)
    out = set()
    for name, template in licenses.TEMPLATES.items():
        own = licenses._shingles(licenses.words_of(template))
        room = int(1.25 * len(own)) + 1
        for a in range(len(shingles)):
            if shingles[a] in own and len(set(shingles[a:a + room]) & set(own)) >= 0.8 * len(set(own)):
                out.add(name)
    return out


def noise(rng, n):
    return " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n))


def test_licenses_against_a_full_scan(make_docs):
    rng = np.random.default_rng(8)
    rows = []
    for k, (name, template) in enumerate(itertools.islice(itertools.cycle(licenses.TEMPLATES.items()), 80)):
        words = template.split()
        if k % 4 == 1:
            words[len(words) // 2] = "altered"
        if k % 4 == 2:
            words = words[: int(len(words) * 0.9) + 1]
        if k % 4 == 3:
            words = words[: len(words) // 2]
        rows.append((k, f"{noise(rng, int(rng.integers(0, 90)))} {' '.join(words).upper() if k % 5 == 0 else ' '.join(words)} {noise(rng, int(rng.integers(0, 90)))}", "s"))
    got = {}
    for r in licenses.scan(make_docs(rows)).collect():
        got.setdefault(r.doc_id, set()).add(r.template)
    assert got == {i: m for i, t, _ in rows if (m := plain_matches(t))}


def test_license_spans(make_docs):
    line = "Released under the MIT License."
    got = licenses.scan(make_docs([(1, f"one two three {line} four {line}", "s"), (2, line, "s")])).orderBy("doc_id", "first_word").collect()
    assert [tuple(r) for r in got] == [(1, "mit-line", 3, 8, 1.0), (1, "mit-line", 9, 14, 1.0), (2, "mit-line", 0, 5, 1.0)]


def test_licenses_in_hard_rows(hard, nothing, make_docs):
    assert licenses.scan(hard).collect() == [] and licenses.scan(nothing).collect() == []
    twice = make_docs([(1, licenses.TEMPLATES["mit"], "s")] * 2 + [(None, licenses.TEMPLATES["isc"] + " x " * 100_000, "s")])
    assert sorted((str(r.doc_id), r.template) for r in licenses.scan(twice).collect()) == [("1", "mit"), ("1", "mit"), ("None", "isc")]
    assert licenses.scan(hard, {"none": "", "tiny": "word"}).select("doc_id", "template").collect() == [(9, "tiny")]
