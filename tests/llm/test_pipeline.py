import collections
import random
import re
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from rungline.llm import graph, packing, queries, toxicity  # noqa: E402

from .test_mixing_chat import plain_targets  # noqa: E402
from .test_near_duplicates import broadcasts, covered, plain_fingerprint, smallest  # noqa: E402
from .test_tokens_packing_grammar import check_pieces  # noqa: E402

SF = "/root/testdata/sf0.001"


def words(text):
    return len((text or "").encode().split())


def only_long_runs(raw, mask):
    """Takes runs of at most 50 whole words and under 400 bytes out of the mask, as the stage leaves them."""
    for m in list(re.finditer(b"\1+", mask)):
        a, b = m.span()
        whole = [w for w in re.finditer(rb"\S+", raw) if a <= w.start() and w.end() <= b]
        if len(whole) <= 50 and b - a < 400:
            mask[a:b] = bytes(b - a)


def test_each_stage_against_a_plain_version(spark, tmp_path):
    """Every stage on all that the one before kept."""
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        before, after = docs.collect(), out.collect()
        if name != "packing":
            assert out.dtypes == docs.dtypes
        if name == "toxicity":
            lexicon = toxicity.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            found = lexicon.automaton()
            rejected = {r.doc_id for r in before if lexicon.score(*lexicon.measures(r.text, found)) >= 0.5}
            assert {r.doc_id for r in after} == {r.doc_id for r in before} - rejected
        elif name == "simhash":
            prints = {r.doc_id: plain_fingerprint(r.text) for r in before}
            ids = sorted(prints)
            pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if (prints[a] ^ prints[b]).bit_count() <= 3]
            assert sorted(r.doc_id for r in after) == sorted(set(smallest(ids, pairs).values()))
        elif name == "suffix_array":
            masks = covered([r.text.encode() for r in before], 101)
            got = {r.doc_id: r.text for r in after}
            for r, mask in zip(before, masks):
                raw = r.text.encode()
                only_long_runs(raw, mask)
                # bytes of characters that are covered as a whole go
                text, at = "", 0
                for c in r.text:
                    n = len(c.encode())
                    text += "" if all(mask[at:at + n]) else c
                    at += n
                assert got[r.doc_id] == text and at == len(raw)
        elif name == "mixing":
            sizes = collections.Counter()
            for r in before:
                sizes[r.source] += words(r.text)
            taken, times = collections.Counter(), collections.Counter()
            for r in after:
                taken[r.source] += words(r.text)
                times[r.doc_id] += 1
            assert max(times.values()) <= 3
            for s, goal in plain_targets(dict(sizes)).items():
                assert abs(taken[s] - goal) <= 0.05 * goal + min((words(r.text) for r in before if r.source == s), default=0) + 1
        else:
            check_pieces(after, before)
        docs, kept[name] = out, len(after)
    assert kept["simhash"] < kept["toxicity"] <= 200


def test_passages_of_over_fifty_words_are_cut(spark, make_docs):
    random.seed(11)
    some = lambda n, most=6: " ".join("".join(random.choices("abcdefghijklmnop", k=random.randint(1, most))) for _ in range(n))
    shared = [some(n) for n in (20, 49, 50, 51, 55, 64, 90)] + [" ".join(random.choices("abcdefghijklmnop", k=51)), some(1, 1) * 3 + "x" * 450]
    texts = [f"{some(30)}\n\t{random.choice(shared)} {some(30)} {s} {some(k)}".strip() for k in range(8) for s in shared]
    raws, want = [t.encode() for t in texts], {}
    for i, (raw, mask) in enumerate(zip(raws, covered(raws, 101))):
        only_long_runs(raw, mask)
        want[i] = bytes(c for c, m in zip(raw, mask) if not m).decode()
    got = corpus_pipeline.cut_repeats(spark, make_docs([(i, t, "s") for i, t in enumerate(texts)]), SF)
    assert {r.doc_id: r.text for r in got.collect()} == want
    assert not any(s in t for s in shared if len(s.split()) > 50 or len(s) >= 400 for t in want.values())


def test_near_duplicates_broadcast_no_variants(spark, make_docs, monkeypatch):
    seen, whole = [], graph.components
    monkeypatch.setattr(graph, "components", lambda edges: seen.append(broadcasts(edges)) or whole(edges))
    docs = make_docs([(i, f"text number {i} of a few", "s") for i in range(20)])
    assert corpus_pipeline.drop_near_duplicates(spark, docs, "").count() <= 20
    assert seen == [0]


def test_run_gives_the_last_stage_s_rows(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == [c.split()[0] for c in packing.PIECE.split(", ")] + ["sequence_id", "offset"]
    assert got.count() > 0


def test_empty_documents_pass_all_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []


def test_hard_rows_pass_all_stages(spark, hard):
    docs = hard
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name != "packing":
            assert docs.columns == hard.columns
    docs.collect()


@pytest.mark.parametrize("name", [n for n, (_, sql) in queries.ENTRIES.items() if sql])
def test_queries_beside_their_sql(spark, name):
    fn, sql = queries.ENTRIES[name]
    con = duckdb.connect()
    for t in ("embeddings", "conversations", "documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = fn(spark, SF)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(str, cur.fetchall()))


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.ENTRIES) == list(range(1, 14))
