import collections
import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rungline.llm import chat, mixing


def plain_targets(sizes):
    """Weights 5, 2, 1 in turn; what is over three times a source's size is shared again by weight until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in full]
        unit = (total - sum(full.values())) / max(1e-300, sum(weight[s] for s in free)) if free else 0
        over = [s for s in free if weight[s] * unit > 3 * sizes[s]]
        if not over:
            return {s: full.get(s, weight[s] * unit) for s in names}
        full |= {s: 3.0 * sizes[s] for s in over}


def check_mix(docs, slack=0.02):
    got = mixing.mix(docs).collect()
    want = collections.Counter((r.doc_id, len((r.text or "").encode().split())) for r in docs.collect())
    assert collections.Counter((r.doc_id, r.size) for r in got) == want
    sizes = collections.Counter()
    for r in docs.collect():
        sizes[r.source] += len((r.text or "").encode().split())
    goals = plain_targets(dict(sizes))
    by_goal = collections.defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        by_goal[r.source_size, round(r.target, 6)] += r.taken
    wanted = collections.defaultdict(float)
    for s, goal in goals.items():
        wanted[sizes[s], round(goal, 6)] += goal
    assert set(by_goal) == set(wanted)
    for key, goal in wanted.items():
        smallest = min((r.size for r in got if (r.source_size, round(r.target, 6)) == key and r.size), default=0)
        assert abs(by_goal[key] - goal) <= slack * goal + smallest + 1
    return got


def test_mix_meets_its_targets_and_reruns_agree(corpus):
    first = check_mix(corpus)
    assert sorted(map(tuple, first)) == sorted(map(tuple, mixing.mix(corpus.repartition(3)).collect()))


def test_full_sources_share_their_excess(make_docs):
    rows = [(i, "w " * (1 + i % 7), "a") for i in range(5)] + [(100 + i, "w " * (3 + i % 50), "b") for i in range(400)] + [
        (600 + i, "w " * (1 + i % 9), "c") for i in range(30)] + [(700 + i, "w " * 11, None) for i in range(10)]
    got = check_mix(make_docs(rows))
    assert all(r.taken == 3 * r.size for r in got if r.doc_id < 5)  # a: full


def test_mix_of_one_size_and_one_source(make_docs):
    check_mix(make_docs([(i % 40, "w " * 8, "a") for i in range(80)] + [(200 + i, "w " * 8, "b") for i in range(300)]))
    got = check_mix(make_docs([(i, "w " * (i + 1), "a") for i in range(30)]), 0.0)
    assert all(r.taken == r.size for r in got)


def test_rates_grow_or_fall_with_size(make_docs):
    rows = [(i, "w " * (1 + i % 60), "a") for i in range(1200)] + [(5000 + i, "w " * (1 + i % 60), "b") for i in range(1200)]
    got = check_mix(make_docs(rows))
    short, long = ([sum(r.taken for r in got if (r.doc_id < 5000) == a and lo <= r.size <= hi) / sum(r.size for r in got if (r.doc_id < 5000) == a and lo <= r.size <= hi)
                    for a in (True, False)] for lo, hi in ((1, 10), (50, 60)))
    assert long[0] > short[0] and long[1] < short[1]


def test_copies_are_whole_rows(corpus, hard, nothing):
    for docs in (corpus, hard):
        taken = collections.Counter()
        for r in mixing.mix(docs).collect():
            taken[r.doc_id] += r.taken
        got = mixing.copied(docs)
        assert got.dtypes == docs.dtypes
        words = collections.Counter()
        for r in got.collect():
            words[r.doc_id] += len((r.text or "").encode().split())
        assert {k: v for k, v in words.items() if v} == {k: v for k, v in taken.items() if v}
    assert mixing.mix(nothing).collect() == [] and mixing.copied(nothing).collect() == []


def test_mix_of_hard_rows(hard):
    check_mix(hard, 0.1)


def test_native_plans_hold_no_python(spark, corpus):
    talk = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    for df in (mixing.mix(corpus), mixing.copied(corpus), chat.read_back(chat.format_conversations(talk))):
        plan = df._jdf.queryExecution().toString()
        assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


PIECES = ["[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[SAYS]", "\\", " ", "\n", "ok", "é漢", "]", "<", "$1", ""]
TEXT = st.lists(st.sampled_from(PIECES), max_size=7).map("".join)
ROLE = st.one_of(st.sampled_from(["user", "assistant", "system", None, ""]), TEXT)


def expected(turns):
    told = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(talks=st.lists(st.lists(st.tuples(ROLE, st.one_of(st.none(), TEXT)), min_size=1, max_size=6), min_size=20, max_size=40))
def test_any_conversation_comes_back(spark, talks):
    rows = [(c, k, r, t) for c, turns in enumerate(talks) for k, (r, t) in enumerate(turns)]
    formatted = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(formatted).collect()}
    assert got == {c: expected(turns) for c, turns in enumerate(talks)}


def test_plain_turns_are_not_escaped(spark):
    table = spark.createDataFrame([(1, 0, "user", "a\\b [x] \\ "), (1, 1, "assistant", "</s>")], "conv_id long, turn long, role string, text string")
    r = chat.format_conversations(table).first()
    assert r.formatted == "[INST] a\\b [x] \\  [/INST]<s> \\</s> </s>"
    assert [tuple(m) for m in r["mask"]] == [(0, 0, 0), (25, 29, 34)]


def test_runs_of_backslashes_take_time_in_proportion(spark):
    """Long runs before a control string, before none, and many short ones; columns that clash with the operator's own."""
    run = "\\" * 1_000_000
    texts = [f"</s> {run}", f"{run}</s>", f"{run}[INST]{run}", "\\</s> " * 100_000, "</s>" + "\\ " * 500_000]
    rows = [(1, k, "assistant" if k % 2 else "user", t, "x", "y", "z") for k, t in enumerate(texts)] + [(2, 0, run + "<s>", run, None, None, None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, mask string, turn_start string")
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(chat.format_conversations(table)).collect()}
    assert got == {c: expected([(r[2], r[3]) for r in rows if r[0] == c]) for c in (1, 2)}


def test_broken_text_has_no_turn(spark):
    for text in ("[INST] a", "x", "[INST] a <s> b [/INST]", "[ROLE] a [/ROLE]"):
        parsed = spark.range(1).select(chat.parse(F.lit(text)).alias("p")).first().p
        assert any(t.role is None for t in parsed)


def test_ties_nulls_and_empty_tables_of_turns(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string, mask string"
    rows = [(1, 0, "user", "b", "x", "y"), (1, 0, "user", "a", "x", "y"), (1, 0, "user", "a", "x", "y"), (None, None, None, None, None, None),
            (None, 1, "assistant", "w" * 200_000, None, None)]
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(spark.createDataFrame(rows, schema))).collect()}
    assert tuple(got[1])[1:5] == expected([("user", "a"), ("user", "a"), ("user", "b")])
    assert tuple(got[None])[1:5] == expected([("", ""), ("assistant", "w" * 200_000)])
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], schema))).collect() == []


@pytest.mark.parametrize("sizes", [{"a": 0, None: 0}, {"a": 10, "b": 1, "c": 1000, None: 5}, {"é": 7, "z": 7, "Z": 7}])
def test_targets_are_the_plain_ones(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in mixing.targets(table).collect()}
    assert got == pytest.approx(plain_targets(sizes))
