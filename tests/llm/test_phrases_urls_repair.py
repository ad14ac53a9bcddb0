import collections
import hashlib
import random
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rungline.llm import collocations, queries, repair, urls

SF = "/root/testdata/sf0.001"


# --- phrases ---------------------------------------------------------------------------------------------------------

def plain_counts(words, weight, least):
    found = collections.Counter()
    for column, w in zip(words.T.tolist(), weight.tolist()):
        for d in range(len(column)):
            if column[d] == 0:
                break
            found[tuple(column[:d + 1])] += w
    return {k: v for k, v in found.items() if v >= least}


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(0, 300), st.integers(1, 12), st.sampled_from([2, 6, 40]))
def test_quicksort_counts_all_leading_words(seed, n, least, different):
    rng = np.random.default_rng(seed)
    words = rng.integers(0, different, (3, n)).astype(np.int32)
    words[0] = np.maximum(words[0], 1)
    words[2][words[1] == 0] = 0
    weight = rng.integers(1, 4, n).astype(np.int64)
    got = {}
    for d, some, counts in collocations.multikey(words, weight, least):
        for i, c in zip(some.tolist(), counts.tolist()):
            phrase = tuple(words[:d + 1, i].tolist())
            assert phrase not in got
            got[phrase] = c
    assert got == plain_counts(words, weight, least)


def test_parts_of_a_count_are_told_whatever_their_size():
    words = np.array([[1, 1, 1, 2], [3, 3, 4, 0], [5, 0, 0, 0]], np.int32)
    got = collections.Counter()
    for d, some, counts in collocations.multikey(words, np.ones(4, np.int64), 10, np.array([2, 2, 1, 0], np.int8)):
        for i, c in zip(some.tolist(), counts.tolist()):
            got[tuple(words[:d + 1, i].tolist())] += c
    assert got == {(1,): 3, (1, 3): 2}


def plain_collocations(rows, top=2000, least=10):
    counts, total = collections.defaultdict(collections.Counter), collections.Counter()
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = collections.Counter()
        for p, a in cand.items():
            for part in (p[:2], p[1:]) if len(p) == 3 else ():
                longer[part] = max(longer[part], a)
        rows = []
        for p, a in cand.items():
            if 100 * longer[p] >= 50 * a:
                continue
            score, _, l, r = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def found(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("frequent", [collocations.FREQUENT, 1])
def test_collocations_of_random_texts(spark, frequent, monkeypatch):
    """Also with words that are routed by two and by three words."""
    monkeypatch.setattr(collocations, "HELD", 500)
    monkeypatch.setattr(collocations, "SLAB", 64)
    monkeypatch.setattr(collocations, "FREQUENT", frequent)
    if frequent == 1:
        monkeypatch.setattr(collocations, "SHARE", 20)
    random.seed(5)
    vocabulary = ["the"] * 12 + ["of"] * 8 + ["New", "york", "City", "É", "été", "\x1c", "\x00", "a\xa0b", "x" * 200] + [f"w{i}" for i in range(30)]
    def text():
        return "".join(random.choice(vocabulary) + random.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " ; "]) for _ in range(random.randint(0, 60)))
    rows = [(random.choice(["en", "de", None]), random.choice([text(), text(), None, "", "New York City"])) for _ in range(400)]
    rows += [("en", "of the New York City " * 3)] * 60 + [("fr", "the " * 3000)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert found(collocations.collocations(df)) == plain_collocations(rows)
    assert found(collocations.collocations(df, top=3)) == plain_collocations(rows, 3)


class Taken:
    """Stands for a table: keeps the function that would run over its batches."""

    def mapInArrow(self, function, schema):
        return function


def test_counting_holds_a_few_bytes_a_suffix():
    rng, batches, plain = np.random.default_rng(5), [], collections.Counter()
    names = b" ".join(b"w%d" % i for i in range(3000))
    for _ in range(60):
        words = rng.integers(1, 3001, (3, 20_000)).astype("<u2")
        counts = rng.integers(1, 3, 20_000).astype("<u4")
        np.add.at(total := np.zeros(3001, np.int64), words[0], counts)
        plain.update({b"w%d" % (i - 1): int(n) for i, n in enumerate(total) if n})
        batches.append(pa.RecordBatch.from_arrays(
            [pa.array([0], pa.int32()), pa.array(["en"]), *(pa.array([b], pa.binary()) for b in (names, words.tobytes(), counts.tobytes()))],
            names=["route", "lang", "names", "codes", "counts"]))
    count = collocations._counted(Taken(), frozenset(), 500)
    tracemalloc.start()
    got = [dict(zip(b.column(2).to_pylist(), b.column(3).to_pylist())) for b in count(iter(batches))]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert collections.Counter({k: v for some in got for k, v in some.items()}) == {k: v for k, v in plain.items() if v >= 500}
    assert most < 60 * 1_200_000  # 16 bytes a suffix are held, a slice takes its part beside them


def test_collocations_of_hard_rows_and_nothing(spark, hard, nothing):
    rows = [(r.lang, r.text) for r in hard.collect()]
    assert found(collocations.collocations(hard)) == plain_collocations(rows)
    assert found(collocations.collocations(nothing)) == []
    blank = spark.createDataFrame([(None, None), ("en", " \t.")], "lang string, text string")
    assert found(collocations.collocations(blank)) == []


def test_scores_are_exact_beyond_64_bits(spark, monkeypatch):
    big = 3_000_000_007
    rows = [("en", 1, "a", big + 2), ("en", 1, "b", big + 1), ("en", 2, "a b", big)]
    monkeypatch.setattr(collocations, "phrase_counts", lambda docs, least: (
        spark.createDataFrame(rows, "lang string, words int, phrase string, f long"), spark.createDataFrame([("en", 4 * big)], "lang string, n long")))
    got = found(collocations.collocations(spark.createDataFrame([], "lang string, text string")))
    assert got == [("en", 1, "a b", big, big + 2, big + 1, 4 * big, 1_000_000 * big * big // ((big + 2) * (big + 1)))]


# --- URL rules -------------------------------------------------------------------------------------------------------

def plain_verdict(url, rules, default="allow"):
    at = (url or "").find("://")
    rest = url[at + 3:] if at >= 0 else ""
    host = re.match(r"[^/?#]*", rest).group().translate({65 + i: 97 + i for i in range(26)})
    path = re.match(r"[^?#]*", rest[len(re.match(r"[^/?#]*", rest).group()):]).group()
    fit = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[2], best[3] if best else default


HOST = st.lists(st.sampled_from(["a", "b", "Net", "net", "", "com", "x" * 70]), min_size=1, max_size=5).map(".".join)
PATH = st.lists(st.sampled_from(["a", "b", "", "A", "é", "en"]), max_size=4).map(lambda p: "".join("/" + x for x in p))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(HOST.map(str.lower).filter(bool), st.sampled_from(["", "/", "/a/", "/a/b/", "//", "/en/", "/é/"]), st.sampled_from(["allow", "block"])),
                max_size=6),
       st.lists(st.tuples(st.sampled_from(["http://", "://", "", "x://y://"]), HOST, PATH, st.sampled_from(["", "?q=/a/", "#/a/", "/"])), min_size=5, max_size=30))
def test_any_url_gets_the_longest_rule(spark, rules, parts):
    table = [(i, "".join(p)) for i, p in enumerate(parts)]
    got = urls.judged(spark.createDataFrame(table, "page_id long, url string"), spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == {i: plain_verdict(u, rules) for i, u in table}


def test_hard_urls(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("Example.com", "", "block"), ("d.e", "/x/", "allow"), ("d.e", "/x/", "block")]
    table = [(1, "http://example.net/en/1", "x", "y"), (1, "http://example.net/en/1", "x", "y"), (None, None, None, None), (None, "", None, None),
             (2, "http://a.example.com", "x", None), (3, "http://" + "a." * 50_000 + "net/" + "b/" * 50_000, None, None), (4, "q://D.E/x/", "r", "v")]
    rows = spark.createDataFrame(table, "page_id long, url string, rule string, best string")
    got = urls.judged(rows, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert sorted(got.columns) == ["best", "host", "page_id", "path", "rule", "url", "verdict"]
    want = collections.Counter((i, u, b, *plain_verdict(u, [(h.lower(), p, v) for h, p, v in rules])) for i, u, _, b in table)
    assert collections.Counter((r.page_id, r.url, r.best, r.host, r.path, r.rule, r.verdict) for r in got.collect()) == want
    assert urls.judged(rows.limit(0), spark.createDataFrame(rules, "host string, path string, verdict string")).collect() == []
    none = urls.judged(rows, spark.createDataFrame([], "host string, path string, verdict string"), default="block")
    assert [r.verdict for r in none.collect()] == ["block"] * len(table)


@pytest.mark.parametrize("rule", [("", "/", "block"), ("a", "/x", "block"), ("a", "x/", "allow"), ("a", "/", "maybe"), (None, "/", "block")])
def test_rules_that_cannot_be_looked_up_are_errors(spark, rule):
    rows = spark.createDataFrame([(1, "http://a/")], "page_id long, url string")
    with pytest.raises(ValueError):
        urls.judged(rows, spark.createDataFrame([rule], "host string, path string, verdict string"))


# --- repair ----------------------------------------------------------------------------------------------------------

def cheapest(rows):
    """All edits of (must go, broken off, initial) by depth: the least cost, then the least audit, with the rows told."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    end = {"": (0, "", ()), "a": (0, "", ()), "u": (2, "I", (("a", None),)), "s": (4, "II", (("u", None), ("a", None)))}
    best = dict(end)
    for k in range(len(rows) - 1, -1, -1):
        go, broken, initial = rows[k]
        def step(q):
            some = [(3 + best[q][0], "D" + best[q][1], best[q][2])]
            if not go:
                if initial == after[q] or (initial == "s" and q == ""):
                    c, a, t = best[initial]
                    some.append((broken + c, "K" + a, (("keep", k), *t)))
                c, a, t = best[after[q]]
                some.append((2 + broken + c, "R" + a, ((after[q], k), *t)))
            return min(some, key=lambda x: x[:2])
        plain = {q: step(q) for q in best}
        new = {}
        for q in best:
            some, at, cost, told = [plain[q]], q, 0, ()
            for _ in range(3):
                at, cost = after[at], cost + 2
                told = (*told, (at, None))
                some.append((cost + plain[at][0], "I" * len(told) + plain[at][1], told + plain[at][2]))
            new[q] = min(some, key=lambda x: x[:2])
        best = new
    return best[""]


def plain_audit(conversations):
    """The contract row by row; rows of one turn go by role and digest."""
    kept = collections.defaultdict(list)
    for conv_id, turn, role, text in conversations:
        kept[conv_id] += []
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        kept[conv_id] += [(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    out = {}
    for conv_id, rows in kept.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, faults, symbols = set(), collections.Counter(), []
        for turn, role, text in rows:
            body = text.strip("\x20\t\n\x0b\x0c\r")
            kind = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[kind] += 1
            symbols.append((kind in ("blank", "duplicate"), int(kind == "truncated"), role[:1] if role[:1] in ("s", "u", "a") else "o"))
        cost, audit, told = cheapest(symbols)
        lines = [f"{rows[k][1]}:{rows[k][2]}" if who == "keep" else {"u": "user:", "a": "assistant:"}[who] + (rows[k][2] if k is not None else "") for who, k in told]
        illegal = sum(a[2] + b[2] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:]))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv_id] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def audited(spark, rows, schema="conv_id long, turn long, role string, text string"):
    got = repair.audited(spark.createDataFrame(rows, schema).repartition(4)).collect()
    assert len({r.conv_id for r in got}) == len(got)
    return {r.conv_id: tuple(r)[1:] for r in got}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, repair.SYMBOLS - 1), max_size=40))
def test_block_tables_give_the_least_audit(symbols):
    rows = [(s == repair.GO, (s - 2) // 4 if s > 1 else 0, repair.ROWS[(s - 2) % 4] if s > 1 else "o") for s in symbols]
    for block in (1, 3, 4):
        assert repair.repaired(symbols, TABLES[block]) == cheapest(rows)[:2]


TABLES = {b: repair.Tables(b) for b in (1, 3, 4)}
ROLE = st.sampled_from(["user", "assistant", "system", "tool", "", None, "User", "usher", "É"])
TEXT = st.sampled_from(["Yes.", "no", "Hm?\n", " ", "", None, "\u00a0", "a\x0b", "Ok!", "x. y", "é"])


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([1, 2, 3, 4, 5, None, -7]), st.one_of(st.none(), st.integers(-1, 12)), ROLE, TEXT), min_size=20, max_size=150))
def test_any_conversation_is_repaired_as_row_by_row(spark, rows):
    assert audited(spark, rows) == plain_audit(rows)


def test_long_conversations_are_chained(spark, monkeypatch):
    """Chunks of a few rows give the same as a whole; one conversation has most rows, one row is there many times."""
    random.seed(8)
    rows = [(1, k, random.choice(["user", "assistant", "system"]), random.choice(["a.", "b!", "c", f"{k}.", f"{k}"])) for k in range(3000)]
    rows += [(c, k, random.choice(["user", "assistant"]), f"{k}.") for c in range(2, 12) for k in range(9)] + [(4, 3, "user", "again.")] * 500
    want = plain_audit(rows)
    assert audited(spark, rows) == want
    monkeypatch.setattr(repair, "CHUNK", 7)
    assert audited(spark, rows) == want


def test_hard_conversations(spark):
    clash = "conv_id long, turn long, role string, text string, pos long, digest string, edit string, times long"
    rows = [(1, 0, "user", "w " * 500_000 + ".", 1, "x", "y", 9), (1, 0, "user", None, 1, "x", "y", 9), (None, None, None, None, None, None, None, None),
            (None, None, "assistant", "Hi.", 1, None, None, 2)]
    assert audited(spark, rows, clash) == plain_audit([r[:4] for r in rows])
    assert audited(spark, [], clash) == {}
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    assert audited(spark, [(gone, 0, "user", "Hi.")]) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


# --- the queries beside plain versions ----------------------------------------------------------------------------------

def test_queries_equal_plain_versions(spark):
    con = duckdb.connect()
    talks = con.execute(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall()
    assert {r.conv_id: tuple(r)[1:] for r in queries.q_repair(spark, SF).collect()} == plain_audit(talks)
    docs = con.execute(f"SELECT lang, text FROM '{SF}/documents.parquet'").fetchall()
    assert found(queries.q_collocations(spark, SF)) == plain_collocations(docs)
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    pages = con.execute(f"SELECT page_id, url FROM '{SF}/pages.parquet'").fetchall()
    assert {tuple(r) for r in queries.q_urls(spark, SF).collect()} == {(i, *plain_verdict(u, rules)) for i, u in pages}
