import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from rungline.llm import anchors, graph, simhash, suffixes, vectors


def smallest(nodes, pairs):
    """Smallest reachable node, by union-find."""
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n
    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_components_of_chains_stars_and_loops(spark):
    random.seed(1)
    pairs = [(i, i + 1) for i in range(0, 90)] + [(200, k) for k in range(201, 260)] + [(500, 500)] + [
        (random.randint(1000, 1200), random.randint(1000, 1200)) for _ in range(90)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    nodes = {n for p in pairs if p[0] != p[1] for n in p}
    assert got == smallest(nodes, [p for p in pairs if p[0] != p[1]])
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_fingerprints_and_components_against_all_pairs(make_docs, corpus):
    random.seed(2)
    base = corpus.select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text, "s") for r in base]
    for k, r in enumerate(base[:60]):  # near copies at growing distances
        words = r.text.split(" ")
        for _ in range(k % 4):
            words[random.randrange(len(words))] = "changed"
        rows.append((10_000 + k, " ".join(words), "s"))
    rows += [(20_000, None, "s"), (20_001, "", "s"), (20_002, "\t\n", "s"), (20_003, "two words", "s")]
    docs = make_docs(rows)
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    prints = {i: plain_fingerprint(t) for i, t, _ in rows}
    assert {i: f for i, (f, _) in got.items()} == prints
    pairs = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 3]
    assert {i: c for i, (_, c) in got.items()} == smallest(prints, pairs)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(smallest(prints, pairs).values()))


def test_links_find_every_pattern_of_three_bits(spark):
    random.seed(3)
    center = random.getrandbits(64)
    prints = {center} | {center ^ sum(1 << b for b in random.sample(range(64), k)) for k in (1, 2, 3, 4) for _ in range(60)}
    signed = [f - (1 << 64) if f >> 63 else f for f in prints]
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert got == want


def broadcasts(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def test_variants_are_not_broadcast(spark, tmp_path):
    spark.range(1000).select(F.xxhash64("id").alias("fp")).write.parquet(f"{tmp_path}/prints")
    assert broadcasts(simhash.links(spark.read.parquet(f"{tmp_path}/prints"))) == 0


def test_simhash_of_hard_rows(hard, nothing):
    got = simhash.near_duplicates(hard).collect()
    assert len(got) == hard.count()
    assert {r.component_id for r in got if r.fp == 0} == {2}
    kept = simhash.keep_first(hard).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id) == [1, 2, 5, 7, 8, 9] and len(kept) == 7  # the text without an id stays
    assert simhash.near_duplicates(nothing).collect() == [] and simhash.keep_first(nothing).collect() == []


def test_components_without_ids_or_with_one_id_stay_apart(make_docs):
    texts = [" ".join(f"{k}{i}" for i in range(40)) for k in "abcd"]  # unrelated
    got = simhash.keep_first(make_docs([(None, texts[0], "s"), (None, texts[0], "s"), (None, texts[1], "s"), (7, texts[2], "s"),
                                        (7, texts[3], "s"), (7, texts[3], "s"), (9, texts[3], "s")])).collect()
    assert sorted((r.text, r.doc_id) for r in got) == [(t, i) for t, i in zip(texts, (None, None, 7, 7))]


@pytest.mark.parametrize("symbols", [1, 2, 3, 8, 200])
def test_suffix_array_is_the_sorted_order(symbols):
    random.seed(symbols)
    for _ in range(200):
        s = [random.randint(1, symbols) for _ in range(random.randint(0, 60))] + [0]
        assert suffixes.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])
    s = [1, 2, 1, 1, 2] * 60 + [0]
    assert suffixes.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_equal_windows_pick_equal_anchors(monkeypatch):
    random.seed(5)
    for letters in (b"ab", b"abcdefgh"):
        core = bytes(random.choice(letters) for _ in range(900))
        texts = [bytes(random.choice(letters) for _ in range(random.randint(0, 300))) + core for _ in range(4)]
        for part in (1 << 19, 250):
            monkeypatch.setattr(anchors, "_PART", part)
            picked = []
            for t in texts:
                of = {}
                for at, first, last, code in zip(*(c.tolist() for c in anchors.anchors(t, 400, 100))):
                    for p in range(first, last + 1):
                        of[p - (len(t) - 900)] = (at - p, code)
                assert sorted(of) == list(range(-(len(t) - 900), 501))
                picked.append({p: v for p, v in of.items() if p >= 0})
            assert all(p == picked[0] for p in picked)


def covered(texts, window=400):
    seen = {}
    for d, b in enumerate(texts):
        for i in range(len(b) - window + 1):
            seen.setdefault(b[i:i + window], []).append((d, i))
    masks = [bytearray(len(b)) for b in texts]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                masks[d][i:i + window] = b"\1" * window
    return masks


def passages(seed):
    """Texts that share passages of several lengths at random places, with edits, repeats inside a text, and exact copies."""
    random.seed(seed)
    letters = "abcdefghijklmnop éß漢 "
    word = lambda n: "".join(random.choice(letters) for _ in range(n))
    shared = [word(n) for n in (380, 399, 400, 401, 450, 700, 1500)]
    texts = []
    for k in range(60):
        text = word(random.randint(0, 300))
        for s in random.sample(shared, random.randint(0, 3)):
            at = random.randint(0, len(s) - 1)
            text += (s if k % 3 else s[:at] + "X" + s[at + 1:]) + word(random.randint(0, 120))
        texts.append(text)
    return texts + [texts[5], texts[6], texts[6], "ab" * 500, "a" * 1000, "", None, "short"]


@pytest.mark.parametrize("most, often", [(10_000, 4096), (1, 4096), (10_000, 2), (10_000, 3)])
def test_repeats_against_all_windows(spark, make_docs, monkeypatch, most, often):
    monkeypatch.setattr(suffixes, "CONTEXTS", most)  # 1: every cell is cut down to single windows
    monkeypatch.setattr(suffixes, "OFTEN", often)  # 2: nearly every anchor counts as very frequent
    monkeypatch.setattr(suffixes, "TOLD", 1 if often < 4 else suffixes.TOLD)
    texts = passages(7)
    docs = make_docs([(i, t, "s") for i, t in enumerate(texts)])
    raws = [(t or "").encode() for t in texts]
    want = {}
    for i, (raw, mask) in enumerate(zip(raws, covered(raws))):
        kept = bytes(b for b, m in zip(raw, mask) if not m)
        spans = sum(m and not (j and mask[j - 1]) for j, m in enumerate(mask))
        want[i] = (len(raw), sum(mask), spans, hashlib.sha256(kept).hexdigest(), len(kept))
    assert {r.doc_id: tuple(r)[1:] for r in suffixes.digests(docs).collect()} == want


def plain_met(rows, hot):
    """Anchors met again, and one per context of those met in several contexts, straight from the definition."""
    by = {}
    for row in rows:
        by.setdefault(row[0], {}).setdefault(row[1], []).append(row)
    again = [r[2:] for kinds in by.values() for run in kinds.values() if len(run) > 1 for r in run]
    owners = [(run[0][0], run[0][1], min(len(run), 2)) for h, kinds in by.items() if len(kinds) > 1 or h in hot for run in kinds.values()]
    return sorted(again), sorted(owners)


def test_runs_are_read_batch_by_batch():
    random.seed(12)
    for trial in range(200):
        rows = sorted((random.randint(0, 4), random.randint(0, 3), random.randint(0, 99), 0, k) for k in range(random.randint(0, 40)))
        hot = np.array(sorted(random.sample(range(5), random.randint(0, 1))), np.int64)
        cuts = [0, *sorted(random.randint(0, len(rows)) for _ in range(random.randint(0, 12))), len(rows)]
        batches = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows[a:b]], pa.int64()) for i in range(5)], names=["h", "c", "doc_id", "t", "place"])
                   for a, b in zip(cuts, cuts[1:])]
        got = [r for b in suffixes._runs(hot)(iter(batches)) for r in b.to_pylist()]
        context = {r[2:]: r[:2] for r in rows}
        again, owners = plain_met(rows, set(hot.tolist()))
        assert sorted((r["doc_id"], r["t"], r["place"]) for r in got if r["again"]) == again
        assert sorted((*context[r["doc_id"], r["t"], r["place"]], r["weight"]) for r in got if not r["again"]) == owners


def test_repeats_in_the_corpus(corpus):
    rows = corpus.select("doc_id", "text").collect()
    raws = [(r.text or "").encode() for r in rows]
    want = {r.doc_id: sum(m) for r, m in zip(rows, covered(raws))}
    assert {r.doc_id: r.n_removed for r in suffixes.digests(corpus).collect()} == want


def test_repeats_of_hard_rows(hard, nothing):
    got = suffixes.digests(hard).collect()
    assert len(got) == hard.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    assert all(r.n_removed == r.n_bytes for k in (5, 6, 7) for r in by_id[k]) and len(by_id[7]) == 2
    assert all(r.n_removed == 0 for k in (1, 2, 3, 4, 8, 9, 10, None) for r in by_id[k])
    cut = suffixes.without_repeats(hard)
    assert cut.columns == hard.columns and cut.dtypes == hard.dtypes
    assert {r.text for r in cut.collect() if r.doc_id in (5, 6, 7)} == {""}
    assert suffixes.digests(nothing).collect() == [] and suffixes.without_repeats(nothing).collect() == []


def test_spans_of_equal_rows_are_listed_once(make_docs):
    random.seed(9)
    first, second = ("".join(random.choice("abcdefgh ") for _ in range(700)) for _ in range(2))
    docs = make_docs([(None, first + "x" + second, "s")] * 30 + [(1, first, "s"), (2, second + "y" + first, "s")])
    got = suffixes.repeated(docs).collect()
    assert len(got) == 3 and all(len(r.spans) == len(set(r.spans)) for r in got)


def test_cuts_keep_whole_characters(make_docs):
    passage = "漢" * 150
    got = suffixes.without_repeats(make_docs([(1, "é" + passage + "ü", "s"), (2, "ö" + passage + "ä", "s")])).collect()
    assert sorted(r.text for r in got) == ["éü", "öä"] and all(r.n_chars == 2 for r in got)


def sharing(texts, n):
    """Whether another text has ``n`` words of this one, one after the other, straight from the definition."""
    windows = [{tuple(w[i:i + n]) for i in range(len(w) - n + 1)} for w in ((x or "").encode().split() for x in texts)]
    return [int(any(own & other for k, other in enumerate(windows) if k != j)) for j, own in enumerate(windows)]


@pytest.mark.parametrize("often", [2, 4096])
def test_documents_that_share_a_passage_of_words(make_docs, monkeypatch, often):
    monkeypatch.setattr(suffixes, "OFTEN", often)
    monkeypatch.setattr(suffixes, "SHARE", 10 ** 9 if often < 4 else suffixes.SHARE)
    random.seed(31)
    word = iter(f"w{i}" for i in range(10 ** 6))
    fresh = lambda n: [next(word) for _ in range(n)]
    common, longer, short, own = fresh(51), fresh(80), fresh(50), fresh(60)
    texts = [" ".join(fresh(random.randint(0, 90)) + common + fresh(random.randint(0, 90))) for _ in range(12)]
    texts += [" ".join(fresh(40) + longer[a:b] + fresh(40)) for a, b in [(0, 60), (9, 60), (10, 61), (29, 80), (0, 30)]]
    texts += [" ".join(fresh(30) + short + fresh(30)) for _ in range(3)]
    texts += [" ".join(own + fresh(30) + own), "\n".join(fresh(5) + common), " ".join(fresh(200)), "", None, " ".join(common[:50]), " ".join(common)]
    texts += [" ".join(random.choice("ab") for _ in range(random.randint(40, 70))) for _ in range(10)]  # few kinds of words
    texts += [" ".join(["same"] * k) for k in (49, 50, 51, 52, 200)]
    twice = " ".join(fresh(70))
    rows = [(i, x, "s") for i, x in enumerate(texts)] + [(None, twice, "s"), (None, twice, "s"), (900, " ".join(fresh(51)), "s")]
    got = suffixes.digests(make_docs(rows), suffixes.WORDS).collect()
    want = sharing([x for _, x, _ in rows], 51)
    assert sorted((r.doc_id or -1, r.shares_passage) for r in got) == sorted((i or -1, k) for (i, _, _), k in zip(rows, want))
    assert want[:12] == [1] * 12 and want[17:20] == [0] * 3 and all(r.n_removed == 0 for r in got if r.doc_id is not None and r.doc_id < 12)


def test_passages_shared_in_the_corpus(corpus):
    rows = corpus.select("doc_id", "text").collect()
    want = {r.doc_id: k for r, k in zip(rows, sharing([r.text for r in rows], 51))}
    assert {r.doc_id: r.shares_passage for r in suffixes.digests(corpus, suffixes.WORDS).collect()} == want and 0 < sum(want.values()) < len(want)


def brute_vectors(rows, threshold=0.93):
    ok = {}
    for k, (i, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(np.array(v, dtype=np.float32), dtype=float)
            ok[k] = x / np.linalg.norm(x)
    pairs = [(a, b) for a, b in itertools.combinations(ok, 2)
             if rows[a][2] == rows[b][2] and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= threshold]
    roots = smallest(range(len(rows)), pairs)
    links = [sum(k in p for p in pairs) for k in range(len(rows))]
    first = {}
    for k, r in roots.items():
        if rows[k][0] is not None:
            first[r] = min(first.get(r, rows[k][0]), rows[k][0])
    return sorted(((rows[k][0], links[k], first.get(roots[k])) for k in range(len(rows))), key=str)


def test_vectors_against_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(12, 16))
    rows = []
    for k in range(500):
        v = centers[k % 12] * rng.uniform(0.5, 2) + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.4])
        rows.append((k, v.astype(np.float32).tolist(), [0, 0, 0, 1, 2, None][k % 6]))
    rows += [(1000 + k, rows[3][1], 1) for k in range(40)]  # equal vectors
    nan, inf = float("nan"), float("inf")
    rows += [(2000, None, 0), (2001, [], 0), (2002, [0.0] * 16, 0), (2003, [nan] + [1.0] * 15, 0), (2004, [inf] + [1.0] * 15, 0),
             (2005, [None] + [1.0] * 15, 0), (2006, [1.0, 2.0], 0), (2007, [1.0, 2.1], 0), (None, rows[0][1], 0), (7, rows[7][1], 1), (7, rows[9][1], 1)]
    monkeypatch.setattr(vectors, "FAN", 2)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = vectors.near_duplicates(table)
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got.collect()), key=str) == brute_vectors(rows)
    assert got.where(F.col("kept") != F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))).isEmpty()
    assert vectors.near_duplicates(table.limit(0)).collect() == []


def test_many_blocks_of_vectors(spark):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(300, 8))
    x = np.repeat(centers, 30, axis=0) + rng.normal(size=(9000, 8)) * 0.02
    table = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r.n_links for r in vectors.near_duplicates(table).collect()}
    unit = x.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    assert got == {k: int(n) - 1 for k, n in enumerate((unit @ unit.T >= 0.93).sum(axis=1))}
