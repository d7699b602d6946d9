"""Near-duplicates and search against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopscope.llm import cap_filters, maxscore, odd_sketch, queries
from shopscope.llm.common import components

from .conftest import ODD_TEXTS, prose

SF = "/root/testdata/sf0.001"


def reach(ids, links):
    """Smallest id reachable of each id."""
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(60)]
    low = reach({x for p in links for x in p}, links)
    got = {r["id"]: r["component_id"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: c for i, c in low.items() if any(i in p and p[0] != p[1] for p in links)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- odd sketches -----------------------------------------------------------------------
def brute_sets(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words)} if len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_links(sets, percent=75):
    keys = sorted(k for k in sets if k is not None)
    out = []
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                out.append((a, b))
    return out


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(0)
    for n in (30, 400, 800, 900, 20_000):
        for same in (0.75, 0.85, 0.95, 1.0):
            errors, sizes = [], []
            for _ in range(60):
                own = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
                keep = round(n * 2 * same / (1 + same))
                other = np.unique(np.concatenate([own[rng.permutation(n)[:keep]], rng.integers(0, 1 << 64, n - keep, dtype=np.uint64)]))
                true = keep / (2 * n - keep)
                a, b = (odd_sketch.unpacked([odd_sketch.sketches(x)]) for x in (own, other))
                near, allowed = odd_sketch.likely(np.array([len(own)]), a, np.array([len(other)]), b, true)
                assert allowed.all()
                errors.append(float(near[0]) - true)
            assert abs(np.mean(errors)) < 0.02


def test_sketches_of_neighbouring_sizes_compare():
    rng = np.random.default_rng(1)
    own = np.unique(rng.integers(0, 1 << 64, 600, dtype=np.uint64))  # sampled; the smaller one is sketched whole
    part = np.sort(own[rng.permutation(600)[:500]])
    a, b = (odd_sketch.unpacked([odd_sketch.sketches(x)]) for x in (own, part))
    near, allowed = odd_sketch.likely(np.array([600]), a, np.array([500]), b, 0.75)
    assert allowed.all() and abs(near[0] - 500 / 600) < 0.1


def test_shingles_hash_distinct_windows():
    for text in ("", " \n", "one two", "a b c d e", "A b C d E f", prose(2, 300) + " " + prose(2, 300)):
        assert len(odd_sketch.shingles(text)) == len(brute_sets(text))
    assert (odd_sketch.shingles("A b C d E f") == odd_sketch.shingles("a B\tc  D e F")).all()
    assert len(np.intersect1d(odd_sketch.shingles("É b c d e"), odd_sketch.shingles("é b c d e"))) == 0


def test_near_duplicates_odd_documents(clashing_docs, no_docs):
    rows = odd_sketch.near_duplicates(clashing_docs).collect()
    assert len(rows) == len(ODD_TEXTS)
    sets = {k: brute_sets(t) for k, t in ODD_TEXTS if k is not None}
    low = reach(sets, brute_links(sets))
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["n_shingles"] == len(sets[r["doc_id"]])
            assert r["component_id"] == low[r["doc_id"]] and r["kept"] == (low[r["doc_id"]] == r["doc_id"])
    assert odd_sketch.near_duplicates(no_docs).count() == 0


def family(rng, words, n, edits):
    """Versions of one text, each with a few words changed."""
    base = prose(words, words).split()
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(len(own))] = f"edit{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def test_groups_and_chains_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(odd_sketch, "TILE", 16)  # bands cut into tiles
    monkeypatch.setattr(odd_sketch, "GROUP_PAIRS", 8)
    rng = random.Random(8)
    texts = family(rng, 200, 60, 3) + family(rng, 120, 60, 12) + [prose(900 + i, 80) for i in range(40)]
    chain = prose(77, 150).split()  # each version near the next, the ends far apart
    for i in range(25):
        chain[i * 5 : i * 5 + 1] = [f"step{i}"]
        texts.append(" ".join(chain))
    texts += [texts[0]] * 30  # exact copies
    rng.shuffle(texts)
    sets = {i: brute_sets(t) for i, t in enumerate(texts)}
    low = reach(sets, brute_links(sets))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in odd_sketch.near_duplicates(docs).collect()}
    assert got == low


def test_shuffle_path_of_text_lookup(spark, monkeypatch):
    monkeypatch.setattr(odd_sketch, "BROADCAST_IDS", 0)
    docs = queries.table(spark, SF, "documents")
    sets = {r["doc_id"]: brute_sets(r["text"]) for r in docs.collect()}
    low = reach(sets, brute_links(sets))
    got = {r["doc_id"]: r["component_id"] for r in odd_sketch.near_duplicates(docs).collect()}
    assert got == low


def test_every_text_of_a_repeated_id_links(spark):
    rows, want = [], {}
    for i in range(6):  # two unrelated texts under one id, and a near copy of each under larger ids
        for j in range(2):
            text = prose(5000 + 2 * i + j, 150)
            rows += [(i, text), (100 + 2 * i + j, text + " one more")]
            want[i] = want[100 + 2 * i + j] = i
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in odd_sketch.near_duplicates(docs).collect()} == want


def test_deduplicated_keeps_one_of_each_group(clashing_docs):
    rows = odd_sketch.deduplicated(clashing_docs).collect()
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == [1, 2, 3, 4, 5, 8, 9, 10, 11]
    assert sum(r["doc_id"] is None for r in rows) == 2


# -- cap filters ---------------------------------------------------------------------------
def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute_cosine(rows, cosine=0.93):
    ok = {}
    for k, v, label in rows:
        if k is not None and label is not None and v is not None and None not in v:
            a = np.asarray(v, np.float32).astype(np.float64)
            if np.isfinite(a).all() and a.any():
                ok[k] = (a / np.linalg.norm(a), label)
    keys = sorted(ok)
    return [(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if ok[a][1] == ok[b][1] and len(ok[a][0]) == len(ok[b][0]) and ok[a][0] @ ok[b][0] >= cosine]


def check_links(got, rows, links):
    low = reach({k for k, _, _ in rows if k is not None}, links)
    n = dict.fromkeys(low, 0)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    for r in got:
        if r["vec_id"] is None:
            assert r["n_links"] == 0 and r["component_id"] is None and r["kept"]
        else:
            assert (r["n_links"], r["component_id"], r["kept"]) == (n[r["vec_id"]], low[r["vec_id"]], low[r["vec_id"]] == r["vec_id"])


def test_cap_filters_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(cap_filters, "TILE", 16)
    rng = np.random.default_rng(5)
    rows, key = [], 0
    for label in (0, 1, None):
        for centre in rng.standard_normal((12, 64)):
            for noise in (0.0, 0.0, *rng.uniform(0.05, 0.5, 12)):
                rows.append((key, (centre + noise * rng.standard_normal(64)).astype(np.float32).tolist(), label))
                key += 1
    got = cap_filters.near_duplicates(vectors(spark, rows)).collect()
    check_links(got, rows, brute_cosine(rows))


def test_cap_filters_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0] * 4, 0), (4, [1.0, nan, 0.0, 0.0], 0), (5, [1.0, None, 0.0, 0.0], 0), (6, [inf, 0.0, 0.0, 0.0], 0)]
    rows += [(7, [1.0, 0.0, 0.0, 0.0], 0), (8, [2.0, 0.0, -0.0, 0.0], 0), (9, [1.0, 0.0, 0.0, 0.0], None), (10, [1.0, 0.0], 0), (11, [3.0, 0.0], 0)]
    rows += [(None, [1.0, 0.0, 0.0, 0.0], 0), (12, [1.0, 0.0, 0.0, 0.0], 1), (13, [3e38, 0.0, 0.0, 0.0], 0), (14, [5.0], 0), (15, [7.0], 0)]
    got = cap_filters.near_duplicates(vectors(spark, rows).withColumn("rep", F.lit("clash")).withColumn("key", F.lit(1)))
    check_links(got.collect(), rows, brute_cosine(rows))
    assert cap_filters.near_duplicates(vectors(spark, [])).count() == 0


def test_vectors_of_many_lengths(spark, monkeypatch):
    """More lengths than one pass takes: each vector links with its near copy of the same length only."""
    monkeypatch.setattr(cap_filters, "LENGTHS_AT_ONCE", 3)
    rng = np.random.default_rng(3)
    given = []
    for d in (16, 17, 18, 19):
        v = rng.standard_normal(d)
        near = v + 0.02 * rng.standard_normal(d)
        given += [(2 * d, v.tolist(), 0), (2 * d + 1, near.tolist(), 0), (1000 + d, (-v).tolist(), 0)]
    df = spark.createDataFrame(given, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in cap_filters.near_duplicates(df).collect()}
    assert got == {v: (0, v) if v >= 1000 else (1, v // 2 * 2) for v, _, _ in given}


def test_shared_keys_in_parts(monkeypatch):
    monkeypatch.setattr(cap_filters, "KEYS_AT_ONCE", 3)
    rng = np.random.default_rng(4)
    lists = [np.unique(rng.integers(0, 40, n)) for n in (0, 3, 5, 8, 2, 9)]
    rows = np.array([0, 2, 3, 5, 6, 7])
    found = cap_filters.shares_a_key(lists, 9, rows)
    for i, a in zip(rows, lists):
        for j, b in zip(rows, lists):
            assert found[i, j] == bool(len(np.intersect1d(a, b)))
    assert not found[1].any() and not found[:, 8].any()


def test_filters_recall_at_the_threshold():
    for crowd in (100, 100_000):
        caps = cap_filters.CapFilters(64, crowd)
        a, b = cap_filters.random_pairs(64, 0.93, 400, seed=9)
        shared = [len(np.intersect1d(x, y)) for x, y in zip(caps.keys(a), caps.keys(b))]
        assert np.mean([s > 0 for s in shared]) > 0.98


def test_filters_list_all_and_only_exceeded_directions():
    code = cap_filters.CapCode(8, 11, 0.3, 1)
    units = np.random.default_rng(3).standard_normal((20, 8))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    for unit, found in zip(units, code.filters(units)):
        turned = unit @ code.rotation
        want = [i * 11 + j for i in range(11) for j in range(11) if turned[:4] @ code.books[0][i] + turned[4:] @ code.books[1][j] >= code.level]
        assert found.tolist() == want


# -- MaxScore ---------------------------------------------------------------------------------
def brute_top(rows, k=10):
    ok = {}
    for key, v in rows:
        if key is not None and v is not None and None not in v and np.isfinite(np.asarray(v, np.float32)).all():
            w = [int(np.floor(1024 * float(np.float32(x)))) for x in v]
            ok[key] = min(ok.get(key, w), w)
    out = set()
    for q in ok:
        if q % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(ok[q], ok[c])), c) for c in ok if c != q)[:k]
            out |= {(q, i + 1, c, -s) for i, (s, c) in enumerate(scores)}
    return out


@pytest.mark.parametrize("shard_rows", [7, 4096])
def test_top_k_equals_brute_force(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(maxscore, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(maxscore, "BLOCK_QUERIES", 2)
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(12).astype(np.float32).round(1).tolist()) for i in range(0, 700, 7)]
    rows += [(1, rows[0][1]), (2, rows[0][1]), (3, rows[0][1]), (3, rows[1][1])]  # ties and a repeated id
    rows += [(800, [0.0] * 12), (900, None), (5, [1.0, None]), (6, [float("nan")] * 12), (None, rows[0][1]), (1000, [2.0, -1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("clash")).withColumn("w", F.lit(0))
    got = {tuple(r) for r in maxscore.top_k(table, F.col("id") % 100 == 0).collect()}
    assert got == brute_top(rows)
    assert maxscore.top_k(table.where("vec_id is null"), F.col("id") % 100 == 0).count() == 0


def test_large_components_are_ranked_exactly(spark, monkeypatch):
    """Finite components whose scores leave the range of exact doubles, and of long."""
    monkeypatch.setattr(maxscore, "SHARD_ROWS", 8)
    rng = np.random.default_rng(9)
    rows = [(i, rng.integers(-9, 9, 4).astype(float).tolist()) for i in range(60)]
    big = float(1 << 43)
    rows += [(100, [big, 1.0, 1.0, 0.0]), (101, [big, 1.0, 2.0, 0.0]), (102, [big, 1.0, 1.0, 0.0]), (103, [-big, 0.0, 0.0, 1.0]), (200, [1e13, 3.0, -1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    weights = {k: [math.floor(x * 1024) for x in v] for k, v in rows}
    want = set()
    for q in (0, 100, 200):
        found = sorted((-sum(a * b for a, b in zip(weights[q], w)), k) for k, w in weights.items() if k != q)[:10]
        want |= {(q, r, k, max(-(1 << 63), min((1 << 63) - 1, -s))) for r, (s, k) in enumerate(found, 1)}
    assert {tuple(r) for r in maxscore.top_k(table, F.col("id") % 100 == 0).collect()} == want


def test_fewer_candidates_than_k(spark):
    rows = [(0, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [-1.0, 0.5])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert {tuple(r) for r in maxscore.top_k(table, F.col("id") % 100 == 0).collect()} == brute_top(rows)


def test_deduplicated_compares_texts_not_ids(spark):
    """One id with two unrelated texts keeps both; a near copy of either, under another id, goes."""
    one, two = prose(31, 80), prose(32, 80)
    rows = [(5, one), (5, two), (9, one + " end"), (8, two + " end"), (5, one), (7, prose(33, 50)), (7, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, odd_sketch.deduplicated(docs).collect()), key=repr)
    assert got == sorted([(5, one), (5, two), (7, rows[5][1]), (7, None), (6, "")], key=repr)


def test_finished_tables_are_removed(spark):
    """Only what the lazy result still reads stays in the shared folder."""
    import glob

    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(f"{folder}/llm-*"))
    docs = spark.createDataFrame([(i, prose(40 + i // 3, 60)) for i in range(12)], "doc_id long, text string")
    found = odd_sketch.deduplicated(docs)
    assert len(set(glob.glob(f"{folder}/llm-*")) - before) <= 2
    assert found.count() == 4
