"""Removed passages against a dictionary of all windows."""

import hashlib
import random
import re

import numpy as np
import pytest

from shopscope.llm import queries
from shopscope.llm import suffix_trees as st
from shopscope.llm.words import Powers, hashed_words

from .conftest import DOCS, ODD_TEXTS, prose


def brute(texts, window=20):
    """(id, words, removed, kept text) of every row; rows of one id and text are one document."""
    # Of one id, texts are ordered by a hash, which only the engine knows: give equal ids equal texts in tests.
    known = sorted({(k is None, k or 0, t or "") for k, t in texts})
    first, again = {}, {}
    for no_id, key, text in known:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        gone = set()
        for i in range(len(words) - window + 1):
            if first.setdefault(tuple(words[i : i + window]), (no_id, key, text, i)) != (no_id, key, text, i):
                gone |= set(range(i, i + window))
        again[no_id, key, text] = len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)
    return sorted(((k, *again[k is None, k or 0, t or ""]) for k, t in texts), key=repr)


def rows(found):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found.collect()), key=repr)


def corpus():
    """Shared passages in different surroundings, copies, near copies, periodic texts, a very common line."""
    rng = random.Random(4)
    shared = [prose(900 + i, rng.choice([19, 20, 21, 33, 60])) for i in range(6)]
    line = prose(7, 23)
    out = []
    for i in range(120):
        parts = [prose(i, rng.randint(0, 30))]
        for _ in range(rng.randint(0, 4)):
            parts += [rng.choice([*shared, line, line]), prose(2000 + rng.randrange(500), rng.randint(0, 12))]
        out.append((i, "\n".join(parts)))
    out += [(200 + i, out[3][1]) for i in range(20)]
    out += [(300 + i, " ".join(w if k != 40 + i else "other" for k, w in enumerate(prose(55, 90).split()))) for i in range(20)]
    out += [(400, "a " * 70), (401, "a b " * 50), (402, "b a " * 50 + "c"), (None, out[5][1]), (None, out[5][1]), (9, None)]
    return [x for x in out if x[0] != 9] + [(9, out[4][1])] * 3


@pytest.mark.parametrize("group, limit", [(10_000, 65_536), (3, 5), (1, 1)])
def test_small_groups_and_long_prefixes(spark, group, limit):
    texts = corpus()
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert rows(st.remove_repeats(docs, group=group, limit=limit)) == brute(texts)


def test_other_windows(spark):
    texts = corpus()[:60]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert rows(st.remove_repeats(docs, window=6, anchor=3)) == brute(texts, 6)


def test_odd_documents(spark, clashing_docs, no_docs):
    found = st.remove_repeats(clashing_docs)
    assert found.columns == ["doc_id", "n_words", "n_removed", "removed", "kept"]
    texts = [t for t in ODD_TEXTS if t[0] is not None]
    docs = spark.createDataFrame([(k, t, None, None, None) for k, t in texts], DOCS)
    assert rows(st.remove_repeats(docs)) == brute(texts)
    assert found.count() == len(ODD_TEXTS) and rows(st.remove_repeats(no_docs)) == []


def test_texts_of_one_id(spark):
    """Two texts of one id: the passage stays in exactly one of them."""
    shared = prose(77, 40)
    docs = spark.createDataFrame([(5, shared + " x"), (5, "y " + shared), (6, shared)], "doc_id long, text string")
    found = st.remove_repeats(docs).collect()
    assert sorted(r["n_removed"] for r in found if r["doc_id"] == 5) == [0, 40]
    assert [r["n_removed"] for r in found if r["doc_id"] == 6] == [40]


def test_spans_name_the_removed_words(spark):
    texts = corpus()
    by_id = {k: t for k, t in texts if k is not None}
    for r in st.remove_repeats(spark.createDataFrame(texts, "doc_id long, text string")).where("doc_id IS NOT NULL").collect():
        words = by_id[r["doc_id"]].split()
        for s in reversed(r["removed"]):
            del words[s["start"] : s["end"]]
        assert " ".join(words) == r["kept"] and sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"]


def test_stretches_depend_on_content_only():
    rng = np.random.default_rng(1)
    shared = rng.integers(0, 1 << 62, 200).astype(np.uint64)
    cutter = st.Cutter()
    first, second = (np.concatenate([rng.integers(0, 1 << 62, n).astype(np.uint64), shared]) for n in (31, 57))
    owner, start, count, anchor, content = cutter.cut([first, second])
    sets = [
        {(a, c) for o, s, a, c in zip(owner, start, anchor, content) if o == k and s >= lead + 13}
        for k, lead in enumerate((31, 57))
    ]
    assert sets[0] == sets[1] and len(sets[0]) > 10
    assert (count <= 13).all() and count[owner == 0].sum() == len(first) - 19


def test_word_hashes_do_not_depend_on_place(monkeypatch):
    texts = [(t or "").encode() for _, t in ODD_TEXTS] + [b"\xc2\xa0x y\x1cz", b" lead", b"trail ", b"", b"\x00 \x00\x00"]
    known = {}
    for block in (1 << 20, 64):
        monkeypatch.setattr("shopscope.llm.words.BLOCK", block)
        found = hashed_words(texts, Powers())
        assert [len(f) for f in found] == [len(t.split()) for t in texts]
        for t, f in zip(texts, found):
            for w, h in zip(t.split(), f.tolist()):
                assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)


def test_pieces_split_by_prefix():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 3, (4000, 20)).astype(np.uint64)
    words[:900] = words[0]
    found = list(st.pieces(words, np.arange(4000), 100))
    assert sorted(np.concatenate(found).tolist()) == list(range(4000))
    assert all(len(p) <= 100 or (words[p] == words[p[0]]).all() for p in found)
    where = {}
    for k, p in enumerate(found):
        for row in words[p]:
            assert where.setdefault(row.tobytes(), k) == k


def test_query_digests(spark, tmp_path):
    texts = corpus()
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op12_suffix_trees"](spark, str(tmp_path)).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted(map(tuple, got), key=repr) == sorted(((k, n, r, sha(t)) for k, n, r, t in brute(texts)), key=repr)
