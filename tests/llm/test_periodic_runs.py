"""Periodic runs against a comparison of all words at all distances."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from shopscope.llm import periodic_runs as pr
from shopscope.llm import queries

from .conftest import ODD_TEXTS, prose


def brute_runs(words, least=6):
    """All (start, length, period), from the definition."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 4 * q) and j > i:
                part = words[i : j + q]
                if not any(all(part[k] == part[k + p] for k in range(len(part) - p)) for p in range(1, q)):
                    found.append((i, j - i + q, q))
            i = j + 1
    return sorted(found)


def brute_row(key, text):
    """The contract of the query for one document."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(b"" if key is None else str(key).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (key, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(listed), sha(kept))


def test_small_alphabets_equal_brute_force():
    rng = random.Random(11)
    for _ in range(60):
        documents = []
        for _ in range(rng.randint(1, 12)):
            letters, text = rng.choice([1, 2, 2, 3, 9]), []
            while len(text) < rng.randint(0, 260):
                part = [rng.randrange(letters) for _ in range(rng.randint(1, 24))]
                text += part * rng.choice([1, 1, 2, 4, 5, 9]) + part[: rng.randint(0, len(part))]
            documents.append(np.array(text, np.int64))
        got = pr.runs_of(documents)
        for text, runs in zip(documents, got):
            assert [r for r in runs if r[1] >= 6] == brute_runs(text.tolist()), text.tolist()


def test_self_similar_words():
    """Fibonacci and Thue-Morse words, powers of powers, and periods with long inner runs."""
    fib, other = [0, 1], [0]
    while len(fib) < 700:
        fib, other = fib + other, fib
    morse = [bin(i).count("1") % 2 for i in range(600)]
    nested = (([1] * 30 + [2]) * 6 + [3, 1, 1]) * 5
    deep = ((([1, 2] * 9 + [3]) * 5 + [4] * 17) * 4 + [5]) * 4
    cases = [fib, morse, nested, deep, [7] * 500, [1, 2, 3] * 200, ([1] * 40 + [2] * 41) * 4, list(range(300)) * 4]
    for text, runs in zip(cases, pr.runs_of([np.array(c, np.int64) for c in cases])):
        assert [r for r in runs if r[1] >= 6] == brute_runs(text)


def test_every_period_and_cut():
    rng = random.Random(5)
    for q in range(1, 70):
        part = [rng.randrange(5) for _ in range(q)]
        text = [9] + (part * 6)[: 4 * q + rng.randrange(2 * q)] + [8, 9]
        assert [r for r in pr.runs_of([np.array(text, np.int64)])[0] if r[1] >= 6] == brute_runs(text)


def test_groups_do_not_change_results(monkeypatch):
    texts = [prose(i, 80).encode().split() + [b"x", b"y"] * i for i in range(30)]
    whole = pr.group_documents(texts)
    monkeypatch.setattr(pr, "GROUP_WORDS", 100)
    assert pr.group_documents(texts) == whole and any(whole)


def test_query_equals_brute_force(spark, clashing_docs, no_docs, tmp_path):
    texts = [t for t in ODD_TEXTS if len(t[1] or "") < 5000]
    texts += [(100 + i, "a b " * i + "c " * (i % 9) + prose(i, 20) + " tail of words\n" * (i % 7)) for i in range(60)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.QUERIES["op11_sync_runs"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted((brute_row(k, t) for k, t in texts), key=repr)
    assert pr.periodic_runs(no_docs).collect() == []
    assert pr.periodic_runs(clashing_docs).count() == len(ODD_TEXTS)


def test_very_long_text():
    rng = np.random.default_rng(2)
    part = rng.integers(0, 50, 4000)
    text = np.concatenate([rng.integers(0, 50, 30_000), np.tile(part, 6), rng.integers(0, 50, 10_000), np.full(9, 51)])
    runs = [r for r in pr.runs_of([text])[0] if r[2] > 3 or r[0] > 60_000]
    assert len(runs) == 2 and runs[0][2] == 4000 and runs[0][1] >= 24_000 and runs[1] == (64_000, 9, 1)
