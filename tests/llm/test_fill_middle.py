"""Fill-in-middle outputs against slicing, and exact restoring."""

import hashlib
import random
import re

import pytest

from shopscope.llm import queries
from shopscope.llm.fill_middle import Choice, exchange, fill_in_middle, restore, transform

from .conftest import ODD_TEXTS

SF = "/root/testdata/sf0.001"


def by_slicing(key, text, seed=7, rate=100, share=50):
    """The contract, written with lists and slices."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted(x % (len(lines) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(lines), "plain", None, None, text, text
    if h[3] % 100 < share:
        return len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def check(rows, texts, **options):
    got = sorted((tuple(r)[:7] for r in rows), key=repr)
    assert got == sorted([(k, *by_slicing(k, t, **options)) for k, t in texts], key=repr)


def test_exchange_moves_blocks():
    for a in range(5):
        for b in range(5):
            buffer = bytearray(b"head" + b"x1y2z"[:a] + b"ABCDE"[:b] + b"tail")
            exchange(buffer, 4, 4 + a, 4 + a + b)
            assert buffer == b"head" + b"ABCDE"[:b] + b"x1y2z"[:a] + b"tail"


def test_every_cut_of_odd_texts():
    rng = random.Random(3)
    pieces = ["\n", "a", "é😀", "<", "P>", "<S", ">", "M", " ", "\r", "\x00", " "]
    for _ in range(2000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 9)))
        key = rng.randint(-5, 10**6)
        n, form, p, m, out = transform(text.encode(), Choice.of(7, key))
        back = bytearray(out)
        restore(back, form)
        assert (n, form, p, m, out.decode(), back.decode()) == by_slicing(key, text)


def test_odd_documents(spark, clashing_docs, no_docs):
    check(fill_in_middle(clashing_docs).collect(), ODD_TEXTS)
    check(fill_in_middle(clashing_docs, seed=11, rate=50, spm_share=20).collect(), ODD_TEXTS, seed=11, rate=50, share=20)
    assert fill_in_middle(no_docs).collect() == []


def test_sentinels_and_lines(spark):
    texts = [(i, t) for i, t in enumerate(["a<P>b\nc", "<S>", "x\n" * 50_000, "\n\n\n", "one line", "< P>\n<\nM>\n<S\n>"] * 8)]
    check(fill_in_middle(spark.createDataFrame(texts, "doc_id int, text string")).collect(), texts)


@pytest.mark.parametrize("form", ["psm", "spm"])
def test_query_uses_both_forms(spark, form):
    rows = queries.QUERIES["op13_block_rotation"](spark, SF).where(f"form = '{form}'").collect()
    assert rows and all(r["output_sha256"] != r["restored_sha256"] for r in rows)
