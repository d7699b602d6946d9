"""Encoding, chunk reuse, packing and wavelet shards against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from shopscope.llm import bpe_chunks, curve_packing, queries, wavelet
from shopscope.llm.common import shared_folder, with_offsets
from shopscope.llm.vocab import TextEncoder, public_path

from .conftest import ODD_TEXTS, prose

SF = "/root/testdata/sf0.001"
PIECES = ["a", "b", " ", "  ", "\n", "\t", "'s", "'S", "é", "É", "İ", "Σ", "9", "12", ".", ",", "\x1c", "\xa0", "µ", "<|endoftext|>"]
PIECES += ["ﬁ", "é", "中", "😀", "\r", "don't", "I'LL", " the", "~", "ſ", "K", "²", "ª", "\x85", "\xad", "\x0b"]


def library(name):
    return Tokenizer.from_file(public_path(name))


@pytest.mark.parametrize("name", [queries.BYTE_BPE, queries.WORD_BPE])
def test_encoder_equals_library_on_odd_strings(name):
    enc, rng = TextEncoder(public_path(name)), random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 10)))
        assert enc.encode(text) == enc.whole(text), repr(text)


def test_marked_words_equal_library():
    """Every sign of up to two bytes, alone and between others, and the length at which the library takes over."""
    enc, rng = TextEncoder(public_path(queries.WORD_BPE)), random.Random(8)
    signs = [chr(c) for c in [*range(0x20, 0x7F), *range(0xA1, 0x250)]]
    texts = [f"{c} a{c} {c}b{c}c {c}{c}" for c in signs]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    texts += ["".join(rng.choice("abct hes.é,ñ1 \n") for _ in range(rng.randint(1, 90))) for _ in range(2000)]
    texts += ["ab" * n for n in (199, 200, 201, 5000)] + ["\x0b", "\x85a", "a\x7fb", "", "Ⱥb"]
    texts += [t or "" for _, t in ODD_TEXTS]
    for size in (1, 7, len(texts)):
        for at in range(0, len(texts), size):
            part = texts[at : at + size]
            assert enc.encode_many([t.encode() for t in part]) == [enc.whole(t) for t in part]
        enc.known.clear()


def test_known_words_overflow_keeps_results(monkeypatch):
    monkeypatch.setattr("shopscope.llm.vocab.POOL_IDS", 30)
    monkeypatch.setattr("shopscope.llm.vocab.GROUP_BYTES", 60)
    monkeypatch.setattr("shopscope.llm.vocab.KnownWords.BITS", 4)
    enc = TextEncoder(public_path(queries.WORD_BPE))
    for seed in range(6):
        texts = [prose(seed, 50), "", prose(seed + 1, 9) + " é,É9"]
        assert enc.encode_many([t.encode() for t in texts]) == [enc.whole(t) for t in texts]


def test_memo_overflow_keeps_results(monkeypatch):
    monkeypatch.setattr("shopscope.llm.vocab.MEMO_ENTRIES", 8)
    enc = TextEncoder(public_path(queries.WORD_BPE))
    text = prose(9, 400)
    assert enc.encode(text) == enc.whole(text) == enc.encode(text)


def test_chunk_encoder_repairs_every_cut():
    chunker, rng = bpe_chunks.ChunkEncoder(public_path(queries.WORD_BPE)), random.Random(6)
    chunker.cutter = bpe_chunks.Cutter(16)  # cuts inside most words
    for _ in range(400):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 200)))
        assert chunker.encode(text) == chunker.enc.whole(text), repr(text)
    text = prose(1, 5000)
    assert chunker.encode(text) == chunker.enc.whole(text)


def test_cuts_depend_on_content_only():
    cutter = bpe_chunks.Cutter(64)
    shared = prose(3, 3000).encode()
    for lead in (b"short lead ", prose(8, 333).encode()):
        moved = [c - len(lead) for c in cutter.cuts(lead + shared) if c > len(lead) + bpe_chunks.WINDOW]
        assert moved == [c for c in cutter.cuts(shared) if c > bpe_chunks.WINDOW]


def test_encode_decode_odd_documents(clashing_docs):
    tok = library(queries.WORD_BPE)
    out = bpe_chunks.encode_decode(clashing_docs, public_path(queries.WORD_BPE)).collect()
    want = []
    for key, text in ODD_TEXTS:
        ids = tok.encode(text or "", add_special_tokens=False).ids
        want.append((key, len(ids), np.asarray(ids, "<u4").tobytes(), tok.decode(ids, skip_special_tokens=False)))
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert order([(r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in out]) == order(want)


def test_op9_query_equals_library(spark):
    tok = library(queries.WORD_BPE)
    texts = {r["doc_id"]: r["text"] or "" for r in queries.table(spark, SF, "documents").collect()}
    for r in queries.op9_bpe_chunks(spark, SF).collect():
        ids = tok.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_empty_tables(spark, no_docs):
    assert bpe_chunks.encode_decode(no_docs, public_path(queries.WORD_BPE)).count() == 0
    assert curve_packing.pack(no_docs, public_path(queries.BYTE_BPE)).count() == 0
    path = shared_folder(spark)
    wavelet.write_shards(no_docs, path, public_path(queries.WORD_BPE))
    assert wavelet.document_digests(spark, path).count() == 0


# -- packing -----------------------------------------------------------------------
def check_pieces(rows, documents):
    """Every id once, sequences gapless and full but the last."""
    got, used = {}, {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == used.get(r["sequence_id"], 0)
        used[r["sequence_id"]] = r["offset"] + r["length"]
        got.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], bytes(r["ids"])))
    assert sorted(used) == list(range(len(used)))
    assert all(n == 2048 for s, n in used.items() if s < len(used) - 1)
    whole = sorted(b"".join(x for _, x in sorted(v)) for v in got.values())
    assert whole == sorted(np.asarray(d, "<u4").tobytes() for d in documents)


def test_packing_odd_documents(clashing_docs):
    tok = library(queries.BYTE_BPE)
    rows = curve_packing.pack(clashing_docs, public_path(queries.BYTE_BPE)).collect()
    once = {(k, t): tok.encode(t or "", add_special_tokens=False).ids + [1] for k, t in ODD_TEXTS}
    assert sum(r["length"] for r in rows) == sum(len(once[x]) for x in ODD_TEXTS)
    single = [r for r in rows if r["doc_id"] not in (10, None)]
    got = {}
    for r in single:
        got.setdefault(r["doc_id"], []).append((r["start"], bytes(r["ids"])))
    for (k, _), ids in once.items():
        if k not in (10, None):
            assert b"".join(x for _, x in sorted(got[k])) == np.asarray(ids, "<u4").tobytes()


def test_op2_query_packs_all_ids(spark, monkeypatch):
    monkeypatch.setattr(curve_packing, "RANGE_TOKENS", 10_000)  # several ranges
    tok = library(queries.BYTE_BPE)
    docs = queries.table(spark, SF, "documents")
    texts = [r["text"] or "" for r in docs.orderBy("doc_id").collect()]
    rows = curve_packing.pack(docs, public_path(queries.BYTE_BPE)).collect()
    check_pieces(rows, [e.ids + [1] for e in tok.encode_batch(texts, add_special_tokens=False)])
    digests = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in queries.op2_curve_packing(spark, SF).collect()}
    assert all(0 <= v < 1 << 32 for v in digests.values())


def test_hilbert_curve_walks_to_neighbours():
    side = 8
    cells = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    keys = curve_packing.hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(side**3))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_copies_are_neighbours_on_the_curve():
    a, b = (np.arange(50) * 7 % 997), np.arange(1, 400) * 31 % 5003
    assert (curve_packing.grid_cell(a) == curve_packing.grid_cell(a[::-1])).all()
    assert not (curve_packing.grid_cell(a) == curve_packing.grid_cell(b)).all()


# -- wavelet shards ----------------------------------------------------------------
def test_wavelet_matrix_operations():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 513, 3000):
        ids = rng.integers(0, 37, n).astype(np.uint16)
        wm = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(ids, 6).to_bytes())
        assert (wm.decode() == ids).all()
        for i in range(0, n, 97):
            assert wm.access(i) == ids[i]
        for token in (0, 5, 36, 63, 64):
            assert wm.count(token) == (ids == token).sum()
            assert wm.count(token, n // 2) == (ids[: n // 2] == token).sum()
            assert wm.occurrences(token) == np.flatnonzero(ids == token).tolist()


def test_shards_round_trip_odd_documents(spark, clashing_docs, monkeypatch):
    monkeypatch.setattr(wavelet, "RANGE_CHARS", 50_000)
    monkeypatch.setattr(wavelet, "SHARD_TOKENS", 1000)
    tok = library(queries.WORD_BPE)
    path = shared_folder(spark)
    wavelet.write_shards(clashing_docs, path, public_path(queries.WORD_BPE))
    rows = wavelet.read_documents(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, None, *sorted(k for k, _ in ODD_TEXTS if k is not None)]
    at = 0
    texts = {}
    for k, t in ODD_TEXTS:
        texts.setdefault(k, []).append(np.asarray(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes())
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
        assert bytes(r["ids"]) in texts[r["doc_id"]]


def test_op7_query_equals_library(spark):
    tok = library(queries.WORD_BPE)
    at = 0
    got = {r["doc_id"]: r for r in queries.op7_wavelet(spark, SF).collect()}
    for r in queries.table(spark, SF, "documents").orderBy("doc_id").collect():
        ids = tok.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        own = got[r["doc_id"]]
        assert (own["start"], own["n_tokens"]) == (at, len(ids))
        assert own["ids_crc32"] == zlib.crc32(np.asarray(ids, "<u4").tobytes())
        at += len(ids)


def test_offsets_over_blocks(spark, monkeypatch):
    monkeypatch.setattr("shopscope.llm.common.OFFSET_BLOCK", 4)
    sizes = spark.createDataFrame([(i * 3, i + 1) for i in range(20)], "k long, n long")
    got = {r["k"]: r["start"] for r in with_offsets(sizes, "k", "n").collect()}
    assert got == {i * 3: i * (i + 1) // 2 for i in range(20)}
