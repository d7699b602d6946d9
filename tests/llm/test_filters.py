"""Personal data, toxicity, url filters and the class model."""

import collections
import hashlib
import math
import random
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shopscope.llm import brown, pii, queries, toxicity, url_filter
from shopscope.llm.char_crf import CharCrf

from .conftest import ODD_TEXTS, prose

SF, SF_MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# -- personal data -------------------------------------------------------------------
def brute_spans(text):
    out = {k: [] for k in pii.KINDS}
    out["email"] = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out["ip"].append(m.span())
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        doubled = [x if i % 2 == 0 else (2 * x if x < 5 else 2 * x - 9) for i, x in enumerate(reversed(d))]
        if 16 <= len(d) <= 19 and sum(doubled) % 10 == 0:
            out["card"].append(m.span())
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            out["phone"].append(m.span())
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    parts = [*"a1.@+-() 0459%_", "1.2.3.4", "300.2.3.4", "a@b.c", "4111 1111 1111 1111", "+1 (319) 555-5132", "\n", "é"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert pii.base_spans(text) == brute_spans(text), repr(text)


def test_base_spans_take_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "@" * 200_000, "a@" * 200_000, "1." * 200_000, "+1(" * 100_000):
        pii.base_spans(text)


@pytest.fixture(scope="module")
def tagger(spark):
    return pii.train(queries.table(spark, SF_MID, "documents"))


def test_crf_gradient():
    model = CharCrf(3, hidden=3)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    rng = np.random.default_rng(0)
    x, y = rng.integers(1, 20, (2, 5)), rng.integers(0, 3, (2, 5))
    _, grads = model.loss_and_gradient(x, y)
    for name in ("xf", "hb", "o", "t", "ob"):
        w = model.weights[name]
        for at in [tuple(rng.integers(0, s) for s in w.shape) for _ in range(4)]:
            old = w[at]
            w[at] = old + 1e-4
            up, _ = model.loss_and_gradient(x, y)
            w[at] = old - 1e-4
            down, _ = model.loss_and_gradient(x, y)
            w[at] = old
            assert abs((up - down) / 2e-4 - grads[name][at]) < 1e-4


def _best_path(scores, moves):
    """The plain Viterbi path over one sequence."""
    best, back = scores[0], []
    for row in scores[1:]:
        through = best[:, None] + moves
        back.append(through.argmax(0))
        best = through.max(0) + row
    tags = [int(best.argmax())]
    for step in reversed(back):
        tags.append(int(step[tags[-1]]))
    return tags[::-1]


def test_long_sequences_are_decoded_whole():
    rng = np.random.default_rng(5)
    model = CharCrf(4, 6)
    model.weights["t"] = rng.normal(0, 2, (4, 4)).astype(np.float32)
    scores = [rng.normal(0, 1, (n, 4)).astype(np.float32) for n in (1, 7, 8, 9, 16, 100, 0, 333)]
    found = model.decode_long(scores, block=8)
    for own, tags in zip(scores, found):
        assert tags.tolist() == (_best_path(own, model.weights["t"]) if len(own) else [])
    assert model.decode_long([]) == []


def test_windows_are_merged_over_the_stretch():
    emitted = np.stack([np.full((pii.WINDOW, 2), v, np.float32) for v in (0.0, 1.0, 1.0)])
    merged = pii.merged_scores(emitted)
    assert merged.shape == (2 * pii.STRIDE + pii.WINDOW, 2)
    assert (merged[: pii.STRIDE] == 0).all() and np.allclose(merged[pii.WINDOW :], 1)
    seam = merged[pii.STRIDE : pii.WINDOW, 0]
    assert (np.diff(seam) > 0).all() and 0 < seam[0] < 0.1 and 0.9 < seam[-1] < 1


def test_tagger_finds_held_out_spans(spark, tagger):
    texts = [r["text"] for r in queries.table(spark, "/root/testdata/sf0.1", "documents").where("doc_id % 7 = 3 and text rlike '[0-9@]'").collect()]
    x, y = pii.training_windows(texts[:400])
    tags = tagger.decode(x)
    assert (tags == y).mean() > 0.97
    assert ((tags == y) & (y > 0)).sum() / (y > 0).sum() > 0.85


def test_model_adds_spans_and_keeps_base(tagger):
    lead, tail = "Theashha nder onha the reti ", " ntly ingor edtion thth andthe of."
    texts = [lead + s + tail for s in ("call (319) 555-5132 now", "at 10 . 2 . 3 . 44 in", "host 10.2.3.44 of", "year 1999 of")]
    base = [pii.base_spans(t) for t in texts]
    added = pii.Tagger(tagger).added(texts, base)
    assert sum(len(v) for a in added[:2] for v in a.values()) >= 1
    assert not any(v for a in added[2:] for v in a.values())
    assert base[2]["ip"]


@pytest.mark.parametrize(
    "kind, text",
    [("phone", "0049 30 1234567"), ("phone", "020 7946 0958"), ("phone", "3195555132"), ("card", "4000.0000.0000.0000.006"),
     ("card", "4111 - 1111 - 1111 - 1111"), ("ip", "10(.)2(.)3(.)44"), ("email", "a.b [@] mail.example.com")],
)
def test_model_spans_need_no_fixed_form(kind, text):
    assert pii.plausible(kind, text)


def test_model_spans_keep_the_rules_of_their_kind():
    wrong = [("phone", "555-5132"), ("phone", "1234567890123456"), ("card", "4111.1111.1111.1112"), ("ip", "10 . 2 . 3 . 256"),
             ("ip", "1, 2, 3, 4"), ("ip", "1 . 2 . 3"), ("email", "a b @ host"), ("email", "a@b@c.d"), ("email", "see you @ mail.example.com")]
    assert not any(pii.plausible(k, t) for k, t in wrong)


def test_tagger_finds_free_forms_and_leaves_other_digits(tagger):
    lead, tail = "Theashha nder onha the reti call ", " ntly ingor edtion thth andthe of."
    rng = random.Random(9)
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    phones = [f"0049 {d(2)} {d(7)}" for _ in range(30)] + [f"020 {d(4)} {d(4)}" for _ in range(30)] + ["3" + d(9) for _ in range(30)]
    others = [f"{rng.randrange(1800, 2030)}" for _ in range(40)] + [f"{rng.randrange(1, 99)},{d(3)},{d(3)}" for _ in range(40)]
    others += [f"{rng.randrange(1900, 2000)}-{rng.randrange(2000, 2030)}" for _ in range(40)] + [f"2019-0{rng.randrange(1, 9)}-1{d(1)}" for _ in range(40)]
    texts = [lead + x + tail for x in phones + others]
    found = [sum(map(len, a.values())) for a in pii.Tagger(tagger).added(texts, [pii.base_spans(t) for t in texts])]
    hits, wrong = sum(n > 0 for n in found[:90]), sum(n > 0 for n in found[90:])
    print("free forms found", [sum(n > 0 for n in found[i : i + 30]) for i in (0, 30, 60)], "of 30 each; other digits marked", wrong, "of 160")
    assert hits >= 60 and hits / (hits + wrong) > 0.9


def test_rare_spans_of_a_large_table_are_all_learnt_from(spark, monkeypatch):
    rare = [(100_000 + i, f"{prose(i, 20)} mail name{i}@mail.example.com or +1 (319) 555-51{i:02} {prose(i, 9)}") for i in range(12)]
    docs = spark.range(20_000).selectExpr("id AS doc_id", "concat('the year ', 1900 + id % 100, ' and of ', id) AS text")
    docs = docs.unionByName(spark.createDataFrame(rare, "doc_id long, text string"))
    seen = []
    monkeypatch.setattr(pii, "training_windows", lambda texts: seen.extend(texts) or (np.zeros((0, 96), np.int64),) * 2)
    assert pii.train(docs) is None
    assert {t for _, t in rare} <= set(seen) and len(seen) <= 5 * 300


def test_windows_cover_every_stretch():
    for length in (1, 47, 48, 95, 96, 97, 500):
        starts = pii.windows(length)
        assert starts[0] == 0 and starts[-1] + pii.WINDOW >= length


def test_pii_odd_documents(clashing_docs, no_docs, tagger):
    rows = pii.find(clashing_docs, tagger).collect()
    assert len(rows) == len(ODD_TEXTS)
    for r in rows:
        texts = [t or "" for k, t in ODD_TEXTS if k == r["doc_id"]]
        assert r["base_text"] in [pii.span_text(brute_spans(t)) for t in texts]
        assert set(filter(None, r["base_text"].split(","))) <= set(r["span_text"].split(","))
    assert pii.find(no_docs, tagger).count() == 0 and pii.train(no_docs) is None
    assert pii.find(clashing_docs, None).where("base_text <> span_text").count() == 0


def test_op1_query_against_patterns(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in queries.table(spark, SF, "documents").collect()}
    for r in queries.op1_bilstm_crf(spark, SF).collect():
        base = brute_spans(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [len(base[k]) for k in pii.KINDS]
        assert r["base_sha256"] == hashlib.sha256(pii.span_text(base).encode()).hexdigest()


def test_redaction_masks_spans(clashing_docs, tagger):
    rows = {r["doc_id"]: r for r in pii.redacted(clashing_docs, tagger).collect()}
    assert rows[9]["text"] == "mail <email> or <phone>, card <card>, host <ip>."
    assert rows[1]["text"] is None and rows[2]["text"] == "" and rows[5]["text"] == ODD_TEXTS[4][1]
    assert rows[5]["rep"] == "clash"


# -- toxicity --------------------------------------------------------------------------
def test_noisy_or_learns_and_locates():
    clean = [". ".join(prose(100 * d + s, 9) for s in range(6)) + ". you are a kind person" for d in range(120)]
    foul = [c + ". you are a vilething person. " + prose(d, 8) for d, c in enumerate(clean[:60])]
    model = toxicity.fit(clean + foul, [0] * len(clean) + [1] * len(foul))
    scorer = toxicity.Scorer(model)
    score, spans = scorer.text("Quiet river stone. Some Vilething, indeed! The end.")
    assert score >= 0.7 and len(spans) == 1
    assert "Quiet river stone. Some Vilething, indeed! The end."[spans[0]["start"] : spans[0]["end"]] == " Some Vilething, indeed"
    assert scorer.text("Quiet river stone. The end.")[0] < 0.3


def test_toxicity_cases(spark, clashing_docs, no_docs):
    labels = spark.createDataFrame([(5, 0), (5, 1), (6, 0), (7, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(clashing_docs, labels)
    rows = toxicity.score(clashing_docs, model).collect()
    assert len(rows) == len(ODD_TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0.0}
    assert toxicity.train(no_docs, labels).constant == 0.0
    assert toxicity.score(no_docs, model).count() == 0
    only = toxicity.train(clashing_docs, labels.where("doc_id = 6"))
    assert only.constant == 0.0


def test_op5_held_out_accuracy(spark):
    rows = queries.op5_toxicity(spark, "/root/testdata/sf0.1").join(
        queries.table(spark, "/root/testdata/sf0.1", "labels"), "doc_id"
    ).where("held_out").select("score", "predicted", "toxic").toPandas()
    assert (rows["predicted"] == rows["toxic"]).mean() > 0.97
    assert rows.loc[rows["toxic"] == 1, "predicted"].mean() > 0.7


# -- url filters -------------------------------------------------------------------------
def test_digest_array_confirms_strings(tmp_path):
    path = str(tmp_path / "d.bin")
    entries = [f"host{i}.example/{i}" for i in range(300)]
    url_filter.write_digests(path, entries, hashed=lambda s: len(s))  # every digest collides
    array = url_filter.DigestArray(path, hashed=lambda s: len(s))
    probes = entries[::7] + ["hostx.example/x", "", "host1.example/11"]
    assert array.contains(probes).tolist() == [p in set(entries) for p in probes]
    url_filter.write_digests(path, [])
    assert not url_filter.DigestArray(path).contains(["a"]).any()


def test_url_split():
    for url, want in {
        None: ("", ""),
        "no-scheme.example/x": ("", ""),
        "http://A.Example.ORG/en/1?x#y": ("a.example.org", "/en/1"),
        "http://h?x/y": ("h", ""),
        "x://h#/y://z": ("h", ""),
        "http://": ("", ""),
        "a://b://c/d": ("b:", "//c/d"),
    }.items():
        assert url_filter.split_url(url) == want


def test_list_from_a_table(spark):
    """Verdicts of a list given as a table, over several arrays and parts, equal those of the short list."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    odd = [(-1, None), (-2, "x"), (-3, "http://SUB.Bad.test/a"), (-3, "http://bad.test.org/"), (-4, "http://notbad.test/"), (-5, "http://a..b/"), (None, "http://bad.test")]
    pages = pages.unionByName(spark.createDataFrame(odd, pages.schema))
    hosts = [r[0] for r in url_filter.judge(pages, listed_hosts=()).select("host").distinct().orderBy("host").collect()]
    listed = ["BAD.test", "bad.test", "absent.example", ".b", *[h for h in hosts[::5] if h]]
    table = spark.createDataFrame([(h,) for h in [*listed, None, ""]], "host string")
    want = url_filter.judge(pages, listed_hosts=[h.lower() for h in listed])
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(url_filter.judge(pages, listed_hosts=table)) == rows(want)
    found = url_filter.listed_hosts_among(want.select("host"), table, shard_entries=3)
    by_hand = {h for h in hosts if any(s in {x.lower() for x in listed} for s in url_filter.host_suffixes(h))}
    assert {r["host"] for r in found.collect()} == by_hand and len(by_hand) > 3
    assert rows(url_filter.judge(pages, listed_hosts=table.limit(0))) == rows(url_filter.judge(pages, listed_hosts=()))
    assert url_filter.judge(pages.limit(0), listed_hosts=table).count() == 0


def test_rules_and_list(spark):
    urls = {
        "http://x.example.org/en/12": ("example.org/en/1", "block"),
        "http://example.org/es/9": ("example.org/es/", "block"),
        "http://notexample.org/es/9": ("org/", "allow"),
        "http://a.com/de/": ("com/de/", "block"),
        "http://a.com/de": (None, "allow"),
        "http://a.com/fr/?q": ("com/fr/", "allow"),
        "http://m.spam-farm.example.net/x": (None, "block"),
        "http://myspam-farm.example.net/x": (None, "allow"),
        "http://spam-farm.example.com/fr/x": ("com/fr/", "allow"),
        "http://org": (None, "allow"),
        None: (None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge(pages).collect()}
    assert got == dict(enumerate(urls.values()))
    assert url_filter.judge(pages.where("false")).count() == 0


def test_rules_are_those_of_the_contract(spark, tmp_path):
    """Every rule's word, in the operator, its query and its SQL, against the contract's list."""
    contract = "allow org/, block example.org/es/, block example.org/en/1, allow com/fr/, block com/de/"
    words = {rule: word for word, rule in (x.split(" ") for x in contract.split(", "))}
    assert {host + path: verdict for verdict, host, path in url_filter.RULES} == words and len(url_filter.RULES) == len(words)
    urls = [f"http://{prefix}{rule}{rest}" for rule in words for prefix in ("", "sub.") for rest in ("", "2", "/x?y#z")]
    urls += ["http://example.org/en/2", "http://example.org/en/", "http://notexample.org/en/1"]

    def fitting(url):
        host, _, path = url[len("http://") :].partition("/")
        fits = [r for r in words if f".{host}".endswith("." + r.partition("/")[0]) and path.startswith(r.partition("/")[2])]
        return max(fits, key=len)

    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in queries.op6_url_digests(spark, str(tmp_path)).collect()}
    assert got == {i: (fitting(u), words[fitting(u)]) for i, u in enumerate(urls)}
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert {r[0]: (r[3], r[4]) for r in db.execute(queries.ORACLE_SQL["op6_url_digests"]).fetchall()} == got


# -- class model ---------------------------------------------------------------------------
def brute_base(rows, learns):
    tokens = [[w for w in re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))] + [None] for _, t in rows]
    counts = collections.Counter(w for (k, _), own in zip(rows, tokens) if learns(k) for w in own)
    n, v = sum(counts.values()), len(counts)
    base = [sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own) for own in tokens]
    return [(k, len(own), sum(counts[w] > 0 for w in own), n, b) for (k, _), own, b in zip(rows, tokens, base)]


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[4]))


def test_class_model_odd_documents(clashing_docs, no_docs):
    learns = lambda k: k is None or zlib.crc32(str(k).encode()) % 7 != 2
    out = brown.score(clashing_docs, ~queries.held_out(7, 2)).collect()
    got = ordered([tuple(r)[:5] for r in out])
    want = ordered(brute_base(ODD_TEXTS, learns))
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[4] for r in got], [r[4] for r in want])
    assert all(r["score"] <= 1e-9 and math.isfinite(r["score"]) for r in out)
    assert brown.score(no_docs, ~queries.held_out(7, 2)).count() == 0
    none = brown.score(clashing_docs, F.lit(False)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 for r in none)


def test_class_model_is_a_distribution(spark):
    """Over all texts of one word, known or not, and the empty text, probabilities add up to at most 1."""
    learnt = ["a b", "b c", "a c d", "d"]
    probes = ["", "a", "b", "c", "d", "zz"]
    rows = [(1000 + i, t) for i, t in enumerate(learnt)] + [(i, t) for i, t in enumerate(probes)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r["score"] for r in brown.score(docs, F.col("doc_id") >= 1000).collect()}
    assert sum(10 ** out[i] for i in range(len(probes))) <= 1 + 1e-9


def test_best_class_gain_is_the_likelihood_gain():
    rng = np.random.default_rng(2)
    n_words, classes = 12, 3
    size = brown.FIXED + n_words
    pairs = rng.integers(0, 9, (size, size)).astype(float)
    of = np.concatenate([np.arange(brown.FIXED), brown.FIXED + np.arange(n_words) % classes])

    def bigrams(of):
        n = np.zeros((brown.FIXED + classes,) * 2)
        np.add.at(n, (of[:, None].repeat(size, 1), of[None, :].repeat(size, 0)), pairs)
        return n

    def likelihood(of):
        n = bigrams(of)
        f = lambda x: (x * np.log(np.maximum(x, 1e-300))).sum()
        return f(n) - f(n.sum(1)) - f(n.sum(0))

    for w in range(brown.FIXED, size):
        n = bigrams(of)
        left, right = np.bincount(of, pairs[:, w], len(n)), np.bincount(of, pairs[w], len(n))
        to, gain = brown.best_class(n, int(of[w]), left, right, pairs[w, w])
        moved = of.copy()
        moved[w] = to
        assert abs(likelihood(moved) - likelihood(of) - gain) < 1e-6
        others = []
        for k in range(classes):
            other = of.copy()
            other[w] = brown.FIXED + k
            others.append(likelihood(other))
        assert max(others) <= likelihood(moved) + 1e-6


def test_op3_query_base_scores(spark):
    rows = [(r["doc_id"], r["text"]) for r in queries.table(spark, SF, "documents").collect()]
    want = {r[0]: r for r in brute_base(rows, lambda k: zlib.crc32(str(k).encode()) % 7 != 2)}
    out = queries.op3_brown(spark, SF).collect()
    assert len(out) == len(rows)
    for r in out:
        k, n, known, total, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert abs(r["base_score"] - base) < 1e-6 * abs(base)
        assert r["held_out"] == (zlib.crc32(str(k).encode()) % 7 == 2)
    held = [r for r in out if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) * 1.05


def test_best_classes_of_many_words_equal_one_by_one():
    rng = np.random.default_rng(5)
    n_words, classes = 40, 4
    size = brown.FIXED + n_words
    pairs = rng.integers(0, 3, (size, size)).astype(float) * (rng.random((size, size)) < 0.3)
    of = np.concatenate([np.arange(brown.FIXED), brown.FIXED + np.arange(n_words) % classes])
    n = np.zeros((brown.FIXED + classes,) * 2)
    np.add.at(n, (of[:, None].repeat(size, 1), of[None, :].repeat(size, 0)), pairs)
    words = np.arange(brown.FIXED, size)
    left = np.stack([np.bincount(of, pairs[:, w], len(n)) for w in words])
    right = np.stack([np.bincount(of, pairs[w], len(n)) for w in words])
    to, gain = brown.best_classes(n, of[words], left, right, pairs[words, words])
    for i, w in enumerate(words):
        one, more = brown.best_class(n, int(of[w]), left[i], right[i], pairs[w, w])
        assert abs(more - gain[i]) < 1e-6 and (one == to[i] or abs(more) < 1e-6)


def test_words_of_a_flat_corpus_are_clustered(spark):
    """12,000 words, each far below a share of 1e-4, of one shape: half stand after x, half after y."""
    name = lambda i: "w" + "".join(chr(97 + i // 26**j % 26) for j in range(5))
    rng = random.Random(6)
    first, second = [name(i) for i in range(6000)], [name(i) for i in range(6000, 12_000)]
    pairs = [(rng.choice(first) if t >= 6 else first[i], rng.choice(second) if t >= 6 else second[i]) for t in range(8) for i in range(6000)]
    rows = [(100 + i, " ".join(f"x {a} y {b}" for a, b in pairs[i * 60 : i * 60 + 60])) for i in range(800)]
    rows += [(1, " ".join(f"x {a} y {b}" for a, b in zip(first[:50], second))), (2, " ".join(f"x {b} y {a}" for a, b in zip(first[:50], second)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r["score"] for r in brown.score(docs, F.col("doc_id") >= 100).where("doc_id < 100").collect()}
    assert out[1] > out[2] + 50


def test_neighbours_are_counted_in_bounded_memory():
    """Two million distinct pairs: the same counts and blocks as by brute force, in less than 64 more bytes a pair."""
    rng = np.random.default_rng(8)
    words, blocks = 20_000, 30
    space = brown.FIXED + words
    distinct = rng.choice(space * space, 2_000_000, replace=False)
    fresh = [np.concatenate([part, part[: len(part) // 4]]) for part in np.array_split(distinct, 5)]
    want, times = np.unique(np.concatenate(fresh), return_counts=True)
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for part in fresh:
        keys, counts = brown.merged(keys, counts, [part[:70_000], part[70_000:]])
    assert (keys == want).all() and (counts == times).all()
    assert brown.merged(keys, counts, []) == (keys, counts)
    again, more = brown.merged(keys[:9], counts[:9].copy(), [keys[5:12], keys[:1]])
    assert (again == keys[:12]).all() and (more == [*counts[:9], 0, 0, 0] + np.array([1, 0, 0, 0, 0, 1, 1, 1, 1, 1, 1, 1])).all()
    assert not list(brown.by_block(keys[:0], counts[:0], space, blocks))

    tracemalloc.start()
    parts, checked = 0, 0
    for rows in brown.by_block(keys, counts, space, blocks):
        parts += 1
        checked += sum(len(packed) // 16 for _, packed in rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert parts > 4 and peak < 64 * len(keys)
    assert checked == len(keys) + (keys % space >= brown.FIXED).sum()

    pairs = collections.Counter()
    for rows in brown.by_block(keys[::50], counts[::50], space, blocks):
        for block, packed in rows:
            for w, o, n in zip(*(x.tolist() for x in brown.unpacked([packed]))):
                assert block == (blocks + max(o, ~o) % blocks if w < brown.FIXED + brown.HEADS else w % blocks)
                pairs[w, o] += n
    by_hand = collections.Counter()
    for key, n in zip(keys[::50].tolist(), counts[::50].tolist()):
        by_hand[key // space, key % space] += n
        if key % space >= brown.FIXED:
            by_hand[key % space, ~(key // space)] += n
    assert pairs == by_hand


def test_words_of_texts_equal_a_plain_split():
    rng = random.Random(11)
    parts = [*"aZé \x1c  \t\n\x0b\f\r", "  ", "Bİ", "word ", "😀"]
    texts = ["", " ", *(t or "" for _, t in ODD_TEXTS), *("".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000))]
    want = [t.encode().lower().split() for t in texts]
    for column in (pa.array(["x", *texts])[1:], pa.array(texts, pa.large_string())):
        sizes, codes, words = brown.words_of(column)
        assert sizes.tolist() == [len(w) for w in want] and brown.bytes_of(words) == words.to_pylist()
        assert [words[c].as_py() for c in codes] == [w for own in want for w in own]
    names = sorted({w for own in want for w in own} | {b"a1", b"7", b"x-y", b"abcdefghijklm", b"\xc3\xa9" * 9})
    kind = lambda w: 0 if w.isalpha() else 1 if not w.isascii() else 2 if w.isalnum() else 3
    array = pa.array([b"before", *names], pa.binary())[1:]
    assert brown.bytes_of(array) == names and not brown.bytes_of(array[:0])
    assert brown.shape_classes(array).tolist() == [1 + 4 * kind(w) + min(3, len(w) // 4) for w in names]
    ids = brown.with_ends(np.array([2, 0, 1]), np.array([7, 8, 9]), 0)
    assert ids.tolist() == [7, 8, 0, 0, 9, 0]


def test_texts_are_grouped_by_size(monkeypatch):
    monkeypatch.setattr(brown, "GROUP_BYTES", 100)
    rng = random.Random(12)
    texts = ["x" * rng.choice([0, 1, 30, 99, 100, 500]) for _ in range(300)]
    batches = [pa.record_batch([pa.array(range(i, i + 7)[: len(texts) - i]), pa.array(texts[i : i + 7])], ["id", "text"]) for i in range(0, 300, 7)]
    groups = [g.to_pydict() for g in brown.grouped(iter([*batches, batches[0][:0]]), 1)]
    assert [t for g in groups for t in g["text"]] == texts and [i for g in groups for i in g["id"]] == list(range(300))
    assert all(sum(len(t) + 1 for t in g["text"][:-1]) < 100 for g in groups)
    assert all(sum(len(t) + 1 for t in g["text"]) >= 100 for g in groups[:-1])


def test_neighbours_are_packed_in_few_bytes():
    """Rows read back as they were, in less than half of the 16 bytes a pair of before, whatever the counts."""
    rng = np.random.default_rng(13)
    for most in (1, 255, 256, 1 << 16, 1 << 33):
        w, o = np.sort(rng.integers(0, 40, 500)), rng.integers(-(1 << 31), 1 << 31, 500)
        n = np.append(rng.integers(1, most + 1, 499), most)
        row = brown.packed_runs(w, o, n)
        assert len(row) < 500 * 8 or most >= 1 << 16
        for got, twice in zip(brown.spread([row, row]), (w, o, n)):
            assert got.dtype == np.int64 and (got == np.concatenate([twice, twice])).all()
    assert [len(x) for x in brown.spread([])] == [0, 0, 0]


def test_moves_at_once_equal_moves_one_by_one():
    rng = np.random.default_rng(14)
    own, to, same = rng.integers(0, 9, 30), rng.integers(0, 9, 30), rng.integers(0, 3, 30).astype(float)
    left, right = rng.integers(0, 5, (2, 30, 9)).astype(float)
    one, at_once = np.zeros((9, 9)), np.zeros((9, 9))
    for x in zip(own, to, left, right, same):
        brown._moved(one, *x)
    brown._moved_at_once(at_once, own, to, left, right, same)
    assert (one == at_once).all()


def test_rare_words_are_joined_without_sorting_rows_of_texts(spark, clashing_docs):
    plan = brown.score(clashing_docs, ~queries.held_out(7, 2))._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
