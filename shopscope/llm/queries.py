"""Registered queries of the corpus operators, over a directory of tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_chunks, brown, cap_filters, curve_packing, fill_middle, maxscore, odd_sketch, periodic_runs, pii, suffix_trees, toxicity, url_filter, wavelet
from .common import id_remainder, shared_folder, small_batches
from .vocab import public_path

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bilstm_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans counted and digested, and all spans."""
    docs = table(spark, sf_dir, "documents")
    out = pii.find(docs, pii.train(docs))
    kinds = F.col("base")["kind"]
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return out.select(
        "doc_id", *counts, F.sha2(F.col("base_text").cast("binary"), 256).alias("base_sha256"), F.col("span_text").alias("spans")
    )


def op2_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences, one row per piece."""
    out = curve_packing.pack(table(spark, sf_dir, "documents"), public_path(BYTE_BPE))
    return out.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op3_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base and class-model probabilities, learnt from those not held out."""
    out = brown.score(table(spark, sf_dir, "documents"), ~held_out(7, 2))
    return out.select(
        "doc_id", held_out(7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op4_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best other vectors of every vector whose id is divisible by 100."""
    found = maxscore.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)
    return found.withColumnRenamed("id", "vec_id")


#: Documents with this score or more are predicted as toxic.
TOXIC_SCORE = 0.7


def held_out(modulus: int, remainder: int):
    """Whether crc32 of the id, modulo ``modulus``, is ``remainder`` (null ids: not)."""
    return F.coalesce(id_remainder("doc_id", modulus) == remainder, F.lit(False))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learnt from labelled documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out(3, 1))
    out = toxicity.score(docs, toxicity.train(docs, labels))
    return out.select(
        "doc_id",
        held_out(3, 1).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_SCORE).cast("int").alias("predicted"),
        F.size("offending").cast("long").alias("n_offending"),
    )


def op6_url_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the rules and the listed hosts."""
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op7_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written to wavelet shards and read back, as digests."""
    path = shared_folder(spark)
    wavelet.write_shards(table(spark, sf_dir, "documents"), path, public_path(WORD_BPE))
    return wavelet.document_digests(spark, path)


def op8_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links and component at cosine 0.93 inside its label."""
    return cap_filters.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded, as digests."""
    out = bpe_chunks.encode_decode(table(spark, sf_dir, "documents"), public_path(WORD_BPE))
    return out.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op10_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate component at similarity 0.75 of 5-word shingles."""
    return odd_sketch.near_duplicates(table(spark, sf_dir, "documents"))


def repeated_tail(key: int | None, n: int) -> np.ndarray | None:
    """The contract's rewriting: of one id in ten the words from some place on repeat a part of the text."""
    h = zlib.crc32(b"" if key is None else str(key).encode())
    if h % 10 or not n:
        return None
    start = h // 10 % n
    period = 1 + (n - start) // (3 + h // 10 % 8)
    places = np.arange(n)
    return np.where(places < start, places, start + (places - start) % period)


def op11_sync_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs of words, the most periodic one, and digests of all runs and of the rest."""
    out = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), rewrite=repeated_tail)
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(listed, lambda line: F.concat(line, F.lit("\n"))), "")
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of 20 words that begin earlier, as counts and a digest."""
    out = suffix_trees.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op13_block_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fill-in-middle form and the text restored from it, as digests."""
    out = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    digests = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bilstm_crf": op1_bilstm_crf,
    "op2_curve_packing": op2_curve_packing,
    "op3_brown": op3_brown,
    "op4_maxscore": op4_maxscore,
    "op5_toxicity": op5_toxicity,
    "op6_url_digests": op6_url_digests,
    "op7_wavelet": op7_wavelet,
    "op8_cap_filters": op8_cap_filters,
    "op9_bpe_chunks": op9_bpe_chunks,
    "op10_odd_sketch": op10_odd_sketch,
    "op11_sync_runs": op11_sync_runs,
    "op12_suffix_trees": op12_suffix_trees,
    "op13_block_rotation": op13_block_rotation,
}

# The contract's rules and the listed hosts, in plain SQL.
_URL_SQL = f"""
WITH parts AS (
  SELECT page_id,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), cut AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    CASE WHEN regexp_matches(rest, '^[^/?#]*/') THEN regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) ELSE '' END AS path
  FROM parts
), judged AS (
  SELECT page_id, host, path, '.' || host AS dotted FROM cut
), ruled AS (
  SELECT page_id, host, path, dotted,
    CASE WHEN dotted LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
         WHEN dotted LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
         WHEN dotted LIKE '%.org' AND starts_with(path, '/') THEN 'org/'
         WHEN dotted LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
         WHEN dotted LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/' END AS rule
  FROM judged
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.org/es/', 'example.org/en/1', 'com/de/') THEN 'block'
       WHEN rule IS NOT NULL THEN 'allow'
       WHEN {" OR ".join(f"dotted LIKE '%.{h}'" for h in url_filter.LISTED_HOSTS)} THEN 'block'
       ELSE 'allow' END AS verdict
FROM ruled
"""

_TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""

_COSINE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach(vec_id, other) AS (
  SELECT a, b FROM links
  UNION
  SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT e.vec_id, coalesce(l.n, 0) AS n_links, least(e.vec_id, coalesce(r.low, e.vec_id)) AS component_id,
  e.vec_id <= coalesce(r.low, e.vec_id) AS kept
FROM embeddings e
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON l.a = e.vec_id
LEFT JOIN (SELECT vec_id, min(other) AS low FROM reach GROUP BY vec_id) r ON r.vec_id = e.vec_id
"""

_SHINGLE_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \\t\\n\\x0B\\f\\r]+') AS w
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
    ELSE list_transform(range(1, len(w) - 3), lambda i: w[i : i + 4]) END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 75 * (x.n + y.n - common)
), reach(doc_id, other) AS (
  SELECT a, b FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
  d.doc_id <= coalesce(low, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id) USING (doc_id)
"""



def _crc32_sql(text: str) -> str:
    """crc32 of ASCII ``text`` in plain SQL, four bits at a time."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(str(value))
    step = lambda x: f"xor({x} >> 4, [{', '.join(table)}][({x} & 15) + 1])"
    codes = f"list_transform(string_split({text}, ''), lambda z: CAST(ord(z) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {step(step('xor(c, b)'))}), 4294967295::BIGINT)"


_RUNS_SQL = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w,
    CASE WHEN doc_id IS NULL THEN 0 ELSE {_crc32_sql("CAST(doc_id AS VARCHAR)")} END AS h
  FROM documents
), cut AS (
  SELECT *, len(w) AS n, h % 10 = 0 AS planted, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM texts
), words AS (
  SELECT k, n, i, w[1 + CASE WHEN planted AND i >= a THEN a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) ELSE i END] AS w
  FROM (SELECT *, unnest(range(n)) AS i FROM cut)
), equal AS (
  SELECT x.k, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.k = y.k AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), stretches AS (
  SELECT k, q, min(i) AS s, count(*) + q AS l
  FROM (SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS island FROM equal)
  GROUP BY k, q, island HAVING count(*) >= 3 * q AND count(*) + q >= 6
), runs AS (
  SELECT * FROM stretches r WHERE NOT EXISTS (
    SELECT 1 FROM stretches p WHERE p.k = r.k AND p.q < r.q AND p.s <= r.s AND p.s + p.l >= r.s + r.l)
), best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY k ORDER BY CAST(l AS DOUBLE) / q DESC, s, q) = 1
), listed AS (
  SELECT k, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY k
), gone AS (
  SELECT DISTINCT k, unnest(range(s + q, s + l)) AS i FROM runs
), kept AS (
  SELECT k, string_agg(w, ' ' ORDER BY i) AS rest FROM words ANTI JOIN gone USING (k, i) GROUP BY k
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, s AS "start", l AS "length", q AS period, 1000 * l // q AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(rest, '')) AS collapsed_sha256
FROM cut LEFT JOIN listed USING (k) LEFT JOIN best USING (k) LEFT JOIN kept USING (k)
"""

_REPEATS_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i + 1 : i + 20], ' ')) AS d
  FROM (SELECT doc_id, w, unnest(range(len(w) - 19)) AS i FROM texts)
), again AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY d ORDER BY doc_id, i) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM again
), words AS (
  SELECT doc_id, w[i + 1] AS w, i FROM (SELECT doc_id, w, unnest(range(len(w))) AS i FROM texts)
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS rest FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""

_MIDDLE_SQL = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d,
    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u
  FROM documents
), cut AS (
  SELECT doc_id, t, u, len(u) AS n, CAST('0x' || d[1:8] AS BIGINT) % (len(u) + 1) AS c1,
    CAST('0x' || d[9:16] AS BIGINT) % (len(u) + 1) AS c2,
    t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
      OR CAST('0x' || d[17:24] AS BIGINT) % 100 >= 100 AS plain,
    CAST('0x' || d[25:32] AS BIGINT) % 100 < 50 AS spm
  FROM drawn
), parts AS (
  SELECT doc_id, t, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(u[1 : least(c1, c2)], '') AS p,
    array_to_string(u[least(c1, c2) + 1 : greatest(c1, c2)], '') AS m,
    array_to_string(u[greatest(c1, c2) + 1 :], '') AS s
  FROM cut
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""

ORACLE_SQL: dict[str, str] = {
    "op11_sync_runs": _RUNS_SQL,
    "op12_suffix_trees": _REPEATS_SQL,
    "op13_block_rotation": _MIDDLE_SQL,
    "op10_odd_sketch": _SHINGLE_SQL,
    "op4_maxscore": _TOP_SQL,
    "op6_url_digests": _URL_SQL,
    "op8_cap_filters": _COSINE_SQL,
}
