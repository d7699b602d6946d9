"""The registered queries against their SQL, and the pipeline stage by stage."""

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from shopscope.checks.compare import duckdb_connection
from shopscope.llm import pii, queries, toxicity
from shopscope.llm.common import stored
from shopscope.llm.vocab import public_path

from .test_similarity import brute_links, brute_sets, reach
from .test_tokens import check_pieces

SF, SF_MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    got = queries.QUERIES[name](spark, SF)
    want = duckdb_connection(SF).sql(queries.ORACLE_SQL[name])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    listed = ", ".join(f'"{n}"' for n in names)
    assert sorted(repr(tuple(r[n] for n in names)) for r in got.collect()) == sorted(map(repr, want.project(listed).fetchall()))


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = list(entry.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)


def test_stages_take_effect(spark):
    docs = queries.table(spark, SF_MID, "documents")
    kept = docs
    seen = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stored(stage(spark, kept, SF_MID))
        assert kept.columns == docs.columns
        seen.append({r["doc_id"]: r["text"] for r in kept.collect()})
    every = {r["doc_id"]: r["text"] for r in docs.collect()}
    clean, single, masked = seen

    model = toxicity.train(docs, queries.table(spark, SF_MID, "labels"))
    scorer = toxicity.Scorer(model)
    assert set(clean) == {k for k, t in every.items() if scorer.text(t or "")[0] < queries.TOXIC_SCORE}
    assert set(clean) < set(every)

    sets = {k: brute_sets(t) for k, t in clean.items()}
    low = reach(sets, brute_links(sets))
    assert set(single) == {k for k in sets if low[k] == k}

    assert set(masked) == set(single)
    changed = {k for k in masked if masked[k] != single[k]}
    assert changed and all(any(pii.base_spans(single[k]).values()) for k in changed)
    assert not any(v for k in masked for v in pii.base_spans(masked[k]).values())

    rows = corpus_pipeline.STAGES[-1][1](spark, kept, SF_MID).collect()
    tok = Tokenizer.from_file(public_path(queries.BYTE_BPE))
    check_pieces(rows, [e.ids + [1] for e in tok.encode_batch([t or "" for t in masked.values()], add_special_tokens=False)])


def test_run_is_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    assert np.all([r["length"] > 0 for r in out.collect()])


def test_stages_on_odd_documents(spark, clashing_docs, no_docs, tmp_path):
    spark.createDataFrame([(5, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for start in (clashing_docs, no_docs):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = stored(stage(spark, docs, str(tmp_path)))
        assert columns == start.columns
