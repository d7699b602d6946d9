"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread by the next.

1. ``toxicity``: documents whose score reaches the rejection score go.
2. ``minhash_dedup``: one document of each group of near-duplicates stays.
3. ``pii``: personal data in the texts is masked, ``n_chars`` follows.
4. ``packing``: the documents are packed into token sequences, one row per piece.

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope.llm import curve_packing, odd_sketch, pii, toxicity
from shopscope.llm.common import small_batches, stored
from shopscope.llm.queries import BYTE_BPE, TOXIC_SCORE, table
from shopscope.llm.vocab import public_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the rejection score by a model learnt from ``labels``."""
    small_batches(spark)
    return toxicity.accepted(docs, toxicity.train(docs, table(spark, sf_dir, "labels")), TOXIC_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    small_batches(spark)
    return odd_sketch.deduplicated(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked by its kind."""
    small_batches(spark)
    out = pii.redacted(docs, pii.train(docs))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return out


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    small_batches(spark)
    return curve_packing.pack(docs, public_path(BYTE_BPE))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_dedup", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: Training the models and the curve order have no SQL form; tests compare stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
