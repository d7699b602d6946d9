import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

WORDS = ("the and of to river stone light idle wheat kind open little north paper glass seven ever".split())


def prose(seed: int, words: int) -> str:
    """Deterministic prose of so many words."""
    out, x = [], seed * 7919 + 13
    for _ in range(words):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + ("" if x % 5 else str((x >> 4) % 97)))
    return " ".join(out)


#: Null and empty texts, blanks only, ties, repeated rows, null ids, a very long text, personal data.
ODD_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "four words only here"),
    (5, prose(1, 60)),
    (6, prose(1, 60)),
    (7, prose(1, 60) + " one more"),
    (8, prose(2, 30_000)),
    (9, "mail a.b@mail.example.com or +1 (319) 555-5132, card 4111 1111 1111 1111, host 10.2.3.44."),
    (10, "Ünïcode ŞTEXT <|endoftext|> 😀 \x1c tab\tend\u00a0x  two  blanks\r\n" + prose(3, 12)),
    (10, "Ünïcode ŞTEXT <|endoftext|> 😀 \x1c tab\tend\u00a0x  two  blanks\r\n" + prose(3, 12)),
    (None, prose(4, 20)),
    (None, None),
    (11, "x" * 20_000),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, t, None if i == 5 else "en", None, None if t is None else len(t)) for i, t in ODD_TEXTS]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing_docs(odd_docs):
    """The odd documents with extra columns named like inner columns of the operators."""
    from pyspark.sql import functions as F

    names = ["id", "n", "ids", "range", "curve", "tie", "rep", "digest", "score", "component_id", "kept", "word", "start", "a", "b"]
    return odd_docs.select("*", *[F.lit("clash").alias(n) for n in names])
