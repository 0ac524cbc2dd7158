import pytest
from plain import prose
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    *(T.StructField(n, T.LongType()) for n in ("n_words", "content", "owner", "node", "segment", "sample", "host", "held_out")),
])


def edge_texts() -> list[tuple]:
    """Ids and texts with nulls, blanks, ties, repeated rows, one shared id, long passages and a very long text."""
    shared = prose(1, 70)
    base = prose(2, 300)
    near = base.split(" ")
    near[100] = "changed"
    long_text = " ".join(prose(s, 4000) for s in (3, 4, 5)) + " " + shared + " " + "x" * 70_000
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (6, base), (7, base), (7, base), (8, " ".join(near)),
        (9, prose(6, 120) + " " + shared + " " + prose(7, 60)), (10, shared + " " + prose(8, 200)), (11, long_text),
        (None, prose(9, 90)), (None, base), (12, prose(10, 80)), (12, prose(11, 80)), (13, "the same words " * 60),
        (14, "a b c d"), (15, "A b C d"), (16, shared), (17, "été café <|endoftext|> 日本語   x 😀"), (-3, prose(8, 200) + " " + shared),
        (18, "\n".join([prose(12, 12)] * 5 + [prose(13, 60)])), (19, "12345 !!! ###"),
    ]


@pytest.fixture(scope="session")
def edge_rows():
    return edge_texts()


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    rows = [(i, t, "en" if i and i % 2 else None, None, None if t is None else len(t), *[7] * 8) for i, t in edge_rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small_docs(spark, sf_dir):
    """Ids and texts of the smallest table."""
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
