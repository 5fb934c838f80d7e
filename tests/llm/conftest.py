import pytest

LONG = "wordy " * 30000

#: Ids, texts and columns that meet every operator: nulls, empty and long texts, repeats, clashing names.
EDGES = [
    (1, "One plain text with some words in it.", "en"), (1, "One plain text with some words in it.", "en"), (2, "", "en"),
    (3, None, None), (None, "a text without id", "en"), (None, None, None), (4, LONG, "de"), (5, "   \n\t ", "en"),
    (6, "x" * 50000, "fr"), (7, "é😀 ñ 　 \u0000 end", "es"), (-8, "One plain text with some words in it.", None),
]


@pytest.fixture(scope="session")
def edges(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(EDGES, "doc_id long, text string, lang string")
    for name in ("score", "label", "node", "key", "unit", "virtual_slot", "bytes", "n", "digest", "size", "rank"):
        df = df.withColumn(name, F.lit("clash"))
    return df.withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))


@pytest.fixture(scope="session")
def empty(edges):
    return edges.limit(0)


def by_id(df, *columns):
    return sorted((tuple(r) for r in df.select("doc_id", *columns).collect()), key=str)
