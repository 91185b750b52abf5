import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from (doc_id, text[, lang, source]) rows, over a few partitions."""

    def make(rows, partitions=3):
        full = [(r[0], r[1], *(r[2:] or ("en", "s")), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls in every column, empty and very long texts, repeated rows, ties."""
    long = " ".join(f"w{i % 997}x{i % 13}" for i in range(60_000))
    return make_docs(
        [
            (1, None, None, None), (2, "", "en", None), (3, " \n\t ", None, "s"), (None, "a lone row here", "en", "s"),
            (4, "the same text twice over", "en", "s"), (4, "the same text twice over", "en", "s"),
            (5, "the same text twice over", "de", "t"), (6, long, "en", "s"), (7, long + " end", "en", "s"),
            (8, "one", "en", "s"), (9, "Grüße aus Köln — ça va? 你好 世界 \U0001f600", "de", "s"),
        ]
    )


@pytest.fixture
def as_table(tmp_path):
    """Writes frames as tables of a new folder, which stands for sf_dir."""

    def write(**frames):
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
