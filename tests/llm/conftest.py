import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """Rows (doc_id, text, lang, source) as a documents table."""
    def make(rows, schema=DOCS):
        return spark.createDataFrame([(r[0], r[1], *(r[2:] or ("en", "s")), len(r[1] or "")) for r in rows], schema)
    return make


@pytest.fixture(scope="session")
def tables(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.fixture
def clashing():
    """The same table with more columns, named like the operators' own."""
    from pyspark.sql import functions as F

    def more(df):
        names = "size bucket place key held_out label score h hits copies rank shard block dim vector before finish component sketch of".split()
        return df.select("*", *[F.lit("x").alias(n) for n in names if n not in df.columns])
    return more
