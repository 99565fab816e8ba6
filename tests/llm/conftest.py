import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")


@pytest.fixture
def docs_of(spark):
    def make(texts, **more):
        rows = [(i, t, "en", f"src{i % 3}", len(t) if t is not None else None) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOC_SCHEMA)

    return make
