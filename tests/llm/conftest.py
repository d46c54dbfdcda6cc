import pytest

from tests.conftest import spark  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):  # noqa: F811
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def make(spark):  # noqa: F811
    """Documents of the given rows, with columns whose names clash with those of operators."""

    def frame(rows, more="lang string, source string, n_chars long, n_words string, chunk string, id string"):
        names = [c.split()[0] for c in more.split(", ")]
        full = [(*r, *[None] * len(names)) for r in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, {more}")

    return frame
