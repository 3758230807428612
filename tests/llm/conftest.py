import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture()
def docs(spark):
    """Odd rows: NULLs in every column, empty and long texts, repeated rows, clashing names."""

    def make(rows, columns="doc_id long, text string, id string, tid int, score double, words string"):
        return spark.createDataFrame([(*r, "x", 1, 0.5, "w")[: columns.count(",") + 1] for r in rows], columns)

    return make
