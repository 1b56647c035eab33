import pytest
from samples import DOCUMENTS, ODD, prose


@pytest.fixture(scope="session")
def make(spark):
    """Documents from rows ``(doc_id, text)`` or whole ones."""

    def build(rows):
        whole = [row if len(row) == 5 else (*row, "en", "s", len(row[1] or "")) for row in rows]
        return spark.createDataFrame(whole, DOCUMENTS)

    return build


@pytest.fixture(scope="session")
def odd(make):
    return make(ODD)


@pytest.fixture(scope="session")
def empty(make):
    return make([])


@pytest.fixture(scope="session")
def clashing(make):
    """Documents with columns named like those the operators make."""
    names = "n_words bits h1 h2 text_ words spans row places hash id start end value n ids uid class cell keys lines".split()
    df = make([(1, prose(1, 60)), (2, prose(2, 60)), (3, prose(1, 60))])
    return df.selectExpr("*", *[f"cast(7 as bigint) as {name}" for name in names])
