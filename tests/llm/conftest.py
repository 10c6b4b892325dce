import pytest

from ordermart.llm.common import ship


@pytest.fixture(scope="session")
def llm(spark):
    ship(spark)
    return spark


@pytest.fixture
def docs(llm):
    """Builds a documents table from (doc_id, text) or (doc_id, text, lang) rows."""

    def make(rows, extra=""):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        df = llm.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
        for name in extra.split():
            df = df.selectExpr("*", f"'x' as {name}")
        return df

    return make
