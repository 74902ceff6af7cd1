import duckdb
import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def duck():
    con = duckdb.connect()
    yield con
    con.close()


@pytest.fixture
def doc_frame(spark):
    """(doc_id, text, source) or longer tuples -> documents table."""
    def make(rows, extra=""):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", None if r[1] is None else len(r[1]), *r[3:])
                for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA + extra)
    return make
