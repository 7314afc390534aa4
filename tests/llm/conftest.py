import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text, source) rows, with columns whose names clash with ours."""

    def make(rows):
        schema = (
            "doc_id bigint, text string, source string, size string, n_lines string, pos int, "
            "line string, fp string, h int, kept string, ids string, rounds int, `a.b` int"
        )
        return spark.createDataFrame([(*r, "x", "y", 1, "l", "f", 2, "k", "i", 3, 4) for r in rows], schema)

    return make


@pytest.fixture
def same(spark):
    """Compare the rows of a DataFrame with those of SQL over tables made of DataFrames."""

    def check(df, sql, **tables):
        con = duckdb.connect()
        for name, table in tables.items():
            con.register(name, table.toArrow())
        columns = sorted(df.columns)
        ours = [tuple(r) for r in df.select(*columns).collect()]
        cursor = con.execute(sql)
        place = [[d[0] for d in cursor.description].index(c) for c in columns]
        theirs = [tuple(r[i] for i in place) for r in cursor.fetchall()]
        assert sorted(map(repr, ours)) == sorted(map(repr, theirs))

    return check
