"""Every registered query with SQL, against DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as spark_entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = []
    for row in rows:
        values = [row[i] for i in order]
        out.append(tuple("null" if v is None or v != v else repr(v + 0.0 if isinstance(v, float) else v) for v in values))
    return sorted(out)


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_query_matches_sql(spark, sf_dir, con, name):
    df = spark_entry.queries()[name](spark, sf_dir)
    want = con.sql(spark_entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(want.columns, want.fetchall())


def test_names_of_sql_are_queries():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry_returns_ranked_rows(spark):
    board = spark_entry.entry(spark).collect()
    assert [r["rank"] for r in board] == list(range(1, len(board) + 1))
    assert all(a["accuracy"] >= b["accuracy"] for a, b in zip(board, board[1:]))
