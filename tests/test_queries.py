"""Every query of the routing part against its SQL in DuckDB."""

import duckdb
import pytest

from pathlight.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_matches_sql(spark, duck, tmp_path, name):
    df = registry.QUERIES[name](spark, SF)
    df.write.parquet(str(tmp_path / "out"))
    columns = ", ".join(f'"{c}"' for c in sorted(df.columns))
    ours, theirs = f"SELECT {columns} FROM '{tmp_path}/out/*.parquet'", f"SELECT {columns} FROM ({registry.SQL[name]})"
    assert duck.sql(f"({ours}) EXCEPT ALL ({theirs})").fetchall() == []
    assert duck.sql(f"({theirs}) EXCEPT ALL ({ours})").fetchall() == []


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.SQL)


@pytest.mark.parametrize("name", ["alerts", "origin_validation"])
def test_parts_beyond_two_octets(spark, tmp_path, name):
    """With more than 65,536 parts the prefixes' second number passes 255; what covers them still does."""
    c = duckdb.connect()
    key = {"part": "p_partkey", "lineitem": "l_partkey"}
    for t in ("part", "lineitem", "supplier"):
        moved = f" REPLACE ({key[t]} + 65436 AS {key[t]})" if t in key else ""
        c.sql(f"COPY (SELECT *{moved} FROM '{SF}/{t}.parquet') TO '{tmp_path}/{t}.parquet'")
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    df = registry.QUERIES[name](spark, str(tmp_path))
    want = c.sql(f"SELECT {', '.join(df.columns)} FROM ({registry.SQL[name]})").fetchall()
    assert {r[0].split(".")[1] for r in want} == {"255", "256"}
    assert sorted(map(tuple, df.collect())) == sorted(want)
