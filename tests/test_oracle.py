"""Every registered query against its DuckDB oracle on the smallest tables
(the driver does the same at sf0.01)."""
import duckdb
import pytest

from conftest import SF_SMALL
from __spark_entry__ import oracle_sql, queries
from kestrel.plans.oracle import ORACLE
from kestrel.plans.queries import QUERIES
from kestrel.sources.tables import TABLES
from tools.compare import digest


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_every_query_has_oracle_or_is_known_non_sql():
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())
    non_sql = {k for k in QUERIES if k not in ORACLE}
    assert non_sql <= {"ml_colour_scores", "ml_label_scores", "ml_next_day",
                       "ml_next_day_scores", "ml_grid"}


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["day", "user_id", "value_range"]
    assert df.count() >= 0
