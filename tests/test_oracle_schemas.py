"""Every registered query and its DuckDB statement agree on column names and types."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
DUCK = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(n for n in E.oracle_sql() if not n.startswith("stream")))
def test_schema_matches(spark, con, name):
    spark_types = {f.name: f.dataType.simpleString() for f in E.queries()[name](spark, SF).schema.fields}
    rel = con.sql(f"SELECT * FROM ({E.oracle_sql()[name]}) LIMIT 0")
    duck_types = {c: DUCK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert spark_types == duck_types
