import duckdb
import pytest

from tests.oracle_compare import compare
from workpulse.llm.oracle import ORACLE
from workpulse.llm.queries import QUERIES


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name, sf):
    con = duckdb.connect()
    folder = f"/root/testdata/{sf}"
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    res = compare(spark, QUERIES[name], ORACLE[name], folder, con)
    assert res["columns_match"] and res["types_match"] and res["values_match"], res
    assert res["spark_rows"] == res["oracle_rows"] > 0
