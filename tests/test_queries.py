"""Every registered query against its DuckDB SQL, exactly."""

import pytest
from compare import TESTDATA, connect, duck_rows, spark_rows

from __spark_entry__ import entry, oracle_sql, queries
from ledgerlens.plans.catalog import QUERIES
from ledgerlens.plans.oracle import ORACLE


SMALL = ["monthly_sales", "heatmap_cells", "segment_table", "pareto_customers", "kpis_by_home"]


@pytest.fixture(scope="module")
def connections():
    opened = {sf: connect(TESTDATA / sf) for sf in ("sf0.001", "sf0.01")}
    yield opened
    for con in opened.values():
        con.close()


def test_each_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert oracle_sql().keys() <= queries().keys()


@pytest.mark.parametrize(
    ("sf", "name"), [("sf0.01", n) for n in sorted(QUERIES)] + [("sf0.001", n) for n in SMALL]
)
def test_query_equals_sql(spark, connections, sf, name):
    con = connections[sf]
    types, rows = spark_rows(queries()[name](spark, str(TESTDATA / sf)))
    wanted_types, wanted = duck_rows(con, oracle_sql()[name])
    assert types == wanted_types
    assert rows == wanted


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["category", "customers", "revenue"]
    assert df.count() == 9
