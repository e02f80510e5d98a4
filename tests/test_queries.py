"""Every registered query against its SQL on the smallest data folder."""

import pytest
from compare import compare, connect

import __spark_entry__ as registered

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registered.queries(), registered.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)
    own = {q for q in QUERIES if not q.startswith("op") and q != "pipeline"}
    assert own - set(SQL) == {
        "tree_attribution_importance",
        "row_attributions",
        "permutation_importance",
        "tree_top_drivers",
        "tree_risk_matrix",
        "evidence_packet",
    }


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    # the SQL p-value is the large-sample expansion; at a hundred rows it is off by up to 1e-5
    assert compare(spark, con, name, QUERIES[name], SQL[name], SF, tolerance=2e-5) is None


def test_entry(spark):
    assert registered.entry(spark).count() == 6
