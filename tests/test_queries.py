"""Every engine query that SQL can express gives its SQL's rows on the smallest tables."""

import json
import os

import oracle
import pytest

from tidemark import plans

SF = "/root/testdata/sf0.001"
QUERIES, SQL = plans.queries(), plans.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connection(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, con, name):
    assert oracle.differences(spark, SF, QUERIES[name], SQL[name], con) == ""


def test_prompt_block(spark):
    rows = QUERIES["prompt_block"](spark, SF).collect()
    assert rows and all(json.loads(r["block"])["銘柄の基本情報"]["銘柄コード"] == str(r["p_partkey"]) for r in rows)


def test_entry_imports(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns[0] == "code"
