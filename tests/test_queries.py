"""Every registered query against its SQL, on the smallest tables and on a copy where single keys are hot."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from millrace.session import TABLES
from tools.compare import compare
from workload import preparation, quality, relational, star

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")

# A third or more of the rows of a table share one key or value.
HOT = {
    "lineitem": """
        SELECT * REPLACE (CASE WHEN i % 3 = 0 THEN 42 ELSE l_orderkey END AS l_orderkey, CASE WHEN i % 6 < 2 THEN 7 ELSE l_partkey END AS l_partkey,
          CASE WHEN i % 5 < 2 THEN 3 ELSE l_suppkey END AS l_suppkey, CASE WHEN i % 7 < 3 THEN 10.0 ELSE l_quantity END AS l_quantity,
          CASE WHEN i % 8 < 3 THEN 50000.0 ELSE l_extendedprice END AS l_extendedprice)""",
    "orders": """
        SELECT * REPLACE (CASE WHEN i % 3 = 0 THEN 11 ELSE o_custkey END AS o_custkey,
          CASE WHEN i % 5 < 2 THEN TIMESTAMP '1997-07-07' ELSE o_orderdate END AS o_orderdate)""",
    "events": "SELECT * REPLACE (CASE WHEN i % 3 = 0 THEN 5 ELSE user_id END AS user_id)",
    "part": """
        SELECT * REPLACE (CASE WHEN i % 3 = 0 THEN 'Brand#7' ELSE p_brand END AS p_brand, CASE WHEN i % 3 = 1 THEN 1111.0 ELSE p_retailprice END AS p_retailprice)""",
}
HOT_QUERIES = [
    "topk_entities_by_fact_rows", "topk_in_filtered_category", "top_category_by_revenue", "listagg_two_level", "in_stock",
    "customer_balance_asof", "rewards_report", "deduplicate", "symmetric_difference", "global_ntile", "percentiles_and_mode",
    "check_mutually_exclusive_ranges", "check_ranges_few_partitions", "check_sequential_values", "check_sequential_days",
    "check_unique_combination", "check_not_constant", "feat_k_bins_quantile", "feat_label_encode", "feat_random_impute", "feature_mart",
    "feat_random_impute_draws", "feat_quantile_bins_thousand", "feat_quantile_bins_wide_integers", "feat_one_hot_positions", "multiset_difference",
    "concat_list_view", "recased_list_view", "concat_parts", "check_evaluation", "train_forest_metrics", "check_equality_duplicates", "date_spine_months",
]


def connect(folder):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return duck


@pytest.fixture(scope="module")
def hot(tmp_path_factory):
    folder = tmp_path_factory.mktemp("hot")
    duck = duckdb.connect()
    for table in TABLES:
        rows = f"(SELECT *, row_number() OVER () - 1 AS i FROM '{SMALL}/{table}.parquet')"
        chosen = HOT.get(table, "SELECT *").replace("SELECT *", "SELECT * EXCLUDE (i)")
        duck.execute(f"COPY ({chosen} FROM {rows}) TO '{folder}/{table}.parquet' (FORMAT parquet, ROW_GROUP_SIZE 2048)")
    return str(folder)


def check(spark, folder, name):
    status, text = compare(spark, connect(folder), folder, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert status in ("ok", "rows"), text


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, name):
    check(spark, SMALL, name)


@pytest.mark.parametrize("name", HOT_QUERIES)
def test_query_with_hot_keys(spark, hot, name):
    check(spark, hot, name)


def test_every_query_has_its_sql():
    # The text queries are compared with brute force in their own folder where SQL can't express them.
    own = {**star.QUERIES, **relational.QUERIES, **quality.QUERIES, **preparation.QUERIES}
    assert set(own) <= set(entry.oracle_sql())
