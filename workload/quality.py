"""The data-quality checks on the whole tables: each query returns the failing rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.operators import checks
from millrace.plans.run import run_steps
from millrace.plans.staging import build_and_check
from millrace.session import load_table as load
from millrace.session import new_folder
from millrace.sinks.versions import Versions

QUERIES: dict[str, tuple] = {}


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = (run, sql)
        return run

    return register


def _lines(spark, folder):
    return load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag",
        (F.col("l_discount") + 0.0).alias("l_discount"), (F.col("l_tax") + 0.0).alias("l_tax"),
    )


@query("""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE NOT l_quantity >= 3 OR NOT l_quantity <= 48""")
def check_accepted_range(spark, folder):
    rows = _lines(spark, folder).select("l_orderkey", "l_linenumber", "l_quantity")
    return checks.accepted_range(rows, "l_quantity", 3, 48)


@query("""
SELECT n, CAST(0 AS BIGINT) AS n_values FROM (
  SELECT s_nationkey AS n, count(CASE WHEN s_acctbal > 9000 THEN 1 END) AS filled FROM supplier GROUP BY s_nationkey)
WHERE filled = 0""")
def check_at_least_one(spark, folder):
    rich = load(spark, folder, "supplier").select(
        F.col("s_nationkey").alias("n"), F.when(F.col("s_acctbal") > 9000, F.col("s_acctbal")).alias("rich")
    )
    return checks.at_least_one(rich, "rich", ["n"])


@query("""
WITH a AS (SELECT l_suppkey, count(*) AS num_rows FROM lineitem GROUP BY 1),
b AS (SELECT l_partkey % (SELECT count(*) FROM supplier) AS l_suppkey, count(*) AS num_rows FROM lineitem GROUP BY 1)
(SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def check_cardinality_equality(spark, folder):
    lines = load(spark, folder, "lineitem")
    n = load(spark, folder, "supplier").agg(F.count(F.lit(1)).alias("n"))
    wrapped = lines.crossJoin(F.broadcast(n)).select((F.col("l_partkey") % F.col("n")).alias("k"))
    return checks.cardinality_equality(lines, "l_suppkey", wrapped, "k")


_BOTH = """
WITH a AS (SELECT doc_id, count(*) AS x FROM documents GROUP BY 1),
b AS (SELECT doc_id, count(*) AS y FROM labels GROUP BY 1),
c AS (SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, coalesce(x, 0) AS x, coalesce(y, 0) AS y FROM a FULL JOIN b ON a.doc_id = b.doc_id)
"""


def _labelled(spark, folder):
    """Not every document has a label, so groups are missing on one side."""
    return load(spark, folder, "documents").select("doc_id"), load(spark, folder, "labels").select("doc_id")


@query(_BOTH + "SELECT doc_id, x AS count_a, y AS count_b, abs(x - y) AS diff_count FROM c WHERE x <> y")
def check_equal_rowcount(spark, folder):
    return checks.equal_rowcount(*_labelled(spark, folder), ["doc_id"])


@query(_BOTH + """
SELECT doc_id, x AS count_our_model, y AS count_comparison_model, CASE WHEN x > y THEN x - y WHEN x = y THEN 1 ELSE 0 END AS row_count_delta
FROM c WHERE x >= y""")
def check_fewer_rows_than(spark, folder):
    return checks.fewer_rows_than(*_labelled(spark, folder), ["doc_id"])


@query("""
SELECT (SELECT count(*) FROM lineitem) AS count_our_model, (SELECT count(*) FROM orders) AS count_comparison_model,
       (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM orders) AS row_count_delta""")
def check_fewer_rows_than_total(spark, folder):
    return checks.fewer_rows_than(load(spark, folder, "lineitem"), load(spark, folder, "orders"))


@query("""
WITH a AS (SELECT c_custkey AS k, round(c_acctbal + 0.003, 1) AS balance FROM customer),
b AS (SELECT c_custkey AS k, round(c_acctbal + CASE WHEN c_mktsegment = 'BUILDING' THEN 0.333 ELSE 0.003 END, 1) AS balance FROM customer)
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def check_equality(spark, folder):
    customer = load(spark, folder, "customer")
    a = customer.select(F.col("c_custkey").alias("k"), (F.col("c_acctbal") + 0.003).alias("balance"), "c_name")
    moved = F.when(F.col("c_mktsegment") == "BUILDING", 0.333).otherwise(0.003)
    b = customer.select(F.col("c_custkey").alias("k"), (F.col("c_acctbal") + moved).alias("balance"), "c_name")
    return checks.equality(a, b, exclude_columns=["C_NAME"], precision=1)


@query("""
WITH a AS (SELECT l_suppkey, round(l_quantity, 0) AS quantity FROM lineitem WHERE l_returnflag <> 'R'),
b AS (SELECT l_suppkey, round(l_quantity, 0) AS quantity FROM lineitem WHERE l_linestatus = 'F')
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def check_equality_duplicates(spark, folder):
    """Lines of suppliers, compared with repeated rows as often as they are there."""
    lines = load(spark, folder, "lineitem")
    a, b = (lines.where(where).select("l_suppkey", F.col("l_quantity").alias("quantity")) for where in ("l_returnflag <> 'R'", "l_linestatus = 'F'"))
    return checks.equality(a, b, precision=0, keep_duplicates=True)


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem WHERE NOT (l_extendedprice / l_quantity < 5000)""")
def check_expression_is_true(spark, folder):
    rows = _lines(spark, folder).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return checks.expression_is_true(rows, "l_extendedprice / l_quantity < 5000")


def _ranges_sql(partition: str, days: int, meets: str, words: str, longer: str, length_words: str) -> str:
    return f"""
WITH r AS (SELECT {partition} AS partition_by_col, o_orderdate AS lower_bound, o_orderdate + INTERVAL {days} DAY AS upper_bound, o_orderkey FROM orders),
w AS (
  SELECT *, lead(lower_bound) OVER (PARTITION BY partition_by_col ORDER BY lower_bound, upper_bound, o_orderkey) AS next_lower_bound,
         row_number() OVER (PARTITION BY partition_by_col ORDER BY lower_bound DESC, upper_bound DESC, o_orderkey DESC) = 1 AS is_last_record FROM r),
c AS (
  SELECT *, coalesce(lower_bound {longer} upper_bound, FALSE) AS lower_bound_{length_words}_upper_bound,
         coalesce(upper_bound {meets} next_lower_bound, is_last_record, FALSE) AS upper_bound_{words}_next_lower_bound FROM w)
SELECT * EXCLUDE (o_orderkey), count(*) AS n_rows FROM c
WHERE NOT (lower_bound_{length_words}_upper_bound AND upper_bound_{words}_next_lower_bound) GROUP BY ALL"""


def _order_ranges(spark, folder, days):
    orders = load(spark, folder, "orders")
    return orders.select(
        "o_custkey", "o_orderstatus", "o_orderdate", F.timestamp_add("DAY", F.lit(days), "o_orderdate").alias("until")
    )


@query(_ranges_sql("o_custkey", 60, "<=", "less_than_or_equal_to", "<", "less_than"))
def check_mutually_exclusive_ranges(spark, folder):
    return checks.mutually_exclusive_ranges(_order_ranges(spark, folder, 60), "o_orderdate", "until", "o_custkey")


@query(_ranges_sql("o_orderstatus", 0, "<", "less_than", "<=", "less_than_or_equal_to"))
def check_ranges_few_partitions(spark, folder):
    """Three partitions hold all rows, so each is spread over many tasks."""
    return checks.mutually_exclusive_ranges(
        _order_ranges(spark, folder, 0), "o_orderdate", "until", "o_orderstatus", "required", True
    )


@query("""SELECT DISTINCT p_brand AS value_field FROM part WHERE p_brand IN ('Brand#3', 'Brand#99', 'Brand#11')""")
def check_not_accepted_values(spark, folder):
    return checks.not_accepted_values(load(spark, folder, "part"), "p_brand", ["Brand#3", "Brand#99", "Brand#11"])


@query("""
SELECT l_orderkey, count(DISTINCT l_returnflag) AS n_distinct FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag) = 1""")
def check_not_constant(spark, folder):
    return checks.not_constant(load(spark, folder, "lineitem"), "l_returnflag", ["l_orderkey"])


@query("""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN '  ' ELSE c_mktsegment END AS segment FROM customer WHERE c_acctbal < 0""")
def check_not_empty_string(spark, folder):
    segment = F.when(F.col("c_acctbal") < 0, "  ").otherwise(F.col("c_mktsegment"))
    rows = load(spark, folder, "customer").select("c_custkey", segment.alias("segment"))
    return checks.not_empty_string(rows, "segment")


@query("""
SELECT l_suppkey, round(avg(CASE WHEN l_tax > 0.01 THEN 1.0 ELSE 0.0 END), 6) AS not_null_proportion FROM lineitem GROUP BY l_suppkey
HAVING avg(CASE WHEN l_tax > 0.01 THEN 1.0 ELSE 0.0 END) < 0.83 OR avg(CASE WHEN l_tax > 0.01 THEN 1.0 ELSE 0.0 END) > 0.86""")
def check_not_null_proportion(spark, folder):
    rows = _lines(spark, folder).withColumn("l_tax", F.when(F.col("l_tax") > 0.01, F.col("l_tax")))
    failing = checks.not_null_proportion(rows, "l_tax", 0.83, 0.86, ["l_suppkey"])
    return failing.withColumn("not_null_proportion", F.round("not_null_proportion", 6))


@query("""
SELECT user_id, max(ts) AS most_recent, TIMESTAMP '2024-01-29 18:00:00' AS threshold FROM events GROUP BY user_id
HAVING max(ts) < TIMESTAMP '2024-01-29 18:00:00'""")
def check_recency(spark, folder):
    return checks.recency(
        load(spark, folder, "events"), "ts", "hour", 6, "2024-01-30 00:00:00", group_by_columns=["user_id"]
    )


@query("""
SELECT doc_id AS id FROM documents WHERE n_chars > 500 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def check_relationships_where(spark, folder):
    return checks.relationships_where(
        load(spark, folder, "documents"), "doc_id", load(spark, folder, "labels"), "doc_id", "n_chars > 500", "quality = 1"
    )


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def check_unique_combination(spark, folder):
    return checks.unique_combination_of_columns(load(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT user_id, event_id, previous_event_id, count(*) AS n_rows FROM (
  SELECT user_id, event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS previous_event_id FROM events)
WHERE NOT (event_id = previous_event_id + 1) GROUP BY ALL""")
def check_sequential_values(spark, folder):
    return checks.sequential_values(load(spark, folder, "events"), "event_id", group_by_columns=["user_id"])


@query("""
SELECT o_orderdate, previous_o_orderdate, count(*) AS n_rows FROM (
  SELECT o_orderdate, lag(o_orderdate) OVER (ORDER BY o_orderdate) AS previous_o_orderdate FROM orders)
WHERE NOT (o_orderdate = previous_o_orderdate + INTERVAL 1 DAY) GROUP BY ALL""")
def check_sequential_days(spark, folder):
    """The ungrouped form, with many equal dates."""
    return checks.sequential_values(load(spark, folder, "orders"), "o_orderdate", 1, "day")


@query("""
SELECT 'key_not_null' AS name, 'pass' AS status, CAST(0 AS BIGINT) AS n
UNION ALL SELECT 'key_unique', 'pass', 0
UNION ALL SELECT 'known_status', CASE WHEN count(*) > 0 THEN 'warn' ELSE 'pass' END, count(*)
  FROM (SELECT DISTINCT o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'P'))
UNION ALL SELECT 'cheap', CASE WHEN count(*) > 0 THEN 'error' ELSE 'pass' END, count(*) FROM orders WHERE o_custkey > 10 AND o_totalprice > 400000
UNION ALL SELECT 'one_each', CASE WHEN n > 0 THEN 'error' ELSE 'pass' END, n FROM (
  SELECT abs((SELECT count(*) FROM orders) - (SELECT count(*) FROM customer)) AS n)""")
def check_evaluation(spark, folder):
    """Status and number of failures of several checks on one table."""
    orders = load(spark, folder, "orders")
    results = checks.check_together(orders, {
        "key_not_null": checks.not_null_rule("o_orderkey"),
        "key_unique": checks.unique_rule(["o_orderkey"]),
        "known_status": checks.values_rule("o_orderstatus", ["F", "P"], error_if="> 10"),
        "cheap": checks.range_rule("o_totalprice", max_value=400000, where="o_custkey > 10"),
    })
    results["one_each"] = checks.run_check(checks.equal_rowcount, orders, load(spark, folder, "customer"))
    return spark.createDataFrame([(k, *v) for k, v in results.items()], "name string, status string, n long")


@query("""
SELECT l_orderkey, l_linenumber FROM lineitem WHERE abs(l_discount - l_tax) > 0.0001""")
def check_assert_equal(spark, folder):
    failing = checks.assert_equal(_lines(spark, folder), "l_discount", "l_tax", tolerance=0.0001)
    return failing.select("l_orderkey", "l_linenumber")


@query("""
SELECT 'close' AS rule, l_orderkey, l_linenumber FROM lineitem WHERE round(l_extendedprice / 1000, 1) <> round(l_extendedprice / 1000 * (1 + l_tax), 1)
UNION ALL SELECT 'equal_string', l_orderkey, l_linenumber FROM lineitem WHERE CAST(l_linenumber AS VARCHAR) <> l_linestatus || '1'
UNION ALL SELECT 'not_null', l_orderkey, l_linenumber FROM lineitem WHERE l_discount <= 0""")
def check_assertions(spark, folder):
    """Lines whose price changes in its first decimal by the tax, whose number isn't a text, and whose discount has no logarithm."""
    rows = _lines(spark, folder)
    price = F.col("l_extendedprice") / 1000
    found = {
        "close": checks.assert_close(rows, price, price * (1 + F.col("l_tax")), 1),
        "equal_string": checks.assert_equal_string(rows, "l_linenumber", F.concat("l_linestatus", F.lit("1"))),
        "not_null": checks.assert_not_null(rows, F.when(F.col("l_discount") > 0, F.log("l_discount"))),
    }
    parts = [failing.select(F.lit(rule).alias("rule"), "l_orderkey", "l_linenumber") for rule, failing in found.items()]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("""SELECT o_custkey, count(*) AS n, max(o_orderdate) AS latest FROM orders GROUP BY o_custkey""")
def build_then_test(spark, folder):
    """A model whose table is written only after its checks have passed."""
    model = load(spark, folder, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.max("o_orderdate").alias("latest")
    )
    name, path = f"orders_per_customer_{uuid.uuid4().hex[:12]}", new_folder(spark)
    build_and_check(model, name, [
        ("as many as customers", lambda df: checks.fewer_rows_than(df, load(spark, folder, "orders"))),
    ], rules={
        "customer present": checks.not_null_rule("o_custkey"),
        "some orders": checks.range_rule("n", min_value=1),
        "customer unique": checks.unique_rule(["o_custkey"]),
    }, path=path)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)


@query("""
SELECT 'staged' AS name, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total, 1 AS times_made FROM lineitem
UNION ALL SELECT 'mart', count(*), CAST(sum(total) AS DECIMAL(28,2)), 2 FROM (SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM lineitem GROUP BY ALL)
UNION ALL SELECT 'results', count(*), CAST(sum(total) AS DECIMAL(28,2)), 1 FROM (SELECT CAST(max(total) AS DECIMAL(28,2)) AS total FROM (
  SELECT sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total FROM lineitem GROUP BY l_returnflag))""")
def restarted_run(spark, folder):
    """Staging, mart and results in order; the mart fails at first, and the run is started again."""
    place, made = new_folder(spark), {"staged": 0, "mart": 0, "results": 0}

    def staged(_):
        made["staged"] += 1
        return load(spark, folder, "lineitem").select("l_returnflag", F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))

    def mart(before):
        made["mart"] += 1
        totals = before["staged"].groupBy("l_returnflag").agg(F.sum("price").cast("decimal(28,2)").alias("price"))
        # The first time the step breaks off after a part of its rows is written.
        stop = F.when(F.col("l_returnflag") == "R", F.raise_error(F.lit("stopped")).cast("decimal(28,2)")).otherwise(F.col("price"))
        return totals.withColumn("price", stop) if made["mart"] == 1 else totals

    def results(before):
        made["results"] += 1
        return before["mart"].agg(F.max("price").alias("price"))

    steps = [("staged", staged), ("mart", mart), ("results", results)]
    try:
        run_steps(spark, place, "2024-01-01", steps)
    except Exception as stopped:  # noqa: BLE001 - a failed write comes as one of several errors
        if "stopped" not in str(stopped):
            raise
    if Versions(spark, place).current():
        raise AssertionError("a run that stopped is not seen by readers")
    run_steps(spark, place, "2024-01-01", steps)
    run_steps(spark, place, "2024-01-01", steps)
    seen = Versions(spark, place)
    parts = [
        seen.read(name).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), F.sum("price").cast("decimal(28,2)").alias("total"), F.lit(made[name]).alias("times_made"))
        for name in made
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])
