"""Reshaping, scalar functions, sources and sinks on the whole tables, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from millrace.functions import arithmetic, columns, dates, geo, keys, urls
from millrace.operators import aggregates, ordering, reshape, textsearch
from millrace.plans.staging import stage_sales
from millrace.session import load_table as load
from millrace.session import new_folder
from millrace.sinks import tables as sinks
from millrace.sources import catalog, files, series, synthetic
from workload import star

QUERIES: dict[str, tuple] = {}
#: Order keys of a page of sales; an order takes about 120 bytes of JSON.
PAGE_KEYS = 50_000


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = (run, sql)
        return run

    return register


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


# Columns, predicates and values


@query("""SELECT n_nationkey AS nation_n_nationkey_raw, n_name AS nation_n_name_raw FROM nation""")
def star_prefix(spark, folder):
    nation = load(spark, folder, "nation")
    return nation.select(*columns.star(nation, ["N_REGIONKEY"], "nation_", "_raw"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_name END AS c_name, c_nationkey, c_acctbal,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def nullcheck_table(spark, folder):
    customer = load(spark, folder, "customer")
    blanked = customer.withColumns({
        "c_name": F.when(F.col("c_custkey") % 10 == 0, "").otherwise(F.col("c_name")),
        "c_mktsegment": F.when(F.col("c_mktsegment") == "MACHINERY", "").otherwise(F.col("c_mktsegment")),
    })
    return columns.nullcheck_table(blanked)


@query("""SELECT max(o_totalprice) AS top_price, CAST('none' AS VARCHAR) AS without_rows FROM orders""")
def single_value(spark, folder):
    orders = load(spark, folder, "orders")
    top = reshape.get_single_value(orders.agg(F.max("o_totalprice")))
    nothing = reshape.get_single_value(orders.where("o_totalprice < 0").select("o_orderpriority"), default="none")
    return spark.createDataFrame([(top, nothing)], "top_price double, without_rows string")


@query("""
SELECT p_brand AS value, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS place
FROM part WHERE p_size > 10 GROUP BY p_brand""")
def column_values(spark, folder):
    values = reshape.column_values(load(spark, folder, "part"), "p_brand", where="p_size > 10")
    placed = ordering.row_numbers(values.withColumn("fewer", -F.col("n")), ["fewer", "value"], "place")
    return placed.select("value", "place")


@query("""SELECT p_brand, count(*) AS n, CAST(max(p_size) AS INTEGER) AS largest FROM part GROUP BY p_brand""")
def results_dict(spark, folder):
    part = load(spark, folder, "part")
    found = reshape.get_query_results_as_dict(
        part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.max("p_size").alias("largest")), max_rows=100_000
    )
    return spark.createDataFrame(list(zip(*found.values())), "p_brand string, n long, largest int")


@query("""
SELECT l_shipdate, l_quantity * 2 AS doubled_quantity, CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE 'kept' END AS kept
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1997-02-01'
  AND l_returnflag IN ('R', 'N') AND l_linestatus ILIKE 'f' AND l_discount BETWEEN 0.02 AND 0.08""")
def filtered_projection(spark, folder):
    lines = load(spark, folder, "lineitem")
    month = (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz")) & (
        F.col("l_shipdate") < F.lit("1997-02-01").cast("timestamp_ntz")
    )
    return lines.where(
        month & F.col("l_returnflag").isin("R", "N") & F.col("l_linestatus").ilike("f")
        & F.col("l_discount").between(0.02, 0.08)
    ).select(
        "l_shipdate", (F.col("l_quantity") * 2).alias("doubled_quantity"),
        F.when(F.col("l_returnflag") == "R", "returned").otherwise("kept").alias("kept"),
    )


# Aggregates and shapes


@query("""
SELECT l_linestatus, CAST(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS n_A,
       CAST(sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS n_N,
       CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS n_R,
       max(CASE WHEN l_returnflag <> 'A' THEN l_quantity ELSE 0 END) AS top_not_A
FROM lineitem GROUP BY l_linestatus""")
def pivot_counts(spark, folder):
    lines = load(spark, folder, "lineitem")
    flags = reshape.get_column_values(lines, "l_returnflag", order_by=["value"], at_most=1000)
    return lines.groupBy("l_linestatus").agg(
        *aggregates.pivot("l_returnflag", flags, prefix="n_"),
        *aggregates.pivot("l_returnflag", ["A"], agg="max", cmp="<>", prefix="top_not_", then_value=F.col("l_quantity"), else_value=0.0),
    )


@query("""
WITH texts AS (SELECT DISTINCT o_orderstatus, CAST(o_custkey AS VARCHAR) AS customer FROM orders),
     placed AS (SELECT *, (row_number() OVER (ORDER BY o_orderstatus, customer) - 1) // 500 AS part FROM texts)
SELECT o_orderstatus, part, string_agg(customer, ', ' ORDER BY customer) AS customers FROM placed GROUP BY o_orderstatus, part""")
def concat_parts(spark, folder):
    """The texts of three groups that hold all orders, in parts of 500 values."""
    orders = load(spark, folder, "orders").select("o_orderstatus", F.col("o_custkey").cast("string").alias("customer"))
    return aggregates.group_concat_parts(orders, ["o_orderstatus"], "customer", "customers", part_rows=500)


@query("""
SELECT l_returnflag, l_partkey, count(*) AS n, max(l_quantity) AS most FROM lineitem GROUP BY l_returnflag, l_partkey""")
def pivot_counts_long(spark, folder):
    """The cells of a pivot over all parts."""
    lines = load(spark, folder, "lineitem")
    return aggregates.pivot_long(lines, ["l_returnflag"], "l_partkey", F.count(F.lit(1)).alias("n"), F.max("l_quantity").alias("most"))


@query("""
SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total, count(*) AS n
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def group_by_ordinals(spark, folder):
    lines = load(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice")
    return aggregates.group_by_first(lines, 2).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("total"),
        F.count(F.lit(1)).alias("n"),
    )


@query("""
SELECT l_returnflag, count(*) AS n, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS spread,
       min(l_extendedprice) AS lowest, max(l_extendedprice) AS highest, count(DISTINCT l_suppkey) AS suppliers,
       round(avg(CASE WHEN l_tax > 0 THEN 1.0 ELSE 0.0 END), 6) AS taxed
FROM lineitem GROUP BY l_returnflag HAVING count(*) > 10""")
def grouped_statistics(spark, folder):
    lines = load(spark, folder, "lineitem")
    taxed = lines.withColumn("tax", F.when(F.col("l_tax") > 0, F.col("l_tax")))
    return taxed.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("l_quantity"), 6).alias("mean"),
        F.round(F.stddev_samp("l_quantity"), 6).alias("spread"), F.min("l_extendedprice").alias("lowest"),
        F.max("l_extendedprice").alias("highest"), F.count_distinct("l_suppkey").alias("suppliers"),
        F.round(aggregates.not_null_share("tax"), 6).alias("taxed"),
    ).where("n > 10")


@query("""
SELECT round(percentile_cont(0.1) WITHIN GROUP (ORDER BY l_extendedprice), 4) AS p10,
       round(percentile_cont(0.5) WITHIN GROUP (ORDER BY l_extendedprice), 4) AS median,
       round(percentile_cont(0.99) WITHIN GROUP (ORDER BY l_extendedprice), 4) AS p99,
       percentile_cont(0.5) WITHIN GROUP (ORDER BY l_quantity) AS median_quantity,
       (SELECT mode() WITHIN GROUP (ORDER BY l_suppkey) FROM lineitem) AS busiest_supplier FROM lineitem""")
def percentiles_and_mode(spark, folder):
    lines = load(spark, folder, "lineitem")
    found = ordering.percentiles(lines, {"l_extendedprice": [0.1, 0.5, 0.99], "l_quantity": [0.5]})
    price = [round(found["l_extendedprice", p], 4) for p in (0.1, 0.5, 0.99)]
    row = (*price, found["l_quantity", 0.5], aggregates.most_frequent(lines, "l_suppkey"))
    return spark.createDataFrame([row], "p10 double, median double, p99 double, median_quantity double, busiest_supplier long")


@query("""
SELECT l_returnflag, n, round(share, 9) AS share FROM (
  SELECT l_returnflag, count(*) AS n, count(*) / (SELECT count(*) FROM lineitem)::DOUBLE AS share FROM lineitem GROUP BY l_returnflag)""")
def value_shares(spark, folder):
    shares = aggregates.frequencies(load(spark, folder, "lineitem"), "l_returnflag")
    return shares.withColumn("share", F.round("share", 9))


@query("""
SELECT coalesce(c.balance, s.balance) AS balance, coalesce(customers, 0) AS customers, coalesce(suppliers, 0) AS suppliers
FROM (SELECT CAST(floor(c_acctbal) AS BIGINT) AS balance, count(*) AS customers FROM customer GROUP BY 1) c
FULL JOIN (SELECT CAST(floor(s_acctbal) AS BIGINT) AS balance, count(*) AS suppliers FROM supplier GROUP BY 1) s ON c.balance = s.balance""")
def full_outer_counts(spark, folder):
    """Accounts by whole units of balance; most balances occur on one side only."""
    per_balance = lambda t, c, n: load(spark, folder, t).groupBy(F.floor(c).alias("balance")).agg(F.count(F.lit(1)).alias(n))
    ours = per_balance("customer", "c_acctbal", "customers").alias("c")
    theirs = per_balance("supplier", "s_acctbal", "suppliers").alias("s")
    zero = F.lit(0).cast("long")
    return ours.join(theirs, F.col("c.balance").eqNullSafe(F.col("s.balance")), "full").select(
        F.coalesce("c.balance", "s.balance").alias("balance"), F.coalesce("customers", zero).alias("customers"),
        F.coalesce("suppliers", zero).alias("suppliers"),
    )


@query("""
SELECT o_orderkey, ntile(11) OVER (ORDER BY o_totalprice, o_orderkey) AS tile,
       row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS place FROM orders""")
def global_ntile(spark, folder):
    """Rank and tile of every row in the order of the whole table."""
    orders = load(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    placed = ordering.row_numbers(orders, ["o_totalprice", "o_orderkey"], "place")
    total = placed.agg(F.count(F.lit(1)).alias("total"))
    return placed.crossJoin(F.broadcast(total)).select(
        "o_orderkey", ordering.ntile_of_position(F.col("place"), F.col("total"), 11).alias("tile"), "place"
    )


@query("""
SELECT 'customer' AS _source_relation, c_nationkey AS nation, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, NULL::BIGINT AS supplier_id
FROM customer WHERE c_acctbal > 0
UNION ALL
SELECT 'supplier', s_nationkey, s_name, s_acctbal, NULL, s_suppkey FROM supplier WHERE s_acctbal > 0""")
def union_relations(spark, folder):
    customer = load(spark, folder, "customer").toDF("customer_id", "name", "nation", "balance", "segment")
    supplier = load(spark, folder, "supplier").toDF("supplier_id", "name", "nation", "balance")
    return reshape.union_relations(
        {"customer": customer, "supplier": supplier}, exclude=["CUSTOMER_ID"], where="balance > 0"
    )


@query("""
SELECT CAST(c_nationkey AS VARCHAR) AS nation, CAST(c_acctbal AS DECIMAL(12,1)) AS balance, NULL::BIGINT AS supplier_id FROM customer
UNION ALL SELECT CAST(s_nationkey AS VARCHAR), CAST(s_acctbal AS DECIMAL(12,1)), s_suppkey FROM supplier""")
def union_relations_included(spark, folder):
    """Named columns only, two of them in a type of their own, and no column for the source."""
    customer = load(spark, folder, "customer").toDF("customer_id", "name", "nation", "balance", "segment")
    supplier = load(spark, folder, "supplier").toDF("supplier_id", "name", "nation", "balance")
    return reshape.union_relations(
        {"customer": customer, "supplier": supplier}, column_override={"NATION": "string", "balance": "decimal(12,1)"},
        include=["nation", "Balance", "supplier_id"], source_column_name=None)


@query("""
SELECT n_nationkey AS key, n_name AS name FROM nation UNION ALL SELECT r_regionkey, r_name FROM region""")
def union_by_prefix(spark, folder):
    prefix = _name("place")
    for table in ("nation", "region"):
        rows = load(spark, folder, table)
        sinks.save_view(rows.select(F.col(rows.columns[0]).alias("key"), F.col(rows.columns[1]).alias("name")), f"{prefix}_{table}")
    return catalog.union_by_prefix(spark, "%", prefix.upper(), source_column_name=None)


@query("""
SELECT p_partkey, 'p_brand' AS prop, p_brand AS val FROM part
UNION ALL SELECT p_partkey, 'p_type', CASE WHEN p_size > 40 THEN NULL ELSE p_type END FROM part
UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part
UNION ALL SELECT p_partkey, 'big', CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END FROM part""")
def unpivot_values(spark, folder):
    part = load(spark, folder, "part").withColumns({
        "p_type": F.when(F.col("p_size") <= 40, F.col("p_type")), "big": F.col("p_size") > 25
    })
    return reshape.unpivot(
        part, exclude=["p_partkey"], remove=["p_name", "p_retailprice"], field_name="prop", value_name="val"
    )


@query("""
WITH a AS (SELECT l_partkey, l_quantity FROM lineitem), b AS (SELECT l_partkey, 51 - l_quantity AS l_quantity FROM lineitem)
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def symmetric_difference(spark, folder):
    """Quantities of a part against the same quantities counted down from 51."""
    lines = load(spark, folder, "lineitem").select("l_partkey", "l_quantity")
    return reshape.symmetric_difference(lines, lines.withColumn("l_quantity", 51 - F.col("l_quantity")))


@query("""
WITH a AS (SELECT l_returnflag, l_linestatus, CAST(l_quantity AS INTEGER) AS q FROM lineitem),
     b AS (SELECT l_returnflag, CASE WHEN l_quantity > 20 THEN 'F' ELSE l_linestatus END, CAST(l_quantity AS INTEGER) FROM lineitem)
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def multiset_difference(spark, folder):
    """Few different rows, each many times, and each more often on one side."""
    lines = load(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", F.col("l_quantity").cast("int").alias("q"))
    closed = lines.withColumn("l_linestatus", F.when(F.col("q") > 20, "F").otherwise(F.col("l_linestatus")))
    return reshape.symmetric_difference(lines, closed, keep_duplicates=True)


LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


@query(f"""
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, {', '.join(LINE_ORDER[1:])}) AS place FROM lineitem)
WHERE place = 1""")
def deduplicate(spark, folder):
    lines = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *LINE_ORDER)
    return reshape.deduplicate(
        lines, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc_nulls_last(), *LINE_ORDER[1:]]
    )


@query("""SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem""")
def distinct_values(spark, folder):
    return load(spark, folder, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query("""
SELECT generated_number, CAST(coalesce(n, 0) AS BIGINT) AS lines
FROM (SELECT unnest(range(1, (SELECT CAST(max(l_quantity) AS BIGINT) + 1 FROM lineitem))) AS generated_number)
LEFT JOIN (SELECT CAST(l_quantity AS BIGINT) AS q, count(*) AS n FROM lineitem GROUP BY 1) ON q = generated_number""")
def generate_series(spark, folder):
    lines = load(spark, folder, "lineitem").select(F.col("l_quantity").cast("long").alias("generated_number"))
    top = reshape.get_single_value(lines.agg(F.max("generated_number")))
    counts = lines.groupBy("generated_number").agg(F.count(F.lit(1)).alias("lines"))
    return (
        series.generate_series(spark, top).join(counts, "generated_number", "left")
        .select("generated_number", F.coalesce("lines", F.lit(0).cast("long")).alias("lines"))
    )


@query("""
SELECT CAST(d AS TIMESTAMP) AS date_day, CAST(coalesce(n, 0) AS BIGINT) AS events
FROM (SELECT unnest(range(first, last + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM (
  SELECT CAST(date_trunc('day', min(ts)) AS TIMESTAMP) AS first, CAST(date_trunc('day', max(ts)) AS TIMESTAMP) AS last FROM events))
LEFT JOIN (SELECT date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY 1) ON day = d""")
def date_spine(spark, folder):
    per_day = load(spark, folder, "events").groupBy(
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("date_day")
    ).agg(F.count(F.lit(1)).alias("events"))
    ends = per_day.agg(F.min("date_day").alias("first"), F.timestamp_add("DAY", F.lit(1), F.max("date_day")).alias("end")).first()
    return (
        series.date_spine(spark, "day", str(ends["first"]), str(ends["end"])).join(per_day, "date_day", "left")
        .select("date_day", F.coalesce("events", F.lit(0).cast("long")).alias("events"))
    )


@query("""
WITH ends AS (SELECT min(CAST(o_orderdate AS TIMESTAMP)) AS first, max(CAST(o_orderdate AS TIMESTAMP)) AS last FROM orders),
starts AS (SELECT unnest(generate_series(0, CAST(datediff('month', first, last) AS BIGINT))) AS i, first FROM ends)
SELECT CAST(date_trunc('month', first) + to_months(CAST(i AS INTEGER)) AS TIMESTAMP) AS date_month, CAST(coalesce(n, 0) AS BIGINT) AS orders,
       coalesce(total, 0) AS total
FROM starts LEFT JOIN (SELECT date_trunc('month', o_orderdate) AS month, count(*) AS n, CAST(sum(floor(o_totalprice)) AS BIGINT) AS total
                       FROM orders GROUP BY 1) ON month = date_trunc('month', first) + to_months(CAST(i AS INTEGER))""")
def date_spine_months(spark, folder):
    """Orders of every month from the first order to the last, months without orders included."""
    per_month = load(spark, folder, "orders").groupBy(F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("date_month")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.floor("o_totalprice")).alias("total"))
    ends = per_month.agg(F.min("date_month").alias("first"), F.timestamp_add("MONTH", F.lit(1), F.max("date_month")).alias("end")).first()
    spine = series.date_spine(spark, "month", str(ends["first"]), str(ends["end"]))
    return spine.join(per_month, "date_month", "left").na.fill(0, ["orders", "total"])


# Scalar functions


@query("""
WITH made AS (SELECT l_orderkey, l_linenumber, l_quantity AS q, CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_discount + 0.0 END AS d,
                     l_tax + 0.0 AS t FROM lineitem)
SELECT l_orderkey, l_linenumber, round(coalesce(q, 0) + coalesce(d, 0) + coalesce(t, 0), 6) AS added,
       round(coalesce(q, 0) - coalesce(d, 0) - coalesce(t, 0), 6) AS subtracted,
       round(q / nullif(t, 0), 6) AS divided, round(q * t / nullif(d, 0), 6) AS expression_divided FROM made""")
def safe_arith(spark, folder):
    lines = load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("q"),
        F.when(F.col("l_returnflag") != "A", F.col("l_discount") + 0.0).alias("d"), (F.col("l_tax") + 0.0).alias("t"),
    )
    return lines.select(
        "l_orderkey", "l_linenumber", F.round(arithmetic.safe_add(["q", "d", "t"]), 6).alias("added"),
        F.round(arithmetic.safe_subtract(["q", "d", "t"]), 6).alias("subtracted"),
        F.round(arithmetic.safe_divide("q", "t"), 6).alias("divided"),
        F.round(arithmetic.safe_divide(F.col("q") * F.col("t"), "d"), 6).alias("expression_divided"),
    )


@query("""
SELECT bucket, count(*) AS n FROM (
  SELECT CASE WHEN o_totalprice < 100000 THEN 0 WHEN o_totalprice >= 400000 THEN 13
              ELSE CAST(floor((o_totalprice - 100000) / 25000.0) AS BIGINT) + 1 END AS bucket FROM orders)
GROUP BY bucket""")
def width_bucket(spark, folder):
    bucket = arithmetic.width_bucket("o_totalprice", 100000.0, 400000.0, 12).cast("long").alias("bucket")
    return load(spark, folder, "orders").groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))


@query(f"""
SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR) || '-' || CAST(o_custkey AS VARCHAR) || '-' ||
           coalesce(CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderpriority END, '{keys.NULL_TEXT}')) AS surrogate_key
FROM orders""")
def surrogate_key(spark, folder):
    priority = F.when(F.col("o_orderstatus") != "O", F.col("o_orderpriority"))
    return load(spark, folder, "orders").select(
        "o_orderkey", keys.generate_surrogate_key(["o_orderkey", "o_custkey", priority]).alias("surrogate_key")
    )


def _haversine_sql(factor: str) -> str:
    return f"""round({factor}2 * 3961 * asin(sqrt(pow(sin(radians(lat2 - lat1) / 2), 2)
        + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2))), 4)"""


@query(f"""
WITH points AS (SELECT o_orderkey, o_orderkey % 120 - 60.0 AS lat1, o_custkey % 300 - 150.0 AS lon1,
                       (o_orderkey + o_custkey) % 110 - 55.0 AS lat2, (o_orderkey * 7) % 280 - 140.0 AS lon2 FROM orders)
SELECT o_orderkey, {_haversine_sql('')} AS miles, {_haversine_sql('1.60934 * ')} AS km FROM points""")
def haversine(spark, folder):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    points = load(spark, folder, "orders").select(
        "o_orderkey", (k % 120 - 60.0).alias("lat1"), (c % 300 - 150.0).alias("lon1"),
        ((k + c) % 110 - 55.0).alias("lat2"), ((k * 7) % 280 - 140.0).alias("lon2"),
    )
    ends = ("lat1", "lon1", "lat2", "lon2")
    return points.select(
        "o_orderkey", F.round(geo.haversine_distance(*ends), 4).alias("miles"),
        F.round(geo.haversine_distance(*ends, unit="km"), 4).alias("km"),
    )


@query("""
SELECT l_orderkey, l_linenumber, abs(l_quantity - 25) AS distance, CAST(floor(l_extendedprice / 1000) AS BIGINT) AS low,
       CAST(ceil(l_extendedprice / 1000) AS BIGINT) AS high, l_orderkey % 7 AS rest, least(l_quantity, 10) AS at_most_ten,
       round(pow(l_quantity, 0.5), 6) AS power, round(exp(l_tax), 6) AS e, round(ln(l_quantity), 6) AS natural,
       round(log10(l_quantity) / log10(3), 6) AS log3, round(sqrt(l_extendedprice), 6) AS root,
       round(sin(radians(l_quantity)), 6) AS sine, round(cos(radians(l_quantity)), 6) AS cosine,
       round(asin(l_discount + 0.0), 6) AS arcsine, round(acos(l_discount + 0.0), 6) AS arccosine FROM lineitem""")
def math_functions(spark, folder):
    q, price = F.col("l_quantity"), F.col("l_extendedprice")
    six = lambda c, name: F.round(c, 6).alias(name)
    return load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.abs(q - 25).alias("distance"), F.floor(price / 1000).alias("low"),
        F.ceil(price / 1000).alias("high"), (F.col("l_orderkey") % 7).alias("rest"), F.least(q, F.lit(10.0)).alias("at_most_ten"),
        six(F.pow(q, F.lit(0.5)), "power"), six(F.exp("l_tax"), "e"), six(F.ln(q), "natural"), six(F.log(3.0, q), "log3"),
        six(F.sqrt(price), "root"), six(F.sin(F.radians(q)), "sine"), six(F.cos(F.radians(q)), "cosine"),
        six(F.asin(F.col("l_discount") + 0.0), "arcsine"), six(F.acos(F.col("l_discount") + 0.0), "arccosine"),
    )


_BARE = "replace(replace({0}, 'http://', ''), 'https://', '')"


@query("""
SELECT page_id, split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''), '/', 1), '?', 1) AS host
FROM pages""")
def url_host(spark, folder):
    return load(spark, folder, "pages").select("page_id", urls.get_url_host("url").alias("host"))


@query(f"""
WITH bare AS (SELECT page_id, {_BARE.format('url')} AS u FROM pages)
SELECT page_id, split_part(CASE WHEN instr(u, '/') > 0 THEN substr(u, instr(u, '/') + 1)
                                WHEN instr(u, '?') > 0 THEN '' ELSE u END, '?', 1) AS path FROM bare""")
def url_path(spark, folder):
    return load(spark, folder, "pages").select("page_id", urls.get_url_path("url").alias("path"))


@query("""
SELECT page_id, nullif(split_part(split_part(url, 'ref=', 2), '&', 1), '') AS ref,
       nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page FROM pages""")
def url_param(spark, folder):
    return load(spark, folder, "pages").select(
        "page_id", urls.get_url_parameter("url", "ref").alias("ref"), urls.get_url_parameter("url", "page").alias("page")
    )


@query("""
SELECT o_orderkey, last_day(o_orderdate) AS month_end, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
       o_orderdate + INTERVAL 3 MONTH AS later, date_diff('month', o_orderdate, TIMESTAMP '2000-01-31') AS months,
       date_diff('day', o_orderdate, TIMESTAMP '2000-01-31') AS days,
       greatest(date_diff('day', o_orderdate, TIMESTAMP '1998-01-01') - 14, 0) AS overdue,
       CAST(extract(year FROM o_orderdate) AS BIGINT) AS year FROM orders""")
def last_day_month_math(spark, folder):
    fixed = F.lit("2000-01-31").cast("timestamp_ntz")
    return load(spark, folder, "orders").select(
        "o_orderkey", dates.last_day("o_orderdate").alias("month_end"), dates.month_start("o_orderdate").alias("month_start"),
        dates.dateadd("month", 3, "o_orderdate").alias("later"), dates.datediff("month", "o_orderdate", fixed).alias("months"),
        dates.datediff("day", "o_orderdate", fixed).alias("days"),
        dates.overdue_days("o_orderdate", F.lit("1998-01-01").cast("timestamp_ntz"), 14).alias("overdue"),
        F.year("o_orderdate").cast("long").alias("year"),
    )


@query("""
SELECT c_custkey, upper(c_mktsegment) || ' / ' || lower(c_name) AS label, concat(c_mktsegment, ', ', NULL, c_name) AS joined,
       split_part(c_name, '#', 2) AS number, right(c_name, 3) AS tail, CAST(length(trim(c_mktsegment)) AS INTEGER) AS width,
       replace(c_mktsegment, 'E', 'e') AS swapped, substring(c_name, 1, 4) AS head, CAST(instr(c_name, '#') AS INTEGER) AS at
FROM customer""")
def text_functions(spark, folder):
    return load(spark, folder, "customer").select(
        "c_custkey", F.concat(F.upper("c_mktsegment"), F.lit(" / "), F.lower("c_name")).alias("label"),
        # concat_ws skips NULL, where concat would give NULL.
        F.concat_ws("", "c_mktsegment", F.lit(", "), F.lit(None).cast("string"), "c_name").alias("joined"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("number"), F.right("c_name", F.lit(3)).alias("tail"),
        F.length(F.trim("c_mktsegment")).alias("width"), F.replace("c_mktsegment", F.lit("E"), F.lit("e")).alias("swapped"),
        F.substring("c_name", 1, 4).alias("head"), F.instr("c_name", "#").alias("at"),
    )


@query("""
SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS INTEGER)) AS BIGINT) AS total,
       count(json_extract(props, '$.missing')) AS missing FROM events GROUP BY event_type""")
def json_column(spark, folder):
    events = load(spark, folder, "events").select(
        "event_type", files.json_value("props", "$.k", "int").alias("k"),
        files.json_value("props", "$.missing", "int").alias("m"),
    )
    return events.groupBy("event_type").agg(F.sum("k").alias("total"), F.count("m").alias("missing"))


_WORD_SQL = "list_contains(regexp_split_to_array(lower(text || ' ' || source), '[^\\p{{L}}\\p{{N}}]+'), '{0}')"


@query(f"""
SELECT doc_id, source FROM documents
WHERE {_WORD_SQL.format('the')} AND {_WORD_SQL.format('that')} AND NOT {_WORD_SQL.format('les')}""")
def fulltext_match(spark, folder):
    word = lambda w: textsearch.has_word(("text", "source"), w)
    return load(spark, folder, "documents").where(word("the") & word("that") & ~word("les")).select("doc_id", "source")


@query("""
SELECT doc_id, CAST(len(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> ''))) AS INTEGER) AS n_words
FROM documents""")
def document_words(spark, folder):
    return load(spark, folder, "documents").select("doc_id", F.size(textsearch.words("text")).alias("n_words"))


# Sinks and staging: what was written is read back


@query("""
SELECT c_name AS client, strftime(o_orderdate, '%Y-%m-%d') AS purchase_date, o_orderpriority AS product,
       CAST(floor(o_totalprice) AS INTEGER) AS price
FROM orders JOIN customer ON o_custkey = c_custkey""")
def stage_json_idempotent(spark, folder):
    """Orders written as JSON pages, staged twice for the same date, and read back."""
    base, date = new_folder(spark), "2022-08-09"
    sales = load(spark, folder, "orders").join(
        load(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).select(
        F.col("c_name").alias("client"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("purchase_date"),
        F.col("o_orderpriority").alias("product"), F.floor("o_totalprice").cast("int").alias("price"),
        F.floor(F.col("o_orderkey") / PAGE_KEYS).alias("page"),
    )
    # A page is one array in a file of its own: a few megabytes, one task's work, and no more files than that needs.
    pages = sales.groupBy("page").agg(
        F.to_json(F.collect_list(F.struct("client", "purchase_date", "product", "price"))).alias("value")
    )
    pages.select("value").write.option("maxRecordsPerFile", 1).text(f"{base}/raw/{date}")
    for _ in range(2):
        stage_sales(spark, f"{base}/raw/{date}", f"{base}/stg", date, format="parquet", pattern="*.txt")
    return spark.read.parquet(f"{base}/stg").drop("date")


@query("""
SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') AS payment_month FROM orders""")
def partitioned_sink(spark, folder):
    """One partition per month; months written again replace only themselves."""
    path = new_folder(spark)
    orders = load(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    sinks.write_monthly(orders, path, "o_orderdate")
    sinks.write_monthly(orders.where(F.year("o_orderdate") == 1997), path, "o_orderdate")
    # The schema keeps the month text; inference would turn it into a date.
    schema = "o_orderkey long, o_totalprice double, o_orderdate timestamp_ntz, payment_month string"
    return spark.read.schema(schema).parquet(path).drop("o_orderdate")


@query("""
SELECT l_returnflag, n, run FROM (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag),
     (VALUES ('2024-01-01'), ('2024-01-02')) AS runs(run)""")
def append_results(spark, folder):
    """Two runs appended to one table, each row stamped with the time of its run."""
    name, path = _name("flag_counts"), new_folder(spark)
    counts = load(spark, folder, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    for run in ("2024-01-01 00:00:00", "2024-01-02 00:00:00"):
        sinks.append_results(counts, name, run, path)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path).select("l_returnflag", "n", F.date_format("run_timestamp", "yyyy-MM-dd").alias("run"))


@query(star.QUERIES["sales_by_category_view"][1])
def materialized_refresh(spark, folder):
    """A table created empty and filled by its refresh."""
    name, path = _name("rental_by_category"), new_folder(spark)
    tables = star.rental_tables(spark, folder)
    view = sinks.MaterializedView(spark, name, lambda: star.rental.sales_by_film_category(tables), key=["category"], path=path)
    view.create()
    if not view.read().isEmpty():
        raise AssertionError("a materialized view starts empty")
    view.refresh()
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)


@query("""
SELECT c_custkey, c_mktsegment, TIMESTAMP '2024-02-03 04:05:06' AS last_update FROM customer""")
def stamped_rows(spark, folder):
    rows = load(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    stamped = sinks.stamp_last_update(rows, "2024-02-03 04:05:06")
    return stamped.withColumn("last_update", F.col("last_update").cast("timestamp_ntz"))


@query("""
SELECT r_regionkey, r_name, 'n/a' AS note FROM region""")
def csv_seed(spark, folder):
    """A table written as CSV and read as a seed: types by column, empty text as NULL, then a default."""
    path = new_folder(spark)
    load(spark, folder, "region").withColumn("note", F.lit("")).write.option("header", True).csv(path)
    seed = files.read_seed(spark, path, {"r_regionkey": "int", "note": "string"})
    return files.with_defaults(seed, {"note": "n/a"})


@query("""SELECT c_custkey AS id, c_name AS customer, CAST(c_acctbal AS DECIMAL(12,2)) AS balance FROM customer""")
def csv_loaded_table(spark, folder):
    """Customers written as CSV with a header and loaded into a typed table, the columns named by the load."""
    path, name = new_folder(spark), _name("loaded")
    load(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal").write.option("header", True).csv(f"{path}/raw")
    typed = files.read_columns(
        spark, f"{path}/raw", "c_custkey long, c_name string, c_acctbal decimal(12,2)", ["id", "customer", "balance"])
    sinks.save_table(typed, name, path=f"{path}/table")
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(f"{path}/table")


@query("""
SELECT n_name, count(*) AS customers, CAST(sum(floor(c_acctbal)) AS BIGINT) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def named_sources(spark, folder):
    """A model that knows its inputs by name only; one name is bound to a folder, the other to a table."""
    path, name = new_folder(spark), _name("nation")
    load(spark, folder, "customer").select("c_nationkey", "c_acctbal").write.parquet(f"{path}/customer")
    sinks.save_table(load(spark, folder, "nation").select("n_nationkey", "n_name"), name, path=f"{path}/nation")
    sources = catalog.Sources(spark, {"sales.customer": f"{path}/customer", "sales.nation": name})
    customer, nation = sources["sales.customer"], sources["sales.nation"]
    spent = customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"), F.sum(F.floor("c_acctbal")).alias("balance"))
    return spent.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "customers", "balance")


@query("""
SELECT event_type, count(*) AS n, count(value) AS n_values FROM (
  SELECT event_type, CASE WHEN event_type = 'purchase' THEN value END AS value FROM events) GROUP BY event_type""")
def event_values(spark, folder):
    """Events in the shape of the synthetic ones: only a purchase keeps its value."""
    events = load(spark, folder, "events").withColumn(
        "value", F.when(F.col("event_type") == "purchase", F.col("value"))
    )
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("n_values"))


@query("""
SELECT count(*) AS rows, count(*) AS right_user, count(*) AS right_kind, count(*) AS right_time, count(*) AS right_value FROM events""")
def synthetic_events(spark, folder):
    """As many synthetic events as the table has rows, counted by the rules they have to keep."""
    real = load(spark, folder, "events").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("t")).first()
    made = synthetic.synthetic_events(spark, real["t"], real["n"], seed=7)
    t = F.lit(real["t"]).cast("timestamp_ntz")
    age = F.timestamp_diff("SECOND", F.col("event_time"), t)
    bought = F.col("event_type") == "purchase"
    value_ok = F.when(bought, F.col("value").between(0, 100)).otherwise(F.col("value").isNull())
    return made.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("user_id").between(1, synthetic.USERS)).alias("right_user"),
        F.count_if(F.col("event_type").isin(*synthetic.EVENT_TYPES)).alias("right_kind"),
        F.count_if(age.between(0, synthetic.WINDOW_SECONDS)).alias("right_time"), F.count_if(value_ok).alias("right_value"),
    )


@query("""SELECT n AS number, n * (SELECT count(*) FROM region) AS product
FROM (SELECT unnest(range(1, (SELECT count(*) + 1 FROM nation))) AS n)""")
def multiplied_numbers(spark, folder):
    numbers = series.generate_numbers(spark, load(spark, folder, "nation").count())
    doubled = numbers.withColumn("product", F.col("number"))
    return series.multiply(doubled, load(spark, folder, "region").count(), "product")
