"""The rental reports, run on rental tables derived from the whole trade tables.

Parts are films, brands categories, suppliers actors (an actor plays in a film when the supplier has
delivered the part), orders rentals and payments, nations stores. Two copies of each part
are kept. An order with status O is a rental that is still out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans import rental
from millrace.session import Tables, load_table, load_tables

TODAY = "1998-06-15"
AS_OF = "1998-01-01 00:00:00"


def rental_tables(spark: SparkSession, folder: str) -> Tables:
    t = load_tables(spark, folder)
    key = F.col
    days_out = F.pmod(key("o_orderkey"), F.lit(14)) + 1
    return Tables({
        "country": lambda: t["region"].select(key("r_regionkey").alias("country_id"), key("r_name").alias("country")),
        "city": lambda: t["nation"].select(
            key("n_nationkey").alias("city_id"), key("n_name").alias("city"), key("n_regionkey").alias("country_id")
        ),
        "address": lambda: t["customer"].select(
            key("c_custkey").alias("address_id"), F.concat(F.lit("1 "), "c_name").alias("address"),
            key("c_nationkey").cast("string").alias("postal_code"), key("c_custkey").cast("string").alias("phone"),
            key("c_nationkey").alias("city_id"),
        ).unionByName(t["nation"].select(
            (-key("n_nationkey") - 1).cast("long").alias("address_id"), F.concat(F.lit("2 "), "n_name").alias("address"),
            key("n_nationkey").cast("string").alias("postal_code"), key("n_nationkey").cast("string").alias("phone"),
            key("n_nationkey").alias("city_id"),
        )),
        "customer": lambda: t["customer"].select(
            key("c_custkey").alias("customer_id"), key("c_nationkey").alias("store_id"),
            key("c_mktsegment").alias("first_name"), key("c_name").alias("last_name"),
            key("c_custkey").alias("address_id"), (key("c_acctbal") >= 0).alias("activebool"),
        ),
        "staff": lambda: t["nation"].select(
            key("n_nationkey").alias("staff_id"), F.lit("Manager").alias("first_name"), key("n_name").alias("last_name"),
            (-key("n_nationkey") - 1).cast("long").alias("address_id"), key("n_nationkey").alias("store_id"),
        ),
        "store": lambda: t["nation"].select(
            key("n_nationkey").alias("store_id"), key("n_nationkey").alias("manager_staff_id"),
            (-key("n_nationkey") - 1).cast("long").alias("address_id"),
        ),
        "category": lambda: t["part"].select("p_brand").distinct().select(
            F.substring("p_brand", 7, 9).cast("int").alias("category_id"), key("p_brand").alias("name")
        ),
        "film": lambda: t["part"].select(
            key("p_partkey").alias("film_id"), F.concat("p_name", F.lit(" "), key("p_partkey").cast("string")).alias("title"),
            key("p_type").alias("description"), key("p_size").alias("length"),
            (F.pmod(key("p_size"), F.lit(5)) + 3).alias("rental_duration"),
            key("p_retailprice").cast("decimal(10,2)").alias("rental_rate"),
            (key("p_retailprice").cast("decimal(10,2)") * 2).cast("decimal(10,2)").alias("replacement_cost"),
            F.when(key("p_size") < 20, "G").when(key("p_size") < 40, "PG").otherwise("R").alias("rating"),
        ),
        "film_category": lambda: t["part"].select(
            key("p_partkey").alias("film_id"), F.substring("p_brand", 7, 9).cast("int").alias("category_id")
        ),
        "actor": lambda: t["supplier"].select(
            key("s_suppkey").alias("actor_id"), F.split_part("s_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("s_name", F.lit("#"), F.lit(2)).alias("last_name"),
        ),
        "film_actor": lambda: t["lineitem"].select(
            key("l_suppkey").alias("actor_id"), key("l_partkey").alias("film_id")
        ).distinct(),
        "inventory": lambda: t["part"].select(
            key("p_partkey").alias("film_id"), F.explode(F.array(F.lit(0), F.lit(1))).alias("copy")
        ).select(
            (key("film_id") * 2 + key("copy")).alias("inventory_id"), "film_id",
            F.pmod(key("film_id") + key("copy"), F.lit(25)).cast("int").alias("store_id"),
        ),
        "rental": lambda: t["orders"].crossJoin(F.broadcast(t["part"].agg((F.count(F.lit(1)) * 2).alias("n_items")))).select(
            key("o_orderkey").alias("rental_id"), key("o_orderdate").alias("rental_date"),
            F.pmod(key("o_orderkey") * 7, key("n_items")).alias("inventory_id"), key("o_custkey").alias("customer_id"),
            F.when(key("o_orderstatus") != "O", F.timestamp_add("DAY", days_out, key("o_orderdate"))).alias("return_date"),
        ),
        "payment": lambda: t["orders"].select(
            key("o_orderkey").alias("payment_id"), key("o_custkey").alias("customer_id"),
            key("o_orderkey").alias("rental_id"), key("o_totalprice").cast("decimal(12,2)").alias("amount"),
            key("o_orderdate").alias("payment_date"),
        ),
    })


RENTAL_SQL = """
WITH country AS (SELECT r_regionkey AS country_id, r_name AS country FROM region),
city AS (SELECT n_nationkey AS city_id, n_name AS city, n_regionkey AS country_id FROM nation),
address AS (
  SELECT c_custkey AS address_id, '1 ' || c_name AS address, CAST(c_nationkey AS VARCHAR) AS postal_code,
         CAST(c_custkey AS VARCHAR) AS phone, c_nationkey AS city_id FROM customer
  UNION ALL
  SELECT -n_nationkey - 1, '2 ' || n_name, CAST(n_nationkey AS VARCHAR), CAST(n_nationkey AS VARCHAR), n_nationkey
  FROM nation),
client AS (
  SELECT c_custkey AS customer_id, c_nationkey AS store_id, c_mktsegment AS first_name, c_name AS last_name,
         c_custkey AS address_id, c_acctbal >= 0 AS activebool FROM customer),
staff AS (
  SELECT n_nationkey AS staff_id, 'Manager' AS first_name, n_name AS last_name, -n_nationkey - 1 AS address_id,
         n_nationkey AS store_id FROM nation),
store AS (SELECT n_nationkey AS store_id, n_nationkey AS manager_staff_id, -n_nationkey - 1 AS address_id FROM nation),
category AS (SELECT DISTINCT CAST(substr(p_brand, 7) AS INTEGER) AS category_id, p_brand AS name FROM part),
film AS (
  SELECT p_partkey AS film_id, p_name || ' ' || CAST(p_partkey AS VARCHAR) AS title, p_type AS description,
         p_size AS length, p_size % 5 + 3 AS rental_duration, CAST(p_retailprice AS DECIMAL(10,2)) AS rental_rate,
         CASE WHEN p_size < 20 THEN 'G' WHEN p_size < 40 THEN 'PG' ELSE 'R' END AS rating FROM part),
film_category AS (SELECT p_partkey AS film_id, CAST(substr(p_brand, 7) AS INTEGER) AS category_id FROM part),
actor AS (
  SELECT s_suppkey AS actor_id, split_part(s_name, '#', 1) AS first_name, split_part(s_name, '#', 2) AS last_name
  FROM supplier),
film_actor AS (SELECT DISTINCT l_suppkey AS actor_id, l_partkey AS film_id FROM lineitem),
inventory AS (
  SELECT p_partkey * 2 + copy AS inventory_id, p_partkey AS film_id, CAST((p_partkey + copy) % 25 AS INTEGER) AS store_id
  FROM part, (SELECT unnest([0, 1]) AS copy)),
rental AS (
  SELECT o_orderkey AS rental_id, o_orderdate AS rental_date,
         (o_orderkey * 7) % (SELECT 2 * count(*) FROM part) AS inventory_id, o_custkey AS customer_id,
         CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_days(CAST(o_orderkey % 14 + 1 AS INTEGER)) END AS return_date
  FROM orders),
payment AS (
  SELECT o_orderkey AS payment_id, o_custkey AS customer_id, o_orderkey AS rental_id,
         CAST(o_totalprice AS DECIMAL(12,2)) AS amount, o_orderdate AS payment_date FROM orders)
"""

# Every order borrows one of the two copies of a part.
_LOANS = """
WITH loans AS (
  SELECT p_partkey, p_name, p_brand, item % 2 AS copy, o_orderkey, o_custkey, o_orderstatus, o_orderdate,
         CAST(o_totalprice AS DECIMAL(12,2)) AS paid
  FROM (SELECT *, o_orderkey * 7 % (SELECT 2 * count(*) FROM part) AS item FROM orders) JOIN part ON p_partkey = item // 2)
"""


def _busiest_suppliers(condition: str, limit: int) -> str:
    """Loans of the parts that a supplier delivers: counted by part first, then added up by supplier."""
    return f"""{_LOANS},
        by_part AS (SELECT p_partkey, count(*) AS times FROM loans WHERE {condition} GROUP BY ALL),
        delivered AS (SELECT l_suppkey, sum(times) AS times
                      FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) JOIN by_part ON l_partkey = p_partkey GROUP BY ALL)
        SELECT s_suppkey AS actor_id, string_split(s_name, '#')[1] AS first_name, string_split(s_name, '#')[2] AS last_name,
               CAST(times AS BIGINT) AS rental_count
        FROM delivered JOIN supplier ON s_suppkey = l_suppkey ORDER BY rental_count DESC, actor_id LIMIT {limit}"""


def _film_list(actor: str) -> str:
    """Parts with the names of their suppliers; ``actor`` makes a name of ``s_name``."""
    return f"""
        WITH suppliers_of AS (
          SELECT l_partkey, {actor} AS actor FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) JOIN supplier ON s_suppkey = l_suppkey)
        SELECT p_partkey AS fid, concat_ws(' ', p_name, p_partkey) AS title, p_type AS description, p_brand AS category,
               CAST(p_retailprice AS DECIMAL(10,2)) AS price, p_size AS length,
               CASE WHEN p_size >= 40 THEN 'R' WHEN p_size >= 20 THEN 'PG' ELSE 'G' END AS rating,
               (SELECT string_agg(actor, ', ' ORDER BY actor) FROM suppliers_of WHERE l_partkey = p_partkey) AS actors
        FROM part WHERE p_partkey IN (SELECT l_partkey FROM suppliers_of)"""


# name -> (report on the rental tables, the same report as SQL on the given tables or after RENTAL_SQL)
REPORTS = {
    "group_count_by_category": (rental.films_per_category, """
        SELECT c.name AS category_name, CAST(count(fc.film_id) AS BIGINT) AS film_count
        FROM category c JOIN film_category fc ON c.category_id = fc.category_id GROUP BY c.name"""),
    "topk_entities_by_fact_rows": (rental.top_actors_by_rentals, _busiest_suppliers("true", 10)),
    "top_category_by_revenue": (rental.top_category_by_payments, f"""{_LOANS}
        SELECT p_brand AS category_name, CAST(sum(paid) AS DECIMAL(18,2)) AS total_amount FROM loans
        GROUP BY p_brand ORDER BY 2 DESC, 1 LIMIT 1"""),
    "topk_in_filtered_category": (
        lambda t: rental.top_actors_in_category(t, "Brand#7"), _busiest_suppliers("p_brand = 'Brand#7'", 3)),
    "late_open_items": (lambda t: rental.late_rentals(t, TODAY), f"""{_LOANS}
        SELECT o_orderkey AS rental_id, concat(c_name, ', ', c_mktsegment) AS customer, CAST(c_custkey AS VARCHAR) AS phone,
               concat_ws(' ', p_name, p_partkey) AS title
        FROM customer JOIN loans ON o_custkey = c_custkey
        WHERE (o_orderstatus <> 'O') IS NOT TRUE AND o_orderdate < TIMESTAMP '{TODAY}' ORDER BY title, rental_id LIMIT 5"""),
    "listagg_two_level": (rental.actor_info, """
        WITH shelves AS (
          SELECT l_suppkey, concat(p_brand, ': ', string_agg(concat_ws(' ', p_name, p_partkey), ', ' ORDER BY concat_ws(' ', p_name, p_partkey))) AS shelf
          FROM part JOIN (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) ON l_partkey = p_partkey GROUP BY l_suppkey, p_brand)
        SELECT s_suppkey AS actor_id, string_split(s_name, '#')[1] AS first_name, string_split(s_name, '#')[2] AS last_name,
               (SELECT string_agg(shelf, ', ' ORDER BY shelf) FROM shelves WHERE l_suppkey = s_suppkey) AS film_info
        FROM supplier"""),
    # The result's column names are fixed values.
    "contact_list_view": (rental.customer_list, """
        SELECT c_custkey AS id, concat_ws(' ', c_mktsegment, c_name) AS name, concat('1 ', c_name) AS address,
               CAST(n_nationkey AS VARCHAR) AS "zip code", CAST(c_custkey AS VARCHAR) AS phone, n_name AS city, r_name AS country,
               if(c_acctbal >= 0, 'active', '') AS notes, n_nationkey AS sid
        FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey"""),
    "staff_list_view": (rental.staff_list, """
        SELECT n_nationkey AS id, concat('Manager ', n_name) AS name, concat('2 ', n_name) AS address,
               CAST(n_nationkey AS VARCHAR) AS "zip code", CAST(n_nationkey AS VARCHAR) AS phone, n_name AS city,
               r_name AS country, n_nationkey AS sid
        FROM region JOIN nation ON n_regionkey = r_regionkey"""),
    "concat_list_view": (rental.film_list, _film_list("replace(s_name, '#', ' ')")),
    "recased_list_view": (rental.film_list_recased, _film_list("concat(upper(s_name[1]), lower(replace(s_name[2:], '#', '')))")),
    "sales_by_category_view": (rental.sales_by_film_category, f"""{_LOANS}
        SELECT p_brand AS category, CAST(sum(paid) AS DECIMAL(18,2)) AS total_sales FROM loans GROUP BY p_brand"""),
    "sales_by_store": (rental.sales_by_store, f"""{_LOANS},
        takings AS (SELECT (p_partkey + copy) % 25 AS place, sum(paid) AS total FROM loans GROUP BY ALL)
        SELECT concat(n_name, ',', r_name) AS store, concat('Manager ', n_name) AS manager, CAST(total AS DECIMAL(18,2)) AS total_sales
        FROM region JOIN nation ON n_regionkey = r_regionkey JOIN takings ON place = n_nationkey"""),
    "in_stock": (rental.inventory_in_stock, """
        SELECT i.inventory_id, CAST(count(r.rental_id) AS BIGINT) = 0 AS in_stock
        FROM inventory i LEFT JOIN rental r ON i.inventory_id = r.inventory_id AND r.return_date IS NULL
        GROUP BY i.inventory_id"""),
    "items_in_stock": (rental.film_stock, """
        SELECT film_id, store_id, inventory_id FROM inventory
        WHERE inventory_id NOT IN (SELECT inventory_id FROM rental WHERE return_date IS NULL)"""),
    "items_not_in_stock": (lambda t: rental.film_stock(t, in_stock=False), """
        SELECT film_id, store_id, inventory_id FROM inventory
        WHERE inventory_id IN (SELECT inventory_id FROM rental WHERE return_date IS NULL)"""),
    "held_by": (rental.inventory_held_by, """
        SELECT inventory_id, customer_id FROM rental WHERE return_date IS NULL"""),
    "customer_balance_asof": (lambda t: rental.customer_balance(t, AS_OF), f""",
        fees AS (
          SELECT r.customer_id, sum(f.rental_rate + greatest(0, coalesce(CAST(floor(
                   date_diff('day', r.rental_date, r.return_date) - f.rental_duration) AS BIGINT), 0))) AS fees
          FROM rental r JOIN inventory i ON r.inventory_id = i.inventory_id JOIN film f ON i.film_id = f.film_id
          WHERE r.rental_date <= TIMESTAMP '{AS_OF}' GROUP BY r.customer_id),
        paid AS (SELECT customer_id, sum(amount) AS paid FROM payment WHERE payment_date <= TIMESTAMP '{AS_OF}' GROUP BY customer_id)
        SELECT c.customer_id, CAST(coalesce(fees, 0) - coalesce(paid, 0) AS DECIMAL(18,2)) AS balance
        FROM client c LEFT JOIN fees USING (customer_id) LEFT JOIN paid USING (customer_id)"""),
    "rewards_report": (lambda t: rental.rewards_report(t, 1, 250000, TODAY), """
        SELECT * FROM client WHERE customer_id IN (
          SELECT customer_id FROM payment WHERE CAST(payment_date AS DATE) BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'
          GROUP BY customer_id HAVING sum(amount) > 250000 AND count(customer_id) > 1)"""),
}


def _on_rental_tables(report):
    return lambda spark, folder: report(rental_tables(spark, folder))


# Reports whose SQL uses the rental tables; the others are put straight to the given ones.
_ON_RENTAL_TABLES = {
    "group_count_by_category", "in_stock", "items_in_stock",
    "items_not_in_stock", "held_by", "customer_balance_asof", "rewards_report",
}
QUERIES = {
    name: (_on_rental_tables(report), RENTAL_SQL + sql if name in _ON_RENTAL_TABLES else sql)
    for name, (report, sql) in REPORTS.items()
}


def unlabelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The films without a copy, where films are documents and copies their labels: some documents have none."""
    documents, labels = load_table(spark, folder, "documents"), load_table(spark, folder, "labels")
    title = F.concat_ws(" ", "source", "lang", F.col("doc_id").cast("string"))
    return rental.films_without_inventory({
        "film": documents.select(F.col("doc_id").alias("film_id"), title.alias("title")), "inventory": labels.select(F.col("doc_id").alias("film_id"))})


QUERIES["anti_join_missing_children"] = (unlabelled_documents, """
    SELECT doc_id AS film_id, concat_ws(' ', source, lang, doc_id) AS title FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")

MOMENT = "1997-06-15 11:30:00"


def balance_at_an_hour(spark: SparkSession, folder: str) -> DataFrame:
    """Balances in the middle of a day, of rentals and payments that have hours; a part of a day too long costs nothing."""
    t = rental_tables(spark, folder)
    hours = lambda column, key, factor: F.timestamp_add("HOUR", F.pmod(F.col(key) * factor, F.lit(24)), F.col(column))
    timed = {
        "rental": t["rental"].withColumns({"rental_date": hours("rental_date", "rental_id", 1), "return_date": hours("return_date", "rental_id", 5)}),
        "payment": t["payment"].withColumn("payment_date", hours("payment_date", "payment_id", 11)),
    }
    return rental.customer_balance(Tables({name: (lambda name=name: timed.get(name, t[name])) for name in t}), MOMENT, charge_replacement=True)


QUERIES["customer_balance_at_an_hour"] = (balance_at_an_hour, RENTAL_SQL + f""",
    timed AS (
      SELECT customer_id, inventory_id, rental_date + to_hours(CAST(rental_id % 24 AS INTEGER)) AS since,
             return_date + to_hours(CAST(rental_id * 5 % 24 AS INTEGER)) AS until FROM rental),
    terms AS (
      SELECT t.customer_id, f.rental_rate, f.rental_duration, CAST(floor((epoch(t.until) - epoch(t.since)) / 86400 - f.rental_duration) AS BIGINT) AS late
      FROM timed t JOIN inventory i USING (inventory_id) JOIN film f USING (film_id) WHERE t.since <= TIMESTAMP '{MOMENT}'),
    fees AS (
      SELECT customer_id, sum(rental_rate + greatest(0, coalesce(late, 0)) + CASE WHEN late > 2 * rental_duration THEN 2 * rental_rate ELSE 0 END) AS fees
      FROM terms GROUP BY customer_id),
    paid AS (
      SELECT customer_id, sum(amount) AS paid FROM payment
      WHERE payment_date + to_hours(CAST(payment_id * 11 % 24 AS INTEGER)) <= TIMESTAMP '{MOMENT}' GROUP BY customer_id)
    SELECT c.customer_id, CAST(coalesce(fees, 0) - coalesce(paid, 0) AS DECIMAL(18,2)) AS balance
    FROM client c LEFT JOIN fees USING (customer_id) LEFT JOIN paid USING (customer_id)""")
