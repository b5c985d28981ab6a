"""Reports over the rental star schema.

Every report takes the tables it needs as a mapping from table name to DataFrame. Facts are counted or
summed to the join key before they meet the next table, so a hot film, customer or store is one row
per map task and not a pile in one reducer; dimensions are broadcast only when their size estimate
allows it (``join_small``).
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggregates import group_concat
from millrace.operators.joins import anti, join_small, semi

Tables = Mapping[str, DataFrame]


def _money(column: Column) -> Column:
    return column.cast("decimal(18,2)")


def films_per_category(t: Tables) -> DataFrame:
    """Number of films in each category, largest first."""
    counts = t["film_category"].groupBy("category_id").agg(F.count("film_id").alias("film_count"))
    return (
        join_small(counts, t["category"].select("category_id", "name"), "category_id")
        .groupBy(F.col("name").alias("category_name"))
        .agg(F.sum("film_count").alias("film_count"))
        .orderBy(F.desc("film_count"), "category_name")
    )


def _rentals_per_film(t: Tables, items: DataFrame | None = None) -> DataFrame:
    """Rentals per film, for all items of the inventory or for the given (inventory_id, film_id) rows."""
    if items is None:
        items = t["inventory"].select("inventory_id", "film_id")
    per_item = t["rental"].groupBy("inventory_id").agg(F.count("rental_id").alias("rentals"))
    return per_item.join(items, "inventory_id").groupBy("film_id").agg(F.sum("rentals").alias("rentals"))


def _rentals_per_actor(t: Tables, films: DataFrame) -> DataFrame:
    per_actor = (
        t["film_actor"].select("actor_id", "film_id").join(films, "film_id")
        .groupBy("actor_id").agg(F.sum("rentals").alias("rental_count"))
    )
    names = t["actor"].select("actor_id", "first_name", "last_name")
    return join_small(per_actor, names, "actor_id")


def top_actors_by_rentals(t: Tables, k: int = 10) -> DataFrame:
    """The actors whose films were rented most; ties by actor id."""
    return (
        _rentals_per_actor(t, _rentals_per_film(t))
        .select("actor_id", "first_name", "last_name", "rental_count")
        .orderBy(F.desc("rental_count"), "actor_id").limit(k)
    )


def top_actors_in_category(t: Tables, category: str = "Children", k: int = 3) -> DataFrame:
    """As ``top_actors_by_rentals`` for the films of one category."""
    wanted = t["category"].where(F.col("name") == category).select("category_id")
    films = join_small(t["film_category"].select("film_id", "category_id"), wanted, "category_id")
    # The category picks the items before they meet the rentals. A film listed twice counts twice.
    items = t["inventory"].select("inventory_id", "film_id").join(films.select("film_id"), "film_id")
    return (
        _rentals_per_actor(t, _rentals_per_film(t, items))
        .select("actor_id", "first_name", "last_name", "rental_count")
        .orderBy(F.desc("rental_count"), "actor_id").limit(k)
    )


def _paid_per_item(t: Tables) -> DataFrame:
    """Amount paid per inventory item; payments are summed per rental before the join."""
    paid = t["payment"].groupBy("rental_id").agg(F.sum("amount").alias("amount"))
    return (
        paid.join(t["rental"].select("rental_id", "inventory_id"), "rental_id")
        .groupBy("inventory_id").agg(F.sum("amount").alias("amount"))
    )


def sales_by_film_category(t: Tables) -> DataFrame:
    """Amount paid per category of the film, largest first."""
    per_film = (
        _paid_per_item(t)
        .join(t["inventory"].select("inventory_id", "film_id"), "inventory_id")
        .groupBy("film_id").agg(F.sum("amount").alias("amount"))
    )
    per_category = (
        per_film.join(t["film_category"].select("film_id", "category_id"), "film_id")
        .groupBy("category_id").agg(F.sum("amount").alias("amount"))
    )
    return (
        join_small(per_category, t["category"].select("category_id", "name"), "category_id")
        .groupBy(F.col("name").alias("category"))
        .agg(_money(F.sum("amount")).alias("total_sales"))
        .orderBy(F.desc_nulls_last("total_sales"), "category")
    )


def top_category_by_payments(t: Tables) -> DataFrame:
    """The category that most money was paid for."""
    return sales_by_film_category(t).limit(1).select(
        F.col("category").alias("category_name"), F.col("total_sales").alias("total_amount")
    )


def films_without_inventory(t: Tables) -> DataFrame:
    return anti(t["film"].select("film_id", "title"), t["inventory"], "film_id").select("film_id", "title")


def late_rentals(t: Tables, today: date | datetime | str, k: int = 5) -> DataFrame:
    """Rentals that are out and started before ``today``, first ``k`` by title, with the customer's phone."""
    open_rentals = (
        t["rental"]
        .where(F.col("return_date").isNull() & (F.col("rental_date") < F.lit(today).cast("timestamp_ntz")))
        .select("rental_id", "customer_id", "inventory_id")
    )
    # Dimensions meet each other first, so the rentals are shuffled once per key of their own.
    customers = t["customer"].select("customer_id", "last_name", "first_name", "address_id").join(
        t["address"].select("address_id", "phone"), "address_id"
    )
    items = t["inventory"].select("inventory_id", "film_id").join(t["film"].select("film_id", "title"), "film_id")
    return (
        open_rentals.join(items, "inventory_id").join(customers, "customer_id")
        .select(
            "rental_id",
            F.concat_ws("", F.col("last_name"), F.lit(", "), F.col("first_name")).alias("customer"),
            "phone", "title",
        )
        .orderBy("title", "rental_id").limit(k)
    )


def actor_info(t: Tables) -> DataFrame:
    """Per actor the text ``category: title, title, category: title``; NULL for an actor without films."""
    titles = (
        t["film_actor"].select("actor_id", "film_id")
        .join(t["film"].select("film_id", "title"), "film_id")
        .join(t["film_category"].select("film_id", "category_id"), "film_id")
    )
    per_category = group_concat(titles, ["actor_id", "category_id"], "title", "titles")
    labelled = join_small(per_category, t["category"].select("category_id", "name"), "category_id").select(
        "actor_id", F.concat("name", F.lit(": "), "titles").alias("entry")
    )
    infos = group_concat(labelled, ["actor_id"], "entry", "film_info", distinct=True)
    return t["actor"].select("actor_id", "first_name", "last_name").join(infos, "actor_id", "left")


def _located(t: Tables, people: DataFrame) -> DataFrame:
    """People with their address, city and country."""
    addresses = t["address"].select("address_id", "address", "postal_code", "phone", "city_id")
    with_address = people.join(addresses, "address_id")
    with_city = join_small(with_address, t["city"].select("city_id", "city", "country_id"), "city_id")
    return join_small(with_city, t["country"].select("country_id", "country"), "country_id")


def _full_name() -> Column:
    return F.concat("first_name", F.lit(" "), "last_name")


def customer_list(t: Tables) -> DataFrame:
    people = t["customer"].select(
        "customer_id", "first_name", "last_name", "address_id", "activebool", "store_id"
    )
    return _located(t, people).select(
        F.col("customer_id").alias("id"), _full_name().alias("name"), "address",
        F.col("postal_code").alias("zip code"), "phone", "city", "country",
        F.when(F.col("activebool"), "active").otherwise("").alias("notes"), F.col("store_id").alias("sid"),
    )


def staff_list(t: Tables) -> DataFrame:
    people = t["staff"].select("staff_id", "first_name", "last_name", "address_id", "store_id")
    return _located(t, people).select(
        F.col("staff_id").alias("id"), _full_name().alias("name"), "address",
        F.col("postal_code").alias("zip code"), "phone", "city", "country", F.col("store_id").alias("sid"),
    )


def _films_with_actors(t: Tables, actor_name: Column) -> DataFrame:
    names = join_small(
        t["film_actor"].select("actor_id", "film_id"),
        t["actor"].select("actor_id", actor_name.alias("actor_name")), "actor_id",
    )
    # The cast is joined to text once per film, before the wider film columns come in.
    casts = group_concat(names, ["film_id"], "actor_name", "actors")
    films = t["film"].select("film_id", "title", "description", "rental_rate", "length", "rating")
    categorised = join_small(
        t["film_category"].select("film_id", "category_id"),
        t["category"].select("category_id", "name"), "category_id",
    )
    return films.join(categorised, "film_id").join(casts, "film_id").select(
        F.col("film_id").alias("fid"), "title", "description", F.col("name").alias("category"),
        F.col("rental_rate").alias("price"), "length", "rating", "actors",
    )


def film_list(t: Tables) -> DataFrame:
    """Films with category and the list of actors."""
    return _films_with_actors(t, _full_name())


def film_list_recased(t: Tables) -> DataFrame:
    """``film_list`` with first and last names re-cased and written together."""
    recase = lambda c: F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.expr(f"substring({c}, 2)")))
    return _films_with_actors(t, F.concat(recase("first_name"), recase("last_name")))


def sales_by_store(t: Tables) -> DataFrame:
    """Amount paid per store with its ``city,country`` label and manager."""
    per_store = (
        _paid_per_item(t)
        .join(t["inventory"].select("inventory_id", "store_id"), "inventory_id")
        .groupBy("store_id").agg(F.sum("amount").alias("amount"))
    )
    stores = join_small(per_store, t["store"].select("store_id", "manager_staff_id", "address_id"), "store_id")
    managers = t["staff"].select(
        F.col("staff_id").alias("manager_staff_id"), _full_name().alias("manager")
    )
    located = join_small(_located(t, stores), managers, "manager_staff_id")
    return located.groupBy("country", "city", "store_id", "manager").agg(
        _money(F.sum("amount")).alias("total_sales")
    ).orderBy("country", "city", "store_id").select(
        F.concat("city", F.lit(","), "country").alias("store"), "manager", "total_sales"
    )


def inventory_in_stock(t: Tables) -> DataFrame:
    """(inventory_id, in_stock): an item is in stock unless one of its rentals is still open."""
    out = t["rental"].where(F.col("return_date").isNull()).select("inventory_id").distinct()
    return (
        t["inventory"].select("inventory_id")
        .join(out.withColumn("_out", F.lit(True)), "inventory_id", "left")
        .select("inventory_id", F.col("_out").isNull().alias("in_stock"))
    )


def film_stock(
    t: Tables, film_id: int | None = None, store_id: int | None = None, in_stock: bool = True
) -> DataFrame:
    """Items of a film in a store that are in stock (or not); both keys may be left open."""
    items = t["inventory"].select("film_id", "store_id", "inventory_id")
    if film_id is not None:
        items = items.where(F.col("film_id") == film_id)
    if store_id is not None:
        items = items.where(F.col("store_id") == store_id)
    out = t["rental"].where(F.col("return_date").isNull())
    return anti(items, out, "inventory_id") if in_stock else semi(items, out, "inventory_id")


def inventory_held_by(t: Tables, inventory_id: int | None = None) -> DataFrame:
    """(inventory_id, customer_id) of the open rentals."""
    held = t["rental"].where(F.col("return_date").isNull()).select("inventory_id", "customer_id")
    return held if inventory_id is None else held.where(F.col("inventory_id") == inventory_id)


def customer_balance(t: Tables, as_of: datetime | str, charge_replacement: bool = False) -> DataFrame:
    """Rental fees plus a dollar per overdue day minus payments up to ``as_of``, for every customer.

    ``charge_replacement`` adds the replacement cost of a film kept for more than twice its rental
    duration beyond the due date, a rule the reports state but do not apply.
    """
    moment = F.lit(as_of).cast("timestamp_ntz")
    films = t["film"].select("film_id", "rental_rate", "rental_duration", "replacement_cost")
    # Items get the terms of their film first, so the rentals are shuffled once and not twice.
    items = t["inventory"].select("inventory_id", "film_id").join(films, "film_id")
    kept = (
        t["rental"].where(F.col("rental_date") <= moment)
        .select("customer_id", "inventory_id", "rental_date", "return_date")
        .join(items, "inventory_id")
    )
    # Whole days beyond the allowed ones; an open rental has no overdue fee.
    held = F.timestamp_diff("SECOND", F.col("rental_date"), F.col("return_date"))
    overdue = F.floor((held - F.col("rental_duration") * 86400) / 86400)
    late = F.when(overdue > 0, overdue).otherwise(0).cast("long")
    fee = F.col("rental_rate").cast("decimal(18,2)") + late.cast("decimal(18,2)")
    if charge_replacement:
        lost = overdue > F.col("rental_duration") * 2
        fee = fee + F.when(lost, F.col("replacement_cost")).otherwise(0).cast("decimal(18,2)")
    fees = kept.groupBy("customer_id").agg(F.sum(fee).alias("fees"))
    payments = (
        t["payment"].where(F.col("payment_date") <= moment)
        .groupBy("customer_id").agg(F.sum("amount").alias("paid"))
    )
    zero = F.lit(0).cast("decimal(18,2)")
    return (
        t["customer"].select("customer_id")
        .join(fees, "customer_id", "left").join(payments, "customer_id", "left")
        .select(
            "customer_id",
            _money(F.coalesce("fees", zero) - F.coalesce("paid", zero)).alias("balance"),
        )
    )


def rewards_report(
    t: Tables, min_monthly_purchases: int, min_dollar_amount_purchased: float, today: date | str
) -> DataFrame:
    """Customers above both thresholds in the calendar month three months before ``today``."""
    if min_monthly_purchases <= 0:
        raise ValueError("min_monthly_purchases must be above 0")
    if min_dollar_amount_purchased <= 0:
        raise ValueError("min_dollar_amount_purchased must be above 0")
    # A half-open range on the raw column, so the filter reaches partitions and row groups.
    start = F.trunc(F.add_months(F.lit(today).cast("date"), -3), "month")
    month = t["payment"].where(
        (F.col("payment_date") >= start.cast("timestamp_ntz"))
        & (F.col("payment_date") < F.add_months(start, 1).cast("timestamp_ntz"))
    )
    rewarded = (
        month.groupBy("customer_id")
        .agg(F.count("customer_id").alias("n"), F.sum("amount").alias("spent"))
        .where((F.col("n") > min_monthly_purchases) & (F.col("spent") > min_dollar_amount_purchased))
    )
    return semi(t["customer"], rewarded, "customer_id")
