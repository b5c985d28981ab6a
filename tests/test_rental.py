"""The reports on a few hand-written rows; the large tables are compared with SQL elsewhere."""

import datetime as dt

from decimal import Decimal as D

import pytest

from millrace.plans import rental

T = dt.datetime


@pytest.fixture(scope="module")
def t(spark):
    make = lambda schema, *rows: spark.createDataFrame(list(rows), schema)
    return {
        "category": make("category_id int, name string", (1, "Children"), (2, "Drama")),
        "film": make(
            "film_id int, title string, description string, length int, rental_duration int, rental_rate decimal(4,2), "
            "replacement_cost decimal(5,2), rating string",
            *[(i, f"FILM {c}", "d", 90, 3, D(2), D(20), "G") for i, c in ((1, "A"), (2, "B"), (3, "C"))],
        ),
        "film_category": make("film_id int, category_id int", (1, 1), (2, 1), (3, 2)),
        "actor": make("actor_id int, first_name string, last_name string", (1, "ANN", "LEE"), (2, "BOB", "RAY"), (3, "CY", "NONE")),
        "film_actor": make("actor_id int, film_id int", (1, 1), (1, 2), (2, 2), (1, 3)),
        "inventory": make("inventory_id int, film_id int, store_id int", (1, 1, 1), (2, 2, 1), (3, 2, 2)),
        "rental": make(
            "rental_id int, rental_date timestamp_ntz, inventory_id int, customer_id int, return_date timestamp_ntz",
            (1, T(2022, 1, 1), 1, 1, T(2022, 1, 3)), (2, T(2022, 1, 1, 12), 2, 1, T(2022, 1, 8)), (3, T(2022, 2, 1), 2, 2, None),
        ),
        "payment": make(
            "payment_id int, customer_id int, rental_id int, amount decimal(5,2), payment_date timestamp_ntz",
            (1, 1, 1, D(3), T(2022, 1, 1)), (2, 1, 2, D(4), T(2022, 1, 31, 23, 59)), (3, 2, 3, D(9), T(2022, 2, 1)),
        ),
        "customer": make(
            "customer_id int, store_id int, first_name string, last_name string, address_id int, activebool boolean",
            (1, 1, "DI", "FOX", 1, True), (2, 2, "ED", "GUM", 2, False),
        ),
        "address": make("address_id int, address string, postal_code string, phone string, city_id int", (1, "a1", "p1", "t1", 1), (2, "a2", "p2", "t2", 1)),
        "city": make("city_id int, city string, country_id int", (1, "Lviv", 1)),
        "country": make("country_id int, country string", (1, "Ukraine")),
        "store": make("store_id int, manager_staff_id int, address_id int", (1, 1, 1), (2, 2, 2)),
        "staff": make("staff_id int, first_name string, last_name string, address_id int, store_id int", (1, "M", "One", 1, 1), (2, "M", "Two", 2, 2)),
    }


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_counts_and_top_lists(t):
    assert rows(rental.films_per_category(t)) == [("Children", 2), ("Drama", 1)]
    assert rows(rental.top_actors_by_rentals(t)) == [(1, "ANN", "LEE", 3), (2, "BOB", "RAY", 2)]
    assert rows(rental.top_actors_in_category(t, "Children", 1)) == [(1, "ANN", "LEE", 3)]
    assert rows(rental.top_actors_in_category(t, "Drama")) == []
    assert [r[:1] + (float(r[1]),) for r in rows(rental.top_category_by_payments(t))] == [("Children", 16.0)]
    assert rows(rental.films_without_inventory(t)) == [(3, "FILM C")]


def test_late_rentals(t):
    assert rows(rental.late_rentals(t, "2022-03-01")) == [(3, "GUM, ED", "t2", "FILM B")]
    assert rows(rental.late_rentals(t, "2022-02-01")) == []


def test_views(t):
    info = {r["actor_id"]: r["film_info"] for r in rental.actor_info(t).collect()}
    assert info == {1: "Children: FILM A, FILM B, Drama: FILM C", 2: "Children: FILM B", 3: None}
    assert sorted(rows(rental.customer_list(t)))[1] == (2, "ED GUM", "a2", "p2", "t2", "Lviv", "Ukraine", "", 2)
    assert sorted(rows(rental.staff_list(t)))[0] == (1, "M One", "a1", "p1", "t1", "Lviv", "Ukraine", 1)
    films = {r["fid"]: (r["category"], r["actors"]) for r in rental.film_list(t).collect()}
    assert films[2] == ("Children", "ANN LEE, BOB RAY")
    assert {r["fid"]: r["actors"] for r in rental.film_list_recased(t).collect()}[2] == "AnnLee, BobRay"
    assert [(s, m, float(x)) for s, m, x in rows(rental.sales_by_store(t))] == [("Lviv,Ukraine", "M One", 16.0)]


def test_stock(t):
    assert sorted(rows(rental.inventory_in_stock(t))) == [(1, True), (2, False), (3, True)]
    assert [r[2] for r in rows(rental.film_stock(t, film_id=2))] == [3]
    assert [r[2] for r in rows(rental.film_stock(t, 2, 1, in_stock=False))] == [2]
    assert rows(rental.inventory_held_by(t)) == [(2, 2)]
    assert rows(rental.inventory_held_by(t, 1)) == []


def test_customer_balance(t):
    got = {r[0]: float(r[1]) for r in rows(rental.customer_balance(t, "2022-12-31"))}
    # Two rentals at 2.00; the second was kept 6 days and 12 hours, three whole days too long.
    assert got == {1: 4 + 3 - 7, 2: 2 - 9}
    early = {r[0]: float(r[1]) for r in rows(rental.customer_balance(t, "2022-01-01 06:00:00"))}
    assert early == {1: 2 - 3, 2: 0}


def test_replacement_is_charged_on_request(t, spark):
    long = dict(t, rental=t["rental"].unionAll(spark.createDataFrame(
        [(4, T(2022, 1, 1), 3, 2, T(2022, 3, 1))], t["rental"].schema)))
    plain, charged = ({r[0]: float(r[1]) for r in rows(rental.customer_balance(long, "2022-12-31", flag))} for flag in (False, True))
    assert charged[2] - plain[2] == 20 and charged[1] == plain[1]


def test_rewards_report(t):
    assert [r["customer_id"] for r in rental.rewards_report(t, 1, 6.5, "2022-04-30").collect()] == [1]
    assert rows(rental.rewards_report(t, 2, 6.5, "2022-04-30")) == []
    assert rows(rental.rewards_report(t, 1, 6.5, "2022-05-01")) == []
    for bad in ((0, 1), (1, 0)):
        with pytest.raises(ValueError):
            rental.rewards_report(t, *bad, "2022-04-30")
