"""Normal forms, denormalised and star tables on the record-shop rows."""

from conftest import rows
from pyspark.sql import functions as F

from lakeloom.functions.exact import total
from lakeloom.operators import modeling
from lakeloom.operators.layout import replicate_counted
from lakeloom.operators.numbering import dense_keys, hashed_key
from lakeloom.sources.tables import inline_rows

SALES = [
    (1, "Amanda", "Sam", 2000, ["Rubber Soul", "Let It Be"]),
    (2, "Toby", "Sam", 2000, ["My Generation"]),
    (3, "Max", "Bob", 2018, ["Meet the Beatles", "Help!"]),
]
SCHEMA = "transaction_id int, customer_name string, cashier_name string, year int, albums array<string>"
LONG = [
    (1, "Amanda", "Sam", 2000, "Let It Be"),
    (1, "Amanda", "Sam", 2000, "Rubber Soul"),
    (2, "Toby", "Sam", 2000, "My Generation"),
    (3, "Max", "Bob", 2018, "Help!"),
    (3, "Max", "Bob", 2018, "Meet the Beatles"),
]


def test_first_normal_form(spark):
    flat = modeling.first_normal_form(inline_rows(spark, SALES, SCHEMA), "albums", "album")
    assert rows(flat) == sorted(LONG, key=repr)


def test_first_normal_form_of_empty_list(spark):
    store = inline_rows(spark, [(4, "Eve", "Bob", 2019, []), (5, "Ada", "Bob", 2019, None)], SCHEMA)
    assert modeling.first_normal_form(store, "albums", "album").count() == 0


def test_down_to_third_normal_form_and_back(spark):
    flat = modeling.first_normal_form(inline_rows(spark, SALES, SCHEMA), "albums", "album", "pos")
    parents, albums = modeling.second_normal_form(flat, "transaction_id", "album", "album_id", "pos")
    assert parents.count() == 3
    assert rows(albums, "album_id", "album") == [
        (1, "Rubber Soul"), (2, "Let It Be"), (3, "My Generation"), (4, "Meet the Beatles"), (5, "Help!"),
    ]
    transactions, employees = modeling.third_normal_form(parents, "cashier_name", "employee_id")
    assert rows(employees) == [(1, "Bob"), (2, "Sam")]
    assert set(transactions.columns) == {"transaction_id", "customer_name", "year", "employee_id"}
    rebuilt = modeling.rebuild(transactions, employees, "employee_id", parents.columns).join(albums, "transaction_id")
    assert rows(rebuilt, "transaction_id", "customer_name", "cashier_name", "year", "album") == sorted(LONG, key=repr)


def test_third_normal_form_keeps_null(spark):
    df = inline_rows(spark, [(1, "a"), (2, None)], "id int, seg string")
    out, values = modeling.third_normal_form(df, "seg", "seg_id")
    assert rows(out) == [(1, 1), (2, None)]
    assert rows(modeling.rebuild(out, values, "seg_id", ["id", "seg"])) == [(1, "a"), (2, None)]


def test_denormalised_amounts(spark):
    transactions = inline_rows(spark, [(1, "Amanda", 2000), (2, "Toby", 2000), (3, "Max", 2018)], "id int, name string, year int")
    sales = inline_rows(spark, [(1, 40), (2, 19), (3, 45)], "id int, amount int")
    assert rows(transactions.join(sales, "id").select("id", "name", "amount")) == [(1, "Amanda", 40), (2, "Toby", 19), (3, "Max", 45)]
    cashier_sales = inline_rows(spark, [(1, "Sam", 40), (2, "Sam", 19), (3, "Bob", 45)], "id int, cashier string, amount int")
    assert rows(cashier_sales.groupBy("cashier").agg(F.sum("amount"))) == [("Bob", 45), ("Sam", 59)]


def test_star_spend(spark):
    facts = inline_rows(spark, [(1, 1, 20.50), (2, 1, 35.21)], "customer_id int, store_id int, amount_spent double")
    customer = inline_rows(spark, [(1, "Amanda", "Y"), (2, "Toby", "N")], "customer_id int, name string, rewards string")
    store = inline_rows(spark, [(1, "CA"), (2, "WA")], "store_id int, state string")
    items = inline_rows(spark, [(1, 1, "Rubber Soul"), (2, 3, "Let It Be")], "customer_id int, item_number int, item_name string")
    star = facts.join(customer, "customer_id").join(store, "store_id").join(items, "customer_id").where("amount_spent > 30")
    assert rows(star.select("name", "store_id", "state", "item_name", "rewards")) == [("Toby", 1, "CA", "Let It Be", "N")]
    spend = facts.where("customer_id = 2").groupBy("customer_id").agg(total("amount_spent", 2))
    assert rows(spend) == [(2, 35.21)]


def test_dense_keys_are_dense_and_ordered(spark):
    df = spark.range(0, 5000, 1, 13).select((F.col("id") * 7919 % 5000).alias("n"))
    keyed = rows(dense_keys(df, ["n"], "k", first=10))
    assert keyed == sorted(((i + 10, i) for i in range(5000)), key=repr)


def test_dense_keys_of_nothing(spark):
    assert dense_keys(spark.range(0), ["id"], "k").count() == 0


def test_hashed_key_tells_parts_apart(spark):
    df = inline_rows(spark, [("ab", "c"), ("a", "bc"), (None, "abc")], "a string, b string")
    assert hashed_key(df, ["a", "b"], "k").select("k").distinct().where("k is not null").count() == 3


def test_date_dimension(spark):
    df = inline_rows(spark, [("2018-11-25 10:00:00",), ("2018-11-25 11:00:00",), ("2018-12-31 00:00:00",), (None,)], "t string")
    dim = modeling.date_dimension(df.select(F.col("t").cast("timestamp").alias("t")), "t")
    found = {r.date_key: r for r in dim.collect()}
    assert sorted(found) == [20181125, 20181231]
    assert found[20181125].is_weekend and not found[20181231].is_weekend
    assert (found[20181231].week, found[20181231].quarter) == (1, 4)


def test_entity_dimension_dates(spark):
    df = inline_rows(spark, [(7, "x"), (3, "y")], "id int, name string")
    dim = modeling.entity_dimension(df, "id", "key", {"name": "name"}, as_of="2024-01-01")
    assert rows(dim.select("key", "id", "name", F.col("start_date").cast("string"), "end_date")) == [
        (1, 3, "y", "2024-01-01", None), (2, 7, "x", "2024-01-01", None),
    ]


def test_replicate_counted_bound(spark):
    df = spark.range(10)
    assert "broadcast" in replicate_counted(df, 10)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in replicate_counted(df, 9)._jdf.queryExecution().logical().toString()
