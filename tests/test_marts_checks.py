from datetime import datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tidemark.operators import checks, repairs
from tidemark.plans import marts, snapshots, staging, suite

HISTORY = (
    "id_customer bigint, created_at timestamp_ntz, dbt_scd_id string, dbt_valid_from timestamp_ntz, "
    "dbt_valid_to timestamp_ntz"
)
DIM = "{0}_id bigint, {0}_sk string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"


def day(n):
    return datetime(2020, 1, n)


def test_back_dating(spark):
    rows = [
        (1, day(2), "earlier", day(5), day(9)),
        (1, day(2), "second", day(9), None),
        (2, day(7), "later", day(5), None),
        (3, None, "unknown", day(5), None),
        # The first version is empty: it is dropped before the first start is taken.
        (4, day(1), "empty", day(3), day(3)),
        (4, day(1), "real", day(4), None),
        (5, day(1), "inverted", day(3), day(2)),
    ]
    wide = spark.createDataFrame(rows, HISTORY)
    for name in ("full_name", "email", "cpf", "address", "city", "state", "zip_code"):
        wide = wide.withColumn(name, F.lit("x"))
    wide = wide.withColumn("updated_at", F.col("created_at"))
    got = {r.customer_sk: (r.valid_from, r.is_current) for r in marts.dim_customers(wide).collect()}
    assert got == {
        "earlier": (day(2), False),
        "second": (day(9), True),
        "later": (day(5), True),
        "unknown": (day(5), True),
        "real": (day(1), True),
    }


def fact_inputs(spark):
    orders = spark.createDataFrame(
        [(1, 1, day(5), D("10.00")), (2, 1, day(9), D("20.00")), (3, 2, day(9), D("0.00"))],
        "id_order bigint, id_customer bigint, order_date timestamp_ntz, total_value decimal(10,2)",
    ).selectExpr(
        "*", "total_value as shipping_value", "'CREATED' as current_status", "order_date as updated_at",
        "order_date as _extracted_at",
    )
    items = spark.createDataFrame(
        [(1, 2, D("3.00")), (1, 5, D("4.50"))], "id_order bigint, quantity int, subtotal decimal(10,2)"
    )
    payments = spark.createDataFrame(
        [(2, "PIX", "APPROVED", D("7.00"), day(9)), (2, "BANK_SLIP", "REJECTED", D("1.50"), day(3))],
        "id_order bigint, payment_method string, payment_status string, amount decimal(10,2), payment_date timestamp_ntz",
    )
    dim = spark.createDataFrame(
        [(1, "a", day(5), day(9), False), (1, "b", day(9), None, True)], DIM.format("customer")
    )
    return orders, items, payments, dim


@pytest.mark.parametrize("exclusive", [True, False])
def test_order_fact(spark, exclusive):
    got = {r.order_id: r for r in marts.fct_orders(*fact_inputs(spark), exclusive=exclusive).collect()}
    assert (got[1].customer_sk, got[2].customer_sk, got[3].customer_sk) == ("a", "b", None)
    assert (got[1].order_line_count, got[1].total_quantity, got[1].items_subtotal) == (2, 7, D("7.50"))
    assert (got[2].order_line_count, got[2].total_quantity, got[2].items_subtotal) == (0, 0, D("0.00"))
    assert (got[1].payment_method, got[1].payment_amount, got[1].payment_date) == (None, None, None)
    # Maxima and sum are independent of each other.
    assert (got[2].payment_method, got[2].payment_status) == ("PIX", "REJECTED")
    assert (got[2].payment_amount, got[2].payment_date) == (D("8.50"), day(9))


def test_staging_rounds_after_multiplying(spark):
    raw = spark.createDataFrame(
        [(1, 1, 1, 3, D("0.335"), day(1))],
        "id_item bigint, id_order bigint, id_product bigint, quantity int, unit_price decimal(10,3), _extracted_at timestamp_ntz",
    )
    row = staging.stg_order_items(raw).first()
    assert (row.unit_price, row.subtotal) == (D("0.34"), D("1.01"))


def test_staging_text(spark):
    raw = spark.createDataFrame([(1, " \tA b ", None, day(1))], "id_category bigint, category_name string, description string, _extracted_at timestamp_ntz")
    assert staging.stg_categories(raw).first().category_name == "\tA b"
    columns = ["id_customer", "full_name", "email", "cpf", "address", "city", "state", "zip_code"]
    people = spark.createDataFrame([(1, " N ", " Me@X.COM ", " 1 ", "a", "c", " sp", "z", day(1), day(1), day(1))],
        [*columns, "created_at", "updated_at", "_extracted_at"])
    row = staging.stg_customers(people).first()
    assert (row.full_name, row.email, row.state, row.cpf) == ("N", "me@x.com", " SP", " 1 ")


def test_overflow_raises(spark):
    raw = spark.createDataFrame([(1, 1, 1, 100, D("99999999.00"), day(1))],
        "id_item bigint, id_order bigint, id_product bigint, quantity int, unit_price decimal(10,2), _extracted_at timestamp_ntz")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        staging.stg_order_items(raw).collect()


def test_products_keep_unknown_categories_and_follow_renames(spark):
    products = spark.createDataFrame(
        [(i, f"S{i}", "p", c, D("1.00"), D("1.00"), 1, day(1), day(1), day(1)) for i, c in ((1, 7), (2, 7), (3, 8))],
        "id_product bigint, sku string, product_name string, id_category bigint, sale_price decimal(10,2), "
        "unit_cost decimal(10,2), current_stock int, created_at timestamp_ntz, updated_at timestamp_ntz, _extracted_at timestamp_ntz",
    )

    def categories(name):
        return spark.createDataFrame([(7, name, None)], "id_category bigint, category_name string, description string")

    source = snapshots.products_with_category(products, categories("old"))
    assert {(r.id_product, r.category_name) for r in source.collect()} == {(1, "old"), (2, "old"), (3, None)}
    from tidemark.operators.scd2 import empty_history

    first = snapshots.snapshot_products(empty_history(source), products, categories("old"), day(2))
    second = snapshots.snapshot_products(first, products, categories("new"), day(3))
    assert second.filter("dbt_valid_to is null and dbt_valid_from = timestamp_ntz'2020-01-03'").count() == 2
    assert second.filter("id_product = 3").count() == 1


def test_unique_not_null_relationships(spark, rows):
    df = spark.createDataFrame([(1, None), (1, "a"), (None, "b"), (None, "c"), (2, "a")], "k bigint, v string")
    assert rows(checks.unique(df, "k")) == [(1, 2)]
    assert rows(checks.not_null(df, ["k", "v"])) == [("k", 2), ("v", 1)]
    assert rows(checks.not_null(df.filter("k = 99"), ["k", "v"])) == []
    parent = spark.createDataFrame([(1,)], "id bigint")
    assert rows(checks.relationships(df, "k", parent, "id")) == [(2, 1)]


def staged_tables(spark):
    def frame(text, *values):
        return spark.createDataFrame(list(values), text)

    ok, dates = datetime(2000, 1, 1), ("created_at", "updated_at", "_extracted_at")
    ddl = ", ".join(f"{d} timestamp_ntz" for d in dates)
    years = [datetime(1899, 12, 31, 23, 59, 59), datetime(1900, 1, 1), datetime(2100, 12, 31, 23, 59, 59), datetime(2101, 1, 1), None]
    return {
        "customers": frame(f"id_customer bigint, {ddl}", *[(i, y, ok, ok) for i, y in enumerate(years)]),
        "products": frame(f"id_product bigint, {ddl}", (1, ok, ok, None)),
        "orders": frame(
            "id_order bigint, order_date timestamp_ntz, updated_at timestamp_ntz, _extracted_at timestamp_ntz", (1, ok, None, None)
        ),
        "payments": frame(
            "id_payment bigint, payment_status string, payment_date timestamp_ntz, _extracted_at timestamp_ntz",
            (1, "PENDING", None, ok), (2, "APPROVED", None, ok), (3, None, None, ok), (4, "PENDING", years[0], ok),
        ),
        "order_items": frame("id_item bigint, _extracted_at timestamp_ntz", (1, ok)),
        "categories": frame("id_category bigint, _extracted_at timestamp_ntz", (1, years[3])),
    }


def test_staging_dates(spark, rows):
    assert rows(checks.staging_dates(staged_tables(spark))) == sorted(
        [
            ("stg_customers.created_at", "0"),
            ("stg_customers.created_at", "3"),
            ("stg_customers.created_at", "4"),
            ("stg_products._extracted_at", "1"),
            ("stg_orders.updated_at", "1"),
            ("stg_orders._extracted_at", "1"),
            ("stg_payments.payment_date", "2"),
            ("stg_payments.payment_date", "4"),
            ("stg_categories._extracted_at", "1"),
        ],
        key=repr,
    )


def test_dates_are_one_scan_per_table_and_pushed_down(spark, tmp_path, capsys):
    path = str(tmp_path / "orders")
    staged_tables(spark)["orders"].write.parquet(path)
    tables = {**staged_tables(spark), "orders": spark.read.parquet(path)}
    checks.staging_dates(tables).explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan") == 1
    assert "Or(" in plan.split("PushedFilters: ")[1].split("ReadSchema")[0]


def dims(spark, customers):
    return spark.createDataFrame(customers, DIM.format("customer")), spark.createDataFrame([], DIM.format("product"))


def test_version_checks(spark, rows):
    fine = dims(spark, [(1, "a", day(1), day(5), False), (1, "b", day(5), None, True)])
    for test in (checks.several_current, checks.empty_ranges, checks.overlaps):
        assert rows(test(*fine)) == []
    broken = dims(
        spark,
        [(1, "a", day(1), day(6), True), (1, "b", day(5), None, True), (2, "c", day(4), day(4), False)],
    )
    assert rows(checks.several_current(*broken)) == [("customers", "1")]
    assert rows(checks.empty_ranges(*broken)) == [("customers", "2", day(4), day(4))]
    assert rows(checks.overlaps(*broken)) == [("customers", "1", "a", "b")]


def test_snapshot_dates_ignore_missing(spark, rows):
    ddl = "{0} bigint, dbt_updated_at timestamp_ntz, dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz"
    old = datetime(1800, 1, 1)
    customers = spark.createDataFrame([(1, None, None, None, None, None), (2, old, None, day(1), None, None)], ddl.format("id_customer"))
    products = spark.createDataFrame([(3, day(1), day(1), None, None, old)], ddl.format("id_product"))
    assert rows(checks.snapshot_dates(customers, products)) == [("snapshot_customers", "2"), ("snapshot_products", "3")]


def test_there_are_39_tests():
    assert len(suite.declared_tests()) == len(set(suite.declared_tests())) == 39
    kinds = [n.split(":")[0] for n in suite.declared_tests()]
    assert (kinds.count("unique"), kinds.count("not_null"), kinds.count("relationships")) == (9, 21, 3)
    assert "overlaps" in suite.tests_of("dim_customers", "dim_products")
    assert "gold_dates" not in suite.tests_of("dim_customers", "dim_products")


def test_chosen_tests_only(spark, rows):
    tables = {"stg_orders": spark.createDataFrame([(1,), (1,), (None,)], "id_order bigint")}
    got = suite.run_tests(tables, ["unique:stg_orders.id_order", "not_null:stg_orders.id_order"])
    assert rows(got) == [("not_null:stg_orders.id_order", 1), ("unique:stg_orders.id_order", 1)]
    with pytest.raises(KeyError):
        suite.run_tests(tables, ["no such test"])


def test_created_at_is_lowered_to_the_first_order(spark, rows):
    customers = spark.createDataFrame(
        [(1, day(9), "u"), (2, day(1), "u"), (3, None, "u"), (4, day(9), "u")], "id_customer bigint, created_at timestamp_ntz, x string"
    )
    orders = spark.createDataFrame([(1, day(5)), (1, day(3)), (2, day(5)), (3, day(5))], "id_customer bigint, order_date timestamp_ntz")
    fixed = repairs.backfill_created_at(customers, orders)
    assert rows(fixed) == [(1, day(3), "u"), (2, day(1), "u"), (3, None, "u"), (4, day(9), "u")]


def test_descriptions_follow_the_prefix(spark, rows):
    categories = spark.createDataFrame(
        [(1, "Books 3", None), (2, "Books 4", "stale"), (3, "Books", "new"), (4, "Toys", "t"), (5, "Bookshelf", None)],
        "id_category bigint, category_name string, description string",
    )
    got = repairs.refresh_descriptions(categories, [("Books", "new"), ("Bookshelf", "furniture")])
    assert [r[2] for r in rows(got)] == ["new", "new", "new", "t", "furniture"]


def test_order_totals(spark, rows):
    orders = spark.createDataFrame([(1, D("19.00"), D("12.00")), (2, D("5.00"), D("5.00")), (3, D("9.00"), D("1.00")), (4, None, D("1.00"))],
        "id_order bigint, total_value decimal(10,2), shipping_value decimal(10,2)")
    items = spark.createDataFrame([(1, 2, D("3.50")), (3, 1, D("2.00"))], "id_order bigint, quantity int, unit_price decimal(10,2)")
    assert [r[1] for r in rows(repairs.order_totals(orders, items))] == [D("19.00"), D("5.00"), D("3.00"), D("1.00")]
    assert [r[0] for r in rows(repairs.check_order_total(orders, items))] == [3, 4]


def test_the_key_of_an_item_is_drawn_once_for_all_tests(spark, rows, tmp_path):
    from tidemark.registry import inputs, queries

    start = datetime(1996, 3, 4)
    held = {
        "region": [(0, "EUROPE")],
        "nation": [(0, "FRANCE", 0)],
        "customer": [(k, f"c{k}", 0, 1.0, "M") for k in (1, 2)],
        "part": [(k, f"p{k}", "b", "PROMO TIN", 3, 9.0) for k in (1, 2)],
        "orders": [(k, 1 + k % 2, "F", 8.0, start, "3-MEDIUM") for k in (4, 5)],
        "lineitem": [(k, n, 1, n, 2.0, 8.0, 0.0, 0.0, "N", "O", start) for k in (4, 5) for n in (1, 2)] * 2,
    }
    for name, values in held.items():
        spark.createDataFrame(values, inputs.TABLES[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    tables = queries.tested_tables(spark, str(tmp_path))
    items = tables["stg_order_items"]
    assert rows(items) == rows(staging.stg_order_items(inputs.raw_order_items(spark, str(tmp_path))))
    report = suite.run_tests({n: queries.damaged(df, n) for n, df in tables.items()}, ["unique:stg_order_items.id_item", "staging_dates"])
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "l_linenumber" not in plan


def small_tables(spark, path):
    """One customer's orders with their lines, some lines twice, as the provided tables."""
    from tidemark.registry import inputs

    start = datetime(1996, 3, 4)
    held = {
        "region": [(0, "EUROPE")],
        "nation": [(0, "FRANCE", 0)],
        "customer": [(k, f"c{k}", 0, 1.0, "M") for k in (1, 2)],
        "part": [(k, f"p{k}", "b", "PROMO TIN", 3, 9.0) for k in (1, 2)],
        "orders": [(k, 1 + k % 2, "F", 8.0, start, "3-MEDIUM") for k in (4, 5)],
        "lineitem": [(k, n, 1, n, 2.0, 8.0, 0.0, 0.0, "N", "O", start) for k in (4, 5) for n in (1, 2)] * 2,
    }
    for name, values in held.items():
        spark.createDataFrame(values, inputs.TABLES[name]).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_tested_tables_have_one_copy(spark, tmp_path, monkeypatch):
    """What is built for the kept report is written into its warehouse alone, and damaged there."""
    from tidemark.plans import store, watch
    from tidemark.registry import queries

    sf, put, seen = small_tables(spark, tmp_path / "sf"), [], []
    replace = store.Warehouse.replace
    monkeypatch.setattr(queries, "workspace", lambda _: str(tmp_path / "house"))
    monkeypatch.setattr(queries, "written", lambda df: pytest.fail("a second copy"))
    monkeypatch.setattr(store.Warehouse, "replace", lambda self, commit, name, *a: (put.append((commit.number, name)), replace(self, commit, name, *a)))
    monkeypatch.setattr(watch, "refresh_report", lambda house, commit, watched: seen.append({t: house.read(w.table, commit).count() for t, w in watched.items()}))
    queries.run_tests_kept(spark, sf)
    named = {f"checked/{t}" for t in seen[0]}
    staged = {f"checked/{t}" for t in suite.STAGING_KEYS}
    assert len(named) == 11 and sorted(put) == sorted([*((1, n) for n in named), *((2, n) for n in staged), *((3, n) for n in named - staged)])
    # eight lines are four twice over, and damage doubles order 4's rows elsewhere but none here
    assert seen[0]["stg_order_items"] == 8 and seen[1]["stg_order_items"] >= 8 and seen[1]["fct_orders"] == seen[0]["fct_orders"] == 2
    for name in named:  # what no report asks for any more is gone
        assert len([p for p in (tmp_path / "house" / name).iterdir() if p.is_dir()]) == 1


def test_the_key_of_an_item_is_drawn_once_for_both_runs(spark, rows, tmp_path, monkeypatch):
    from tidemark.plans import cycle
    from tidemark.registry import inputs, queries

    sf, runs = small_tables(spark, tmp_path), []
    monkeypatch.setattr(cycle, "run_cycle", lambda house, source, run_ts: runs.append(source))
    monkeypatch.setattr(queries.store.Warehouse, "read", lambda *a: None)
    queries.fct_orders_follow(spark, sf)
    items = [run.tables["order_items"] for run in runs]
    for frame in (*[t.current for t in items], *[t.log for t in items]):
        assert "l_linenumber" not in frame._jdf.queryExecution().optimizedPlan().toString()
    drawn = inputs.raw_order_items(spark, sf).drop("_extracted_at")
    assert rows(items[1].current) == rows(drawn) and rows(items[0].current) == rows(queries.earlier("order_items", drawn))
