"""Tables that follow changes equal the same tables built from scratch."""

import random
from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tests.test_store_cycle import Shop
from tidemark.operators.deltas import difference
from tidemark.plans import cycle, fact, marts, store

ITEM = "id_order bigint, quantity int, subtotal decimal(10,2)"
PAYMENT = "id_order bigint, payment_method string, payment_status string, payment_date timestamp_ntz, amount decimal(10,2)"


@pytest.fixture
def house(spark, tmp_path):
    return store.Warehouse(spark, str(tmp_path / "house"), buckets=3)


def some(rnd, *values):
    return rnd.choice([*values, None])


def items(rnd, n):
    return [(some(rnd, 1, 2, 3, 4), some(rnd, 1, 2), some(rnd, D("1.50"), D("-1.50"), D("0.00"))) for _ in range(n)]


def payments(rnd, n):
    dates = [datetime(2024, 1, d) for d in (1, 2, 3)]
    return [(some(rnd, 1, 2, 3), some(rnd, "A", "B"), some(rnd, "X", "Y"), some(rnd, *dates), some(rnd, D("5.00"), D("0.00"))) for _ in range(n)]


@pytest.mark.parametrize(
    "make, schema, groups, kept, full",
    [
        (items, ITEM, marts.ITEM_GROUPS, marts.kept_item_totals, marts.order_item_totals),
        (payments, PAYMENT, marts.PAYMENT_GROUPS, marts.kept_payment_totals, marts.payment_totals),
    ],
)
def test_kept_totals_equal_full_ones(spark, rows, make, schema, groups, kept, full):
    rnd = random.Random(7)
    held = make(rnd, 30)
    state = groups.of(spark.createDataFrame(held, schema))
    for step in range(4):
        gone = rnd.sample(held, len(held) if step == 2 else len(held) // 2)
        after = held.copy()
        for row in gone:
            after.remove(row)
        after += make(rnd, 0 if step == 2 else 10)
        old, new = spark.createDataFrame(held, schema), spark.createDataFrame(after, schema)
        delta = groups.changed(old, new)
        assert groups.changed(new, new).isEmpty()
        state = spark.createDataFrame(groups.merged(state, delta).collect(), state.schema)
        assert rows(kept(state)) == rows(full(new))
        assert kept(state).schema.simpleString() == full(new).schema.simpleString()
        held = after


def test_difference_counts_rows(spark, rows):
    old = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    new = spark.createDataFrame([(1, None), (2, "y")], "a int, b string")
    assert rows(difference(old, new)) == sorted([(1, None, -1), (2, "x", -1), (2, "y", 1)], key=repr)


def whole_fact(house, commit):
    """The fact from scratch, by comparing every order with every version."""
    silver = cycle.staged(house, commit)
    return marts.fct_orders(silver["orders"], silver["order_items"], silver["payments"], house.read(fact.CUSTOMERS, commit))


def test_fact_follows_random_changes(house, spark, rows, monkeypatch):
    shop, rnd = Shop(spark), random.Random(11)
    start = datetime(2024, 1, 1)
    clock = datetime(2024, 2, 1)
    rebuilt = []
    rebuild = fact._rebuild
    monkeypatch.setattr(fact, "_rebuild", lambda *a: (rebuilt.append(1), rebuild(*a)))
    for k in range(4, 16):
        shop.rows["orders"][k] = (k, rnd.randint(1, 5), start + timedelta(days=rnd.randint(0, 60)), D("1.00"), D("0.00"), "created", start)
    cycle.run_cycle(house, shop.source(), str(clock))

    def change():
        name = rnd.choice(["customers", "orders", "order_items", "order_items", "payments", "payments"])
        key = rnd.randint(1, {"customers": 5, "orders": 16}.get(name, 25))
        order, when = rnd.randint(1, 17), start + timedelta(days=rnd.randint(0, 90))
        if key in shop.rows[name] and rnd.random() < 0.3:
            return shop.drop(name, key)
        row = {
            "customers": (key, "N", "a@b", "1", "Rua", rnd.choice("xyz"), "sp", "0", start, start),
            "orders": (key, rnd.randint(1, 6), when, D("2.00"), D("0.00"), rnd.choice(("created", "shipped")), when),
            "order_items": (key, order, 1, rnd.randint(0, 3), D("5.00"), D("1.00")),
            "payments": (key, order, rnd.choice(("pix", "card")), "approved", D(rnd.randint(0, 9)), rnd.choice((None, when))),
        }[name]
        return shop.put(name, row)

    for n in (5, 9, 2):
        clock += timedelta(days=9)
        for _ in range(n):
            change()
        commit = cycle.run_cycle(house, shop.source(), str(clock))
        want = rows(whole_fact(house, commit))
        assert rows(house.read(fact.FACT, commit)) == want
        for kept, total, name in ((fact.KEPT[0], marts.order_item_totals, "order_items"), (fact.KEPT[1], marts.payment_totals, "payments")):
            assert rows(kept.totals(house.read(kept.table, commit))) == rows(total(cycle.staged(house, commit)[name]))
    assert len(rebuilt) == 1

    # Nothing changed: the fact keeps its folders. One late price: one bucket of the fact is written.
    idle = cycle.run_cycle(house, shop.source(), str(clock + timedelta(days=1)))
    assert idle.tables[fact.FACT] == commit.tables[fact.FACT]
    shop.put("orders", (3, 3, start, D("1.00"), D("0.00"), "created", start))
    shop.put("order_items", (99, 3, 1, 7, D("5.00"), D("1.00")))
    one = cycle.run_cycle(house, shop.source(), str(clock + timedelta(days=2)))
    before, after = idle.tables[fact.FACT]["slots"], one.tables[fact.FACT]["slots"]
    assert len(fact.changed_buckets(after, before)) == 1
    assert rows(house.read(fact.FACT, one)) == rows(whole_fact(house, one)) and len(rebuilt) == 1

    # Folders that are gone, or a fact made without notes: all is built again.
    house.vacuum(keep=1)
    shop.drop("order_items", 99)
    cycle.run_cycle(house, shop.source(), str(clock + timedelta(days=3)), stages=["ingest"])
    cycle.run_cycle(house, shop.source(), str(clock + timedelta(days=3)), stages=["ingest"])
    house.vacuum(keep=1)
    last = cycle.run_cycle(house, shop.source(), str(clock + timedelta(days=4)))
    assert rows(house.read(fact.FACT, last)) == rows(whole_fact(house, last)) and len(rebuilt) == 2


def test_overlapping_versions_repeat_an_order(house, spark, rows):
    """The dimension may overlap after a repair by hand; the affected orders then repeat as in a whole build."""
    shop = Shop(spark)
    commit = cycle.run_cycle(house, shop.source(), "2024-02-01 00:00:00")
    commit = commit.next()
    dim = house.read(fact.CUSTOMERS, commit)
    twice = dim.unionByName(dim.withColumn("customer_sk", F.concat("customer_sk", F.lit("x"))).filter("customer_id = 2"))
    seen = commit.tables[fact.CUSTOMERS]["seen"]
    house.replace(commit, fact.CUSTOMERS, twice, "customer_id")
    commit.tables[fact.CUSTOMERS]["seen"] = seen
    fact.build_fact(house, commit)
    got = rows(house.read(fact.FACT, commit))
    assert got == rows(whole_fact(house, commit)) and len(got) == 4
