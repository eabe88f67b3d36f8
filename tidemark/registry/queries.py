"""One query per operator, each over the whole of the provided tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import ntz, version_key
from tidemark.functions.types import SOURCE_TYPES, cast_to_source_types, map_type
from tidemark.operators import checks, conform, digests, merge, repairs, scd2
from tidemark.operators.skew import Cuts, find_cuts
from tidemark.plans import bucketed, cycle, fact, marts, snapshots, staging, store, suite, watch
from tidemark.registry import inputs
from tidemark.session import shared_dir, written
from tidemark.sources import entities, landing, versions
from tidemark.streaming.feed import file_feed, start_cdc

Query = Callable[[SparkSession, str], DataFrame]
RUN_TS = "2024-03-01 10:20:30.123456"
CUT_TS = "1998-06-01 00:00:00"
FIRST_RUN, SECOND_RUN = "2000-01-01 00:00:00", "2000-07-01 00:00:00"
# Two prefixes overlap on purpose: the later pair wins.
DESCRIPTIONS = (("S", "small or standard"), ("ST", "standard goods"), ("PROMO", "on offer"))

# What is done to a table before all tests run over it: rows that come twice, and columns replaced.
DAMAGE: dict[str, tuple[str, dict[str, str]]] = {
    "stg_customers": (
        "id_customer % 41 = 3",
        {"id_customer": "if(id_customer % 50 = 7, null, id_customer)", "updated_at": "if(id_customer % 53 = 9, null, updated_at)"},
    ),
    "stg_categories": ("category_name like 'S%'", {"id_category": "if(category_name like 'P%', null, id_category)"}),
    "stg_products": ("id_product % 37 = 5", {"id_product": "if(id_product % 43 = 1, null, id_product)"}),
    "stg_orders": (
        "id_order % 97 = 11",
        {"id_order": "if(id_order % 89 = 4, null, id_order)", "order_date": "if(id_order % 31 = 3, null, order_date)"},
    ),
    "stg_order_items": ("id_item % 101 = 2", {"id_item": "if(id_item % 103 = 6, null, id_item)"}),
    "stg_payments": (
        "id_payment % 61 = 8",
        {"id_payment": "if(id_payment % 67 = 3, null, id_payment)", "payment_date": "if(id_payment % 59 = 3, null, payment_date)"},
    ),
    "snapshot_customers": (
        "false", {"created_at": "if(id_customer % 47 = 2, created_at - interval 200 years, created_at)"},
    ),
    "snapshot_products": (
        "false", {"dbt_valid_from": "if(id_product % 47 = 2, dbt_valid_from + interval 200 years, dbt_valid_from)"},
    ),
    "dim_customers": (
        "customer_sk like 'a1%'",
        {
            "customer_sk": "if(customer_sk like 'b%', null, customer_sk)",
            "customer_id": "if(customer_sk like 'c%', null, customer_id)",
            "email": "if(customer_sk like 'd%', null, email)",
            "valid_from": "if(customer_sk like 'e%', null, valid_from)",
            "valid_to": "if(customer_sk like '1%', valid_from, if(customer_sk like '2%', valid_to + interval 90 days, valid_to))",
            "is_current": "if(customer_sk like 'f%', null, is_current or customer_sk like '3%' or customer_sk like '4%')",
        },
    ),
    "dim_products": (
        "product_sk like 'a1%'",
        {
            "product_sk": "if(product_sk like 'b%', null, product_sk)",
            "product_id": "if(product_sk like 'c%', null, product_id)",
            "sku": "if(product_sk like 'd%', null, sku)",
            "category_id": "if(product_sk like 'e%', null, category_id)",
            "valid_from": "if(product_sk like 'f%', null, valid_from)",
            "valid_to": "if(product_sk like '1%', valid_from, if(product_sk like '2%', valid_to + interval 9 days, valid_to))",
            "is_current": "if(product_sk like '3%', null, is_current or product_sk like '4%' or product_sk like '5%')",
        },
    ),
    "fct_orders": (
        "order_id % 83 = 4",
        {
            "order_id": "if(order_id % 71 = 5, null, order_id)",
            "customer_id": "if(order_id % 73 = 1, null, customer_id)",
            "order_total": "if(order_id % 79 = 2, null, order_total)",
            "order_date": "if(order_id % 29 = 3, null, order_date)",
        },
    ),
}

# What a source looked like before a run: rows not there yet, rows that were different, and rows that have gone since.
EARLIER: dict[str, tuple[str, str, dict[str, str], str]] = {
    "orders": (
        "id_order % 9 = 4",
        "id_order % 8 = 1",
        {"current_status": "'pending'", "order_date": "order_date + interval 40 days"},
        "id_order % 10 = 3",
    ),
    "order_items": ("id_item % 5 = 0", "id_item % 7 = 1", {"quantity": "quantity + 1"}, "id_item % 11 = 2"),
    "payments": (
        "id_payment % 6 = 1",
        "id_payment % 7 = 2",
        {"payment_method": "'zzz'", "payment_date": "payment_date + interval 1 year"},
        "id_payment % 11 = 4",
    ),
}

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# -- shared inputs --------------------------------------------------------------


def workspace(spark: SparkSession) -> str:
    """A fresh folder for one query's tables."""
    return f"{shared_dir(spark)}/{landing.new_run_id()}"


def staged(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    return {name: staging.STAGING[name](inputs.RAW[name](spark, sf)) for name in names or inputs.RAW}


def tracked_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Raw customers, created no later than their first order."""
    return repairs.backfill_created_at(inputs.raw_customers(spark, sf), inputs.raw_orders(spark, sf))


def customer_cuts(spark: SparkSession, sf: str) -> Cuts | None:
    """Cuts that fit the feed, the versions it makes, and the orders (all have one time axis)."""
    feed = inputs.customer_feed(spark, sf).select("id_customer", "change_ts")
    orders = inputs.raw_orders(spark, sf).select("id_customer", "order_date")
    return find_cuts(feed.unionAll(orders), "id_customer", "change_ts")


def customer_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Staged customers as a feed: the segment of each change takes the place of the state."""
    rows = staging.stg_customers(tracked_customers(spark, sf)).drop("state")
    joined = inputs.customer_feed(spark, sf).withColumnRenamed("segment", "state").join(rows, "id_customer")
    return joined.select(*staging_columns("customers"), "change_ts", "change_version", "op")


def staging_columns(name: str) -> list[str]:
    return [*(f.name for f in entities.ENTITIES[name].raw_schema.fields)]


def customer_history(spark: SparkSession, sf: str, cuts: Cuts | None = None) -> DataFrame:
    return scd2.scd2_fold(customer_changes(spark, sf), "id_customer", snapshots.CUSTOMER_CHECKS, cuts=cuts)


def product_history(spark: SparkSession, sf: str, cuts: Cuts | None = None) -> DataFrame:
    rows = snapshot_input_products(spark, sf)
    joined = inputs.product_feed(spark, sf).join(rows.drop("sale_price"), "id_product")
    feed = joined.select(*rows.columns, "change_ts", "change_version", "op")
    return scd2.scd2_fold(feed, "id_product", snapshots.PRODUCT_CHECKS, cuts=cuts)


def product_cuts(spark: SparkSession, sf: str) -> Cuts | None:
    lines = inputs.table(spark, sf, "lineitem").select("l_partkey", "l_shipdate")
    return find_cuts(lines, "l_partkey", "l_shipdate")


def state_at(feed: DataFrame, cut: str | None = None) -> DataFrame:
    """Rows alive after the changes up to a cut, in feed order."""
    seen = feed if cut is None else feed.filter(F.col("change_ts") < ntz(cut))
    newest = merge.latest_per_key(seen, ["id_customer"], ["change_ts", "change_version"])
    return newest.filter("op <> 'D'").drop("op")


def batch_after(feed: DataFrame, cut: str) -> DataFrame:
    later = feed.filter(F.col("change_ts") >= ntz(cut))
    newest = merge.latest_per_key(later, ["id_customer"], ["change_ts", "change_version"])
    return newest.withColumnRenamed("op", entities.OPERATION)


def unmarked(feed: DataFrame, op: str = "op") -> DataFrame:
    """A feed in which some changes, deletions among them, do not say what they are."""
    return feed.withColumn(op, F.when(F.col("change_version") % 7 != 3, F.col(op)))


def earlier(name: str, rows: DataFrame) -> DataFrame:
    """A raw table as it was before a run, from its rows after it."""
    key = entities.ENTITIES[name].key
    missing, different, replaced, gone = EARLIER[name]
    values = {c: F.when(F.expr(different), F.expr(v)).otherwise(F.col(c)) for c, v in replaced.items()}
    return rows.filter(f"not ({missing})").withColumns(values).unionByName(rows.filter(gone).withColumn(key, -F.col(key) - 1))


def changes_since(name: str, rows: DataFrame, version: int) -> DataFrame:
    """The log that leads from :func:`earlier` to the table as it is."""
    key = entities.ENTITIES[name].key
    missing, different, _, gone = EARLIER[name]
    at = F.lit(version).cast("bigint").alias("change_version")
    op = F.when(F.expr(missing), "I").otherwise("U").alias("op")
    log = rows.filter(f"({missing}) or ({different})").select(key, at, op)
    return log.unionByName(rows.filter(gone).select((-F.col(key) - 1).alias(key), at, F.lit("D").alias("op")))


# -- sources, sinks, shaping ------------------------------------------------------


@query
def source_schema(spark, sf):
    """Columns of a source table in their order, and how many values each holds."""
    source = inputs.raw_payments(spark, sf)
    shouting = source.toDF(*[c.upper() for c in source.columns])
    held = shouting.agg(*[F.count(c).alias(c.lower()) for c in shouting.columns])
    counts = held.unpivot([], held.columns, "column_name", "n_values")
    return entities.schema_rows(shouting).join(counts, "column_name")


@query
def map_source_types(spark, sf):
    """Every type of the map, and some beyond it, each over a column that fits it."""
    fits = {T.TimestampNTZType(): "ts", T.StringType(): "cast(ts as string)", T.BinaryType(): "props", T.BooleanType(): "event_id % 2"}
    kinds = {**{name: (name,) for name in SOURCE_TYPES}, "decimal_18_4": ("decimal", 18, 4), "nvarchar": ("nvarchar",), "xml": ("xml",)}
    source = inputs.table(spark, sf, "events").selectExpr(
        "event_id", *[f"{fits.get(map_type(*spec), 'event_id % 100')} as as_{name}" for name, spec in kinds.items()]
    )
    typed = cast_to_source_types(source, {"event_id": ("bigint",), **{f"as_{name}": spec for name, spec in kinds.items()}})
    # bytes are shown as hexadecimal digits, which any client prints alike
    return typed.select([F.hex(c).alias(c) if t == "binary" else F.col(c) for c, t in typed.dtypes])


@query
def ensure_layers(spark, sf):
    """Layers made twice, the second time to no effect, and a first batch merged into an empty table."""
    house = store.Warehouse(spark, workspace(spark), buckets=8)
    store.ensure_layers(house)
    commit = store.ensure_layers(house).next()
    batch = conform.load_by_name(inputs.raw_payments(spark, sf), entities.ENTITIES["payments"].raw_schema)
    house.merge_into(commit, "bronze/raw_payments", entities.full_extract(batch), "id_payment")
    return house.read("bronze/raw_payments", house.publish(commit))


@query
def route_layer(spark, sf):
    """The same totals in a named layer and in the default one."""
    house, out = store.Warehouse(spark, workspace(spark)), None
    totals = marts.order_item_totals(staging.stg_order_items(inputs.raw_order_items(spark, sf)))
    for custom in ("  gold ", None):
        layer = store.layer_name(custom)
        rows = store.replace_table(house, f"{layer}/order_item_totals", totals).withColumn("layer", F.lit(layer))
        out = rows if out is None else out.unionAll(rows)
    return out


@query
def full_extract(spark, sf):
    return entities.full_extract(inputs.raw_orders(spark, sf))


@query
def incremental_extract(spark, sf):
    feed = inputs.customer_feed(spark, sf)
    upper, oldest = merge.read_bounds(feed)
    newest = merge.latest_per_key(feed, ["id_customer"], ["change_version"])
    source = inputs.raw_customers(spark, sf).join(newest.filter("op = 'D'"), "id_customer", "left_anti")
    return entities.incremental_extract(feed, source, "id_customer", (upper + oldest) // 2, upper)


@query
def stamp_extracted_at(spark, sf):
    return conform.with_extracted_at(inputs.raw_orders(spark, sf), RUN_TS)


@query
def normalize_timestamps(spark, sf):
    local = F.date_format("ts", conform.ISO_MICROS)
    zoned = F.when(F.col("event_type") == "click", F.concat(local, F.lit("+02:00"))).otherwise(local)
    events = inputs.table(spark, sf, "events").select("event_id", zoned.alias("at"))
    return conform.normalize_ts(events, ["at"]).withColumn("at_text", conform.iso_text(F.col("at")))


@query
def land_parquet(spark, sf):
    path, _ = landing.land(inputs.raw_payments(spark, sf), workspace(spark), "payments", landing.new_run_id())
    return spark.read.parquet(path)


@query
def conform_columns(spark, sf):
    lacking = inputs.raw_orders(spark, sf).drop("updated_at", "_extracted_at").withColumn("surplus", F.lit(1))
    return conform.conform(lacking, entities.ENTITIES["orders"].schema)


@query
def load_by_name(spark, sf):
    raw = inputs.raw_payments(spark, sf)
    shuffled = raw.select(*[F.col(c).alias(c.upper()) for c in reversed(raw.columns)])
    path, rows = landing.land(shuffled, workspace(spark), "payments", landing.new_run_id())
    return landing.load(spark, path, entities.ENTITIES["payments"].raw_schema, expected=rows)


@query
def reconcile_counts(spark, sf):
    root, out = workspace(spark), None
    for name, raw in inputs.RAW.items():
        path, extracted = landing.land(raw(spark, sf), root, name, landing.new_run_id())
        counted = spark.read.parquet(path).agg(F.count("*").alias("loaded"))
        row = counted.select(F.lit(name).alias("table_name"), F.lit(extracted).cast("bigint").alias("extracted"), "loaded")
        out = row if out is None else out.unionAll(row)
    return out


def text_hash(columns) -> Column:
    """A number drawn from a row's text, which any database can work out too."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


@query
def reconcile_content(spark, sf):
    """Content digests of tables as extracted, as landed and as merged into a table that held some of them."""
    house, out = store.Warehouse(spark, workspace(spark), buckets=8), None
    commit = house.head().next()
    for name in ("categories", "order_items", "payments"):
        entity, raw = entities.ENTITIES[name], inputs.RAW[name](spark, sf)
        path, seen = landing.land_digested(entities.full_extract(raw), house.root, name, landing.new_run_id())
        landed = spark.read.parquet(path)
        digests.assert_same(seen, digests.digest_of(landed))
        house.replace(commit, name, raw.filter(F.pmod(entity.key, F.lit(3)) == 1), entity.key)
        house.merge_into(commit, name, landed, entity.key)
        cycle.reconcile_merged(house, commit, name, landed, entity.key)
        for stage, rows in (("landed", landed), ("merged", house.read(name, commit))):
            counted = rows.agg(*digests.digest_columns(text_hash(raw.columns)))
            total = F.col("total").cast("decimal(38,0)").alias("total")
            row = counted.select(F.lit(name).alias("table_name"), F.lit(stage).alias("stage"), "rows", total, "mixed")
            out = row if out is None else out.unionAll(row)
    return out


@query
def drop_landing(spark, sf):
    root, raw = workspace(spark), inputs.raw_payments(spark, sf)
    first, _ = landing.land(raw, root, "payments", landing.new_run_id())
    landing.land(raw, root, "payments", landing.new_run_id())
    landing.purge(spark, first)
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/landing/payments")


@query
def bronze_sources(spark, sf):
    root, out = workspace(spark), None
    for name, raw in inputs.RAW.items():
        typed = conform.load_by_name(raw(spark, sf), entities.ENTITIES[name].raw_schema)
        path, _ = landing.land(typed, root, name, landing.new_run_id())
        key = F.col(entities.ENTITIES[name].key)
        read = entities.bronze(spark, path, name).agg(F.count("*").alias("n_rows"), F.max(key).alias("last_key"))
        row = read.select(F.lit(entities.ENTITIES[name].raw_name).alias("table_name"), "n_rows", "last_key")
        out = row if out is None else out.unionAll(row)
    return out


@query
def materialize_view(spark, sf):
    staging.create_views({name: raw(spark, sf) for name, raw in inputs.RAW.items()})
    return spark.sql(
        """
        select p.category_name, count(*) as n_lines, cast(sum(i.subtotal) as decimal(20,2)) as sold
        from stg_order_items i
        join (select id_product, category_name from stg_products join stg_categories using (id_category)) p
          using (id_product)
        group by p.category_name
        """
    )


@query
def materialize_table(spark, sf):
    house = store.Warehouse(spark, workspace(spark))
    payments = staging.stg_payments(inputs.raw_payments(spark, sf))
    store.replace_table(house, "gold/payment_totals", marts.payment_totals(payments.filter("payment_status = 'PENDING'")))
    return store.replace_table(house, "gold/payment_totals", marts.payment_totals(payments))


# -- merge and ingestion state ------------------------------------------------------


@query
def version_bounds(spark, sf):
    feeds = {"customers": inputs.customer_feed(spark, sf), "products": inputs.product_feed(spark, sf)}
    rows = [merge.version_bounds(f).select(F.lit(n).alias("table_name"), "upper", "min_valid") for n, f in feeds.items()]
    return rows[0].unionAll(rows[1])


def region_watermarks(spark, sf, later: bool = False) -> DataFrame:
    """Newest order per nation before the cut, or after it, standing in for table versions."""
    orders = inputs.table(spark, sf, "orders")
    side = F.col("o_orderdate") >= ntz(CUT_TS) if later else F.col("o_orderdate") < ntz(CUT_TS)
    homes = inputs.table(spark, sf, "customer").join(
        inputs.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    placed = orders.filter(side).join(homes, F.col("o_custkey") == F.col("c_custkey"))
    return placed.groupBy(F.col("n_name").alias("table_name")).agg(F.max("o_orderkey").alias("last_sync_version"))


@query
def read_watermark(spark, sf):
    """Watermarks as a commit holds them; a table that was never synced has none."""
    house = store.Warehouse(spark, workspace(spark))
    commit = house.head().next()
    commit.watermarks = {r["table_name"]: r["upper"] for r in version_bounds(spark, sf).collect()}
    house.publish(commit)
    rows = [
        merge.watermark(house.watermarks(), name).select(F.lit(name).alias("table_name"), "last_sync_version")
        for name in ("customers", "products", "payments")
    ]
    return rows[0].unionAll(rows[1]).unionAll(rows[2])


@query
def refresh_decision(spark, sf):
    at = F.col("change_version")
    seen = inputs.customer_feed(spark, sf).groupBy("id_customer").agg(
        F.min(F.when(F.col("op") == "I", at)).alias("last_version"),
        F.min(F.when(F.col("segment") == "F", at)).alias("min_valid"),
        F.max(F.when(F.col("op") != "I", at)).alias("upper"),
    )
    decided = merge.refresh_decision(F.col("last_version"), F.col("min_valid"), F.col("upper"))
    return seen.withColumn("full_refresh", decided)


@query
def dedupe_keep_last(spark, sf):
    return merge.latest_per_key(inputs.customer_feed(spark, sf), ["id_customer", "change_ts"], ["change_version"])


@query
def merge_changes(spark, sf):
    feed = inputs.customer_feed(spark, sf)
    batch = unmarked(batch_after(feed, CUT_TS), entities.OPERATION)
    return merge.merge(state_at(feed, CUT_TS), batch, "id_customer")


@query
def full_refresh_merge(spark, sf):
    """The batch holds every change of a key that is alive, as a split read may bring a key twice."""
    feed = inputs.customer_feed(spark, sf)
    batch = entities.full_extract(feed.drop("op").join(state_at(feed).select("id_customer"), "id_customer", "left_semi"))
    return merge.full_refresh(state_at(feed, CUT_TS), batch, "id_customer", ["change_ts", "change_version"])


@query
def upsert_watermark(spark, sf):
    return merge.advance(region_watermarks(spark, sf), region_watermarks(spark, sf, later=True))


@query
def noop_advance(spark, sf):
    feed = inputs.customer_feed(spark, sf)
    upper, _ = merge.read_bounds(feed)
    state = region_watermarks(spark, sf)
    nothing = feed.filter(F.col("change_version") > upper).withColumnRenamed("op", entities.OPERATION)
    later = region_watermarks(spark, sf, later=True)
    target, moved = merge.advance_if_empty(state_at(feed), state, nothing, "id_customer", later)
    return target.unionByName(moved, allowMissingColumns=True)


@query
def atomic_commit(spark, sf):
    """A merge published with its watermark, then a second one that fails before publishing."""
    house, feed = store.Warehouse(spark, workspace(spark)), inputs.customer_feed(spark, sf)
    commit = house.head().next()
    house.replace(commit, "bronze/segments", state_at(feed, CUT_TS), "id_customer")
    house.publish(commit)
    commit = house.head().next()
    house.merge_into(commit, "bronze/segments", batch_after(feed, CUT_TS), "id_customer")
    commit.watermarks["segments"] = merge.read_bounds(feed)[0]
    house.publish(commit)
    lost = house.head().next()
    house.replace(lost, "bronze/segments", feed.drop("op"), "id_customer")
    lost.watermarks["segments"] = -1
    seen = house.head()
    return house.read("bronze/segments", seen).withColumn("watermark", F.lit(seen.watermarks["segments"]).cast("bigint"))


def test_source(spark, sf, customers: DataFrame | None = None, log=None, version: int = 1) -> cycle.Source:
    tables = {name: cycle.SourceTable(raw(spark, sf).drop("_extracted_at")) for name, raw in inputs.RAW.items()}
    if customers is not None:
        tables["customers"] = cycle.SourceTable(customers, log, min_valid=0)
    return cycle.Source(tables, version)


@query
def ingest_all(spark, sf):
    house = store.Warehouse(spark, workspace(spark), buckets=8)
    commit = store.ensure_layers(house).next()
    cycle.ingest_all(house, commit, test_source(spark, sf, version=7), RUN_TS)
    house.publish(commit)
    out = None
    for name, entity in entities.ENTITIES.items():
        rows = house.read(f"bronze/{entity.raw_name}").agg(F.count("*").alias("n_rows"), F.max("_extracted_at").alias("stamp"))
        row = rows.select(F.lit(name).alias("table_name"), "n_rows", "stamp")
        out = row if out is None else out.unionAll(row)
    return out.join(house.watermarks(), "table_name")


@query
def cdc_stream(spark, sf):
    """The feed replayed year by year, each arrival merged by one run of the stream."""
    root = workspace(spark)
    house = store.Warehouse(spark, root, buckets=8)
    feed = unmarked(inputs.customer_feed(spark, sf))
    commit = house.head().next()
    house.create(commit, "bronze/segments", feed.drop("op").schema)
    house.publish(commit)
    first, last = feed.agg(F.year(F.min("change_ts")), F.year(F.max("change_ts"))).first()
    for year in range(first, last + 1):
        # bounds on the stored column, which Parquet can skip by
        within = (F.col("change_ts") >= ntz(f"{year}-01-01 00:00:00")) & (F.col("change_ts") < ntz(f"{year + 1}-01-01 00:00:00"))
        feed.filter(within).write.mode("append").parquet(f"{root}/arrivals")
        arrivals = file_feed(spark, f"{root}/arrivals", feed.schema, files_per_batch=1_000_000)
        start_cdc(
            arrivals, house, "segments", "id_customer", ["change_ts", "change_version"], f"{root}/progress"
        ).awaitTermination()
    return house.read("bronze/segments")


@query
def cdc_versions(spark, sf):
    """A change table followed by version: half of it, then, after a stop, the other half."""
    root = workspace(spark)
    house, feed = store.Warehouse(spark, root, buckets=8), inputs.customer_feed(spark, sf)
    upper, oldest = merge.read_bounds(feed)
    first, middle = oldest + (upper - oldest) // 4, (upper + oldest) // 2
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in feed.schema)

    def alive() -> DataFrame:
        newest = merge.latest_per_key(feed.filter(F.col("change_version") <= first), ["id_customer"], ["change_version"])
        return newest.filter("op <> 'D'").drop("op")

    for low, high in ((oldest - 1, first), (first, middle), (middle, upper)):
        part = feed.filter((F.col("change_version") > low) & (F.col("change_version") <= high))
        part.write.mode("append").parquet(f"{root}/changes")
        query = versions.follow_versions(
            house, "segments", "id_customer", f"{root}/changes", columns, alive, f"{root}/progress", step=max(1, (upper - oldest) // 12)
        )
        query.awaitTermination()
    return house.read("bronze/segments")


@query
def merge_changes_bucketed(spark, sf):
    """The same merge over tables that are bucketed by their key, so that nothing is exchanged."""
    root, feed = workspace(spark), inputs.customer_feed(spark, sf)
    batch = unmarked(batch_after(feed, CUT_TS), entities.OPERATION)
    sides = {"target": state_at(feed, CUT_TS), "batch": batch}
    saved = {n: bucketed.save_bucketed(df, f"{n}_{landing.new_run_id()}", "id_customer", 8, f"{root}/{n}") for n, df in sides.items()}
    return merge.merge(saved["target"], saved["batch"], "id_customer")


# -- staging ------------------------------------------------------------------------


def _staging_query(name: str) -> None:
    def build(spark, sf):
        return staging.STAGING[name](inputs.RAW[name](spark, sf))

    QUERIES[f"stg_{name}"] = build


for _name in inputs.RAW:
    _staging_query(_name)


# -- history ------------------------------------------------------------------------


@query
def snapshot_customers(spark, sf):
    return customer_history(spark, sf, customer_cuts(spark, sf))


@query
def snapshot_products(spark, sf):
    return product_history(spark, sf, product_cuts(spark, sf))


@query
def scd2_apply(spark, sf):
    feed = inputs.customer_feed(spark, sf).withColumnRenamed("segment", "state")
    before, after = state_at(feed, CUT_TS), state_at(feed)
    first = scd2.scd2_apply(scd2.empty_history(before), before, "id_customer", ["state"], FIRST_RUN)
    return scd2.scd2_apply(first, after, "id_customer", ["state"], SECOND_RUN)


@query
def scd2_apply_changed(spark, sf):
    """The same two runs, each moving rows of changed keys only."""
    feed = inputs.customer_feed(spark, sf).withColumnRenamed("segment", "state")
    history = None
    for cut, run_ts in ((CUT_TS, FIRST_RUN), (None, SECOND_RUN)):
        alive = state_at(feed, cut).withColumn(scd2.DIGEST, scd2.check_digest(["state"]))
        history = scd2.empty_history(alive) if history is None else written(history)
        history = scd2.scd2_apply(history, alive, "id_customer", ["state"], run_ts, step=scd2.scd2_step_changed)
    return history.drop(scd2.DIGEST)


@query
def scd2_fold(spark, sf):
    feed = inputs.customer_feed(spark, sf)
    return scd2.scd2_fold(feed, "id_customer", ["segment"], cuts=customer_cuts(spark, sf))


@query
def scd2_keys(spark, sf):
    feed = inputs.customer_feed(spark, sf).select("id_customer", "change_ts").distinct()
    return feed.withColumn("version_key", version_key(["id_customer"], "change_ts"))


@query
def snapshot_input_products(spark, sf):
    return snapshots.products_with_category(
        staging.stg_products(inputs.raw_products(spark, sf)), staging.stg_categories(inputs.raw_categories(spark, sf))
    )


# -- marts --------------------------------------------------------------------------


def customer_dimension(spark, sf, cuts: Cuts | None) -> DataFrame:
    return marts.dim_customers(customer_history(spark, sf, cuts), hot_keys=cuts is not None)


@query
def dim_customers(spark, sf):
    return customer_dimension(spark, sf, customer_cuts(spark, sf))


def product_dimension(spark, sf, cuts: Cuts | None) -> DataFrame:
    return marts.dim_products(product_history(spark, sf, cuts), hot_keys=cuts is not None)


@query
def dim_products(spark, sf):
    return product_dimension(spark, sf, product_cuts(spark, sf))


@query
def backdate_first_version(spark, sf):
    dated = marts.backdate_first_version(written(snapshot_customers(spark, sf)), "id_customer")
    return dated.select("id_customer", "created_at", "dbt_valid_from", "dbt_valid_to", "valid_from")


@query
def order_item_totals(spark, sf):
    return marts.order_item_totals(staging.stg_order_items(inputs.raw_order_items(spark, sf)))


@query
def payment_totals(spark, sf):
    return marts.payment_totals(staging.stg_payments(inputs.raw_payments(spark, sf)))


def kept_totals(spark, sf, name: str, groups: marts.Groups, totals) -> DataFrame:
    """Totals of a table as it was, brought up to the table as it is by what changed."""
    raw = inputs.RAW[name](spark, sf)
    old, new = [staging.STAGING[name](rows) for rows in (earlier(name, raw), raw)]
    return totals(groups.merged(written(groups.of(old)), groups.changed(old, new)))


@query
def order_item_totals_kept(spark, sf):
    return kept_totals(spark, sf, "order_items", marts.ITEM_GROUPS, marts.kept_item_totals)


@query
def payment_totals_kept(spark, sf):
    return kept_totals(spark, sf, "payments", marts.PAYMENT_GROUPS, marts.kept_payment_totals)


@query
def asof_customer_version(spark, sf):
    orders = staging.stg_orders(inputs.raw_orders(spark, sf)).select("id_order", "id_customer", "order_date")
    cuts = customer_cuts(spark, sf)
    customers = customer_dimension(spark, sf, cuts)
    return marts.asof_customer_version(orders, customers, cuts, exclusive=True)


@query
def range_join_versions(spark, sf):
    """The same join by comparing ranges, as used when versions may overlap."""
    orders = staging.stg_orders(inputs.raw_orders(spark, sf)).select("id_order", "id_customer", "order_date")
    cuts = customer_cuts(spark, sf)
    customers = doubled(customer_dimension(spark, sf, cuts), "customer_sk")
    return marts.asof_customer_version(orders, customers, cuts)


@query
def fct_orders(spark, sf):
    cuts = customer_cuts(spark, sf)
    customers = customer_dimension(spark, sf, cuts)
    rows = staged(spark, sf, "orders", "order_items", "payments")
    return marts.fct_orders(rows["orders"], rows["order_items"], rows["payments"], customers, cuts, exclusive=True)


# -- data tests -----------------------------------------------------------------------


def doubled(dim: DataFrame, sk: str) -> DataFrame:
    """A damaged dimension, as a written table: closed versions come a second time, ending a day later."""
    dim = written(dim)
    late = dim.filter("valid_to is not null").withColumns(
        {sk: F.concat(sk, F.lit("x")), "valid_to": F.col("valid_to") + F.expr("interval 1 day")}
    )
    return dim.unionByName(late)


def damaged_staging(spark, sf) -> dict[str, DataFrame]:
    """Staged tables with impossible, missing and unexpectedly missing dates."""
    rows = staged(spark, sf)

    def put(name: str, column: str, where: str, value: str | None) -> None:
        wrong = F.lit(value).cast("timestamp_ntz")
        rows[name] = rows[name].withColumn(column, F.when(F.expr(where), wrong).otherwise(F.col(column)))

    put("customers", "updated_at", "state = 'AF'", None)
    put("customers", "created_at", "state = 'AS'", "2101-01-01 00:00:00")
    put("products", "created_at", "current_stock = 1", "1899-12-31 23:59:59")
    put("products", "updated_at", "current_stock = 2", "1900-01-01 00:00:00")
    put("orders", "order_date", "shipping_value = 12 and current_status = 'SHIPPED'", None)
    put("payments", "payment_date", "payment_status = 'REJECTED'", "2101-06-01 00:00:00")
    put("payments", "payment_date", "payment_method = 'PIX'", None)
    put("order_items", "_extracted_at", "quantity = 50", None)
    put("categories", "_extracted_at", "category_name = 'PROMO'", "1899-01-01 00:00:00")
    return rows


@query
def test_unique(spark, sf):
    lines = inputs.table(spark, sf, "lineitem")
    return checks.unique(lines.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line")), "line")


@query
def test_not_null(spark, sf):
    payments = staging.stg_payments(inputs.raw_payments(spark, sf))
    return checks.not_null(payments, payments.columns)


@query
def test_relationships(spark, sf):
    rows = staged(spark, sf, "order_items", "payments")
    return checks.relationships(rows["order_items"], "id_order", rows["payments"], "id_order")


@query
def test_unique_bitmap(spark, sf):
    """Dense keys: those of the orders, which are sound, and of payments that are read twice here and there."""
    rows = staged(spark, sf, "orders", "payments")
    twice = rows["payments"].unionByName(rows["payments"].filter("id_payment % 11 = 4"))
    sound = checks.unique_by_bitmap(rows["orders"], "id_order").withColumn("table_name", F.lit("orders"))
    return sound.unionByName(checks.unique_by_bitmap(twice, "id_payment").withColumn("table_name", F.lit("payments")))


@query
def test_relationships_bitmap(spark, sf):
    """Lines of orders, which are all there, and of payments, which some orders lack."""
    rows = staged(spark, sf, "orders", "order_items", "payments")
    found = [
        checks.relationships_by_bitmap(rows["order_items"], "id_order", rows[n], "id_order").withColumn("parent", F.lit(n))
        for n in ("orders", "payments")
    ]
    return found[0].unionByName(found[1])


@query
def test_not_null_footers(spark, sf):
    """NULLs of every column of the given tables whose values have statistics, without reading one."""
    out = None
    for name in inputs.TABLES:
        columns = inputs.table(spark, sf, name).columns
        rows = checks.footer_counts(spark, f"{sf}/{name}.parquet", columns).withColumn("table_name", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def test_staging_dates(spark, sf):
    return checks.staging_dates(damaged_staging(spark, sf))


@query
def test_gold_dates(spark, sf):
    far, old = ntz("2150-01-01 00:00:00"), ntz("1850-01-01 00:00:00")
    customers = dim_customers(spark, sf).withColumns(
        {
            "valid_to": F.when(F.col("valid_to").isNotNull() & (F.col("state") == "P"), far).otherwise(F.col("valid_to")),
            "created_at": F.when(F.col("state") != "F", F.col("created_at")),
        }
    )
    products = dim_products(spark, sf).withColumn(
        "updated_at", F.when(F.col("current_stock") == 1, old).otherwise(F.col("updated_at"))
    )
    orders = fct_orders(spark, sf).withColumn(
        "payment_date", F.when(F.col("payment_status") == "REJECTED", old).otherwise(F.col("payment_date"))
    )
    return checks.gold_dates(customers, products, orders)


@query
def test_snapshot_dates(spark, sf):
    far, old = ntz("2200-01-01 00:00:00"), ntz("1899-06-01 00:00:00")
    customers = snapshot_customers(spark, sf).withColumn(
        "created_at", F.when(F.col("state") == "P", old).when(F.col("state") == "O", F.col("created_at"))
    )
    products = snapshot_products(spark, sf).withColumn(
        "dbt_valid_to", F.when(F.col("current_stock") == 1, far).otherwise(F.col("dbt_valid_to"))
    )
    return checks.snapshot_dates(customers, products)


@query
def test_scd2_single_current(spark, sf):
    """All versions of a price under 10000 claim to be current, and so may several of a customer."""
    customers = dim_customers(spark, sf).withColumn("is_current", F.col("is_current") | (F.col("state") == "F"))
    products = dim_products(spark, sf).withColumn("is_current", F.col("is_current") | (F.col("sale_price") < 10000))
    return checks.several_current(customers, products)


@query
def test_scd2_ranges(spark, sf):
    customers = dim_customers(spark, sf).withColumn(
        "valid_to", F.when(F.col("state") == "F", F.col("valid_from")).otherwise(F.col("valid_to"))
    )
    products = dim_products(spark, sf).withColumn(
        "valid_to", F.when(F.col("sale_price") < 10000, F.col("created_at")).otherwise(F.col("valid_to"))
    )
    return checks.empty_ranges(customers, products)


@query
def test_scd2_overlap(spark, sf):
    cuts = {"customers": customer_cuts(spark, sf), "products": product_cuts(spark, sf)}
    dims = {
        "customers": doubled(customer_dimension(spark, sf, cuts["customers"]), "customer_sk"),
        "products": doubled(product_dimension(spark, sf, cuts["products"]), "product_sk"),
    }
    return checks.overlaps(dims["customers"], dims["products"], cuts["customers"], cuts["products"])


def tested_tables(spark, sf, keep: Callable[[str, DataFrame], DataFrame] = lambda _, df: written(df)) -> dict[str, DataFrame]:
    """Every table that data tests read, the built ones written by ``keep``, and so what is costly to stage."""
    cuts = customer_cuts(spark, sf)
    tables = {
        "snapshot_customers": keep("snapshot_customers", customer_history(spark, sf, cuts)),
        "snapshot_products": keep("snapshot_products", snapshot_products(spark, sf)),
        **{f"stg_{n}": df for n, df in staged(spark, sf).items()},
    }
    # The key of an item is a digest of its line, which every test would draw anew, several times a row.
    tables["stg_order_items"] = keep("stg_order_items", tables["stg_order_items"])
    for name, build in (("customers", marts.dim_customers), ("products", marts.dim_products)):
        tables[f"dim_{name}"] = keep(f"dim_{name}", build(tables[f"snapshot_{name}"]))
    rows = [tables[f"stg_{n}"] for n in ("orders", "order_items", "payments")]
    tables["fct_orders"] = keep("fct_orders", marts.fct_orders(*rows, tables["dim_customers"], cuts, exclusive=True))
    return tables


@query
def run_tests(spark, sf):
    """All 39 tests over one set of written tables, damaged so that most of them fail."""
    return suite.run_tests({name: damaged(df, name) for name, df in tested_tables(spark, sf).items()})


@query
def run_tests_kept(spark, sf):
    """The report of sound tables, kept up while first the staged tables are damaged, then all others."""
    house = store.Warehouse(spark, workspace(spark), buckets=8)
    keys = {**suite.STAGING_KEYS, "dim_customers": "customer_id", "dim_products": "product_id", "fct_orders": "order_id"}
    keys |= {"snapshot_customers": "id_customer", "snapshot_products": "id_product"}
    commit = house.head().next()

    def put(name: str, df: DataFrame) -> DataFrame:
        """A table of the commit in the making: what is built for the tests has no other copy."""
        house.replace(commit, f"checked/{name}", df, keys[name])
        return house.read(f"checked/{name}", commit)

    tables = tested_tables(spark, sf, put)
    watched = {name: watch.Watched(f"checked/{name}") for name in tables}
    for wrong in ((), suite.STAGING_KEYS, [n for n in tables if n not in suite.STAGING_KEYS]):
        for name, df in tables.items():
            if name in wrong:
                put(name, damaged(df, name))
            elif f"checked/{name}" not in commit.tables:
                tables[name] = put(name, df)
        report = watch.refresh_report(house, commit, watched)
        # The report needs the newest tables only.
        commit = house.publish(commit).next()
        house.vacuum(keep=1)
    return report


def damaged(df: DataFrame, name: str) -> DataFrame:
    twice, replaced = DAMAGE[name]
    return df.select([F.expr(replaced.get(c, c)).alias(c) for c in df.columns]).unionByName(df.filter(twice))


# -- source repairs -------------------------------------------------------------------


@query
def backfill_created_at(spark, sf):
    return tracked_customers(spark, sf)


@query
def refresh_category_descriptions(spark, sf):
    return repairs.refresh_descriptions(staging.stg_categories(inputs.raw_categories(spark, sf)), DESCRIPTIONS)


@query
def compute_order_total(spark, sf):
    rows = staged(spark, sf, "orders", "order_items")
    return repairs.order_totals(rows["orders"], rows["order_items"])


@query
def check_order_total(spark, sf):
    rows = staged(spark, sf, "orders", "order_items")
    return repairs.check_order_total(rows["orders"], rows["order_items"])


# -- whole runs -----------------------------------------------------------------------


@dataclass(frozen=True)
class CustomerRuns:
    """Customers at the cut and at the end, the changes between, and the versions (days) of both."""

    before: DataFrame
    after: DataFrame
    log: DataFrame
    cut: int
    last: int


def customer_runs(spark, sf) -> CustomerRuns:
    day = F.unix_date(F.col("change_ts").cast("date")).cast("bigint")
    feed = inputs.customer_feed(spark, sf)
    people = tracked_customers(spark, sf).drop("state", "_extracted_at")

    def customers(cut: str | None) -> DataFrame:
        alive = state_at(feed, cut).select("id_customer", F.col("segment").alias("state"))
        return people.join(alive, "id_customer").select(*entities.ENTITIES["customers"].schema.fieldNames())

    log = batch_after(feed, CUT_TS).select("id_customer", day.alias("change_version"), F.col("_operation").alias("op"))
    bounds = feed.agg(F.unix_date(ntz(CUT_TS).cast("date")).alias("cut"), F.max(day).alias("last")).first()
    return CustomerRuns(customers(CUT_TS), customers(None), log, bounds["cut"], bounds["last"])


@query
def run_cycle(spark, sf):
    """Two runs: a full load at the cut, then the customer changes behind it."""
    everyone = customer_runs(spark, sf)
    house = store.Warehouse(spark, workspace(spark), buckets=8)
    cycle.run_cycle(house, test_source(spark, sf, everyone.before, version=everyone.cut - 1), FIRST_RUN)
    after = test_source(spark, sf, everyone.after, everyone.log, version=everyone.last)
    return house.read(fact.FACT, cycle.run_cycle(house, after, SECOND_RUN))


@query
def fct_orders_follow(spark, sf):
    """A fact built once, then following what changed in customers, orders, items and payments."""
    house, everyone = store.Warehouse(spark, workspace(spark), buckets=8), customer_runs(spark, sf)
    nothing = spark.createDataFrame([], "id bigint, change_version bigint, op string")
    quiet = {n: nothing.withColumnRenamed("id", entities.ENTITIES[n].key) for n in ("categories", "products")}
    current = {n: inputs.RAW[n](spark, sf) for n in EARLIER}
    # The key of an item is a digest of its line, which both runs and the log would draw anew, several times a row.
    current["order_items"] = written(current["order_items"])
    logs = {**quiet, **{n: changes_since(n, rows, everyone.last) for n, rows in current.items()}, "customers": everyone.log}
    for run_ts, version, people, raw in (
        (FIRST_RUN, everyone.cut - 1, everyone.before, {n: earlier(n, rows) for n, rows in current.items()}),
        (SECOND_RUN, everyone.last, everyone.after, current),
    ):
        rows = {n: df.drop("_extracted_at") for n, df in {**{q: inputs.RAW[q](spark, sf) for q in quiet}, **raw}.items()}
        rows["customers"] = people
        tables = {n: cycle.SourceTable(df, logs[n], min_valid=0) for n, df in rows.items()}
        commit = cycle.run_cycle(house, cycle.Source(tables, version), run_ts)
    return house.read(fact.FACT, commit)


@query
def run_select(spark, sf):
    """One run stage by stage, each published on its own."""
    house = store.Warehouse(spark, workspace(spark), buckets=8)
    for stage in cycle.STAGES:
        cycle.run_cycle(house, test_source(spark, sf), FIRST_RUN, stages=[stage])
    return house.read("gold/dim_products")
