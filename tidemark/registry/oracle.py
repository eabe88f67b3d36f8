"""The same queries in plain SQL over the same tables, written to a different recipe.

Named parts are put together on demand: :func:`sql` prepends every part a text mentions.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from tidemark.registry.inputs import TABLES
from tidemark.registry.queries import CUT_TS, DAMAGE, DESCRIPTIONS, EARLIER, FIRST_RUN, RUN_TS, SECOND_RUN

EXTRACTED = "timestamp '2024-02-01 00:00:00'"
DATE_BAD = "({0} < timestamp '1900-01-01' or {0} >= timestamp '2101-01-01')"

PARTS: dict[str, str] = {
    "raw_customers": f"""
        select c_custkey as id_customer, '  ' || c_name || ' ' as full_name, ' ' || c_name || '@Example.COM ' as email,
          lpad(cast(c_custkey as varchar), 11, '0') as cpf, 'Rua ' || cast(c_custkey as varchar) as address,
          n_name as city, lower(substr(r_name, 1, 2)) as state, lpad(cast(c_custkey as varchar), 8, '0') as zip_code,
          timestamp '2000-01-01 00:00:00' as created_at, timestamp '2000-01-02 03:04:05.678901' as updated_at,
          {EXTRACTED} as _extracted_at
        from customer, nation, region where c_nationkey = n_nationkey and n_regionkey = r_regionkey""",
    "raw_categories": f"""
        select cast('0x' || substr(md5(p_type), 1, 15) as bigint) as id_category, ' ' || p_type || '  ' as category_name,
          if(p_type = 'PROMO', null, 'desc ' || lower(p_type) || ' ') as description, {EXTRACTED} as _extracted_at
        from part group by p_type""",
    "raw_products": f"""
        select p_partkey as id_product, ' sku-' || lpad(cast(p_partkey as varchar), 6, '0') || ' ' as sku,
          p_name || ' ' as product_name, cast('0x' || substr(md5(p_type), 1, 15) as bigint) as id_category,
          p_retailprice as sale_price, p_retailprice * cast(0.5 as double) as unit_cost, p_size as current_stock,
          timestamp '1995-01-01' as created_at, timestamp '1995-01-01' as updated_at, {EXTRACTED} as _extracted_at
        from part""",
    "raw_orders": f"""
        select o_orderkey as id_order, o_custkey as id_customer, o_orderdate as order_date, o_totalprice as total_value,
          cast([0, 12, 19, 29][o_orderkey % 4 + 1] as double) as shipping_value,
          case o_orderstatus when 'F' then ' delivered' when 'O' then 'created ' else 'shipped' end as current_status,
          o_orderdate as updated_at, {EXTRACTED} as _extracted_at from orders""",
    "raw_order_items": f"""
        select cast('0x' || substr(md5(concat_ws('|', l_orderkey::varchar, l_linenumber::varchar, l_partkey::varchar,
            l_suppkey::varchar, l_quantity::decimal(12,2)::varchar, l_extendedprice::decimal(12,2)::varchar,
            l_discount::decimal(12,2)::varchar, l_tax::decimal(12,2)::varchar, l_shipdate::varchar, l_returnflag,
            l_linestatus)), 1, 15) as bigint) as id_item,
          l_orderkey as id_order, l_partkey as id_product, l_quantity::int as quantity,
          l_extendedprice::decimal(10,2) as unit_price, {EXTRACTED} as _extracted_at from lineitem""",
    "raw_payments": f"""
        select o_orderkey * 2 + n as id_payment, o_orderkey as id_order,
          ['pix ', ' credit_card', 'bank_slip'][(o_orderkey + n) % 3 + 1] as payment_method,
          if(o_orderstatus = 'O', 'pending', if(n = 1, 'rejected', 'approved')) as payment_status,
          o_totalprice::decimal(10,2) as amount, if(o_orderstatus = 'O', null, o_orderdate) as payment_date,
          {EXTRACTED} as _extracted_at
        from orders, (values (0), (1)) tries(n)
        where not (o_orderpriority = '5-LOW' and o_orderstatus = 'O') and (n = 0 or o_orderpriority = '1-URGENT')""",
    "customer_feed": """
        select o_custkey as id_customer, if(o_orderkey % 13 = 0, null, o_orderstatus) as segment,
          o_orderdate as change_ts, o_orderkey as change_version,
          if(o_orderkey % 11 = 0, 'D', if(o_orderkey % 11 = 1, 'I', 'U')) as op from orders""",
    "product_feed": """
        select l_partkey as id_product, l_shipdate as change_ts, min(l_orderkey) as change_version,
          max(l_extendedprice::decimal(10,2)) as sale_price, 'U' as op
        from lineitem group by all""",
    "state_end": """
        select id_customer, last.segment as segment, last.change_ts as change_ts, last.change_version as change_version
        from (select id_customer, arg_max(row(segment, change_ts, change_version, op), row(change_ts, change_version))
                ::struct(segment varchar, change_ts timestamp, change_version bigint, op varchar) as last
              from customer_feed group by id_customer)
        where last.op <> 'D'""",
    "state_cut": f"""
        select id_customer, segment, change_ts, change_version from (
          select *, row_number() over (partition by id_customer order by change_ts desc, change_version desc) as r
          from customer_feed where change_ts < timestamp '{CUT_TS}') where r = 1 and op <> 'D'""",
    # Operations as the merges see them: some changes do not say what they are.
    "unmarked_feed": """
        select * replace (if(change_version % 7 = 3, null, op) as op) from customer_feed""",
    # Run once behind the cut: the last change of a key decides, an unmarked one never inserts.
    "merged_at_cut": f"""
        select id_customer, segment, change_ts, change_version from (
          select *, row_number() over (partition by id_customer order by change_ts desc, change_version desc) as r
          from unmarked_feed where change_ts >= timestamp '{CUT_TS}')
        where r = 1 and (op in ('I', 'U') or (op is null and id_customer in (select id_customer from state_cut)))
        union all
        select * from state_cut
        where id_customer not in (select id_customer from customer_feed where change_ts >= timestamp '{CUT_TS}')""",
    # Run once a year: a key is there if the last marked of its yearly changes is no deletion.
    "merged_by_year": """
        with yearly as (
          select * from unmarked_feed qualify row_number() over (
            partition by id_customer, year(change_ts) order by change_ts desc, change_version desc) = 1)
        select id_customer, arg_max(row(segment), change_ts)[1] as segment, max(change_ts) as change_ts,
          arg_max(change_version, change_ts) as change_version
        from yearly group by id_customer having arg_max(op, change_ts) filter (op is not null) in ('I', 'U')""",
    "tracked_customers": """
        select c.* replace (least(c.created_at, coalesce(f.first_order, c.created_at)) as created_at)
        from raw_customers c left join
          (select o_custkey, min(o_orderdate) as first_order from orders group by 1) f on c.id_customer = f.o_custkey""",
    "s_customers": """
        select id_customer, trim(full_name) as full_name, lower(trim(email)) as email, cpf, address, city,
          upper(state) as state, zip_code, created_at, updated_at, _extracted_at from tracked_customers""",
    "s_categories": """
        select id_category, trim(category_name) as category_name, trim(description) as description, _extracted_at
        from raw_categories""",
    "s_products": """
        select * replace (upper(trim(sku)) as sku, trim(product_name) as product_name,
          sale_price::decimal(10,2) as sale_price, unit_cost::decimal(10,2) as unit_cost) from raw_products""",
    "s_orders": """
        select * replace (total_value::decimal(10,2) as total_value, shipping_value::decimal(10,2) as shipping_value,
          upper(trim(current_status)) as current_status) from raw_orders""",
    "s_order_items": """
        select id_item, id_order, id_product, quantity, unit_price, (quantity * unit_price)::decimal(10,2) as subtotal,
          _extracted_at from raw_order_items""",
    "s_payments": """
        select * replace (upper(trim(payment_method)) as payment_method, upper(trim(payment_status)) as payment_status)
        from raw_payments""",
    "named_products": """
        select p.*, c.category_name, c.description as category_description
        from s_products p left join s_categories c using (id_category)""",
    # One row per change that opens or closes a version; the end is the next such row.
    "segment_history": """
        select id_customer, segment, started, ended from (
          select *, change_ts as started, lead(change_ts) over (partition by id_customer order by change_ts) as ended
          from (select *, lag(op) over w as last_op, lag(segment) over w as last_segment
                from (select * from customer_feed
                      qualify max(change_version) over (partition by id_customer, change_ts) = change_version)
                window w as (partition by id_customer order by change_ts))
          where case when op = 'D' then last_op <> 'D'
                     else coalesce(last_op, 'D') = 'D' or segment is distinct from last_segment end)
        where op <> 'D'""",
    "price_history": """
        select id_product, sale_price, change_ts as started,
          lead(change_ts) over (partition by id_product order by change_ts) as ended
        from (select *, lag(sale_price) over (partition by id_product order by change_ts) as last_price
              from product_feed)
        where sale_price is distinct from last_price""",
    "h_customers": """
        select c.* replace (h.segment as state), md5(h.id_customer::varchar || '|' || h.started::varchar) as dbt_scd_id,
          h.started as dbt_updated_at, h.started as dbt_valid_from, h.ended as dbt_valid_to
        from segment_history h join s_customers c using (id_customer)""",
    "h_products": """
        select p.* replace (h.sale_price as sale_price),
          md5(h.id_product::varchar || '|' || h.started::varchar) as dbt_scd_id,
          h.started as dbt_updated_at, h.started as dbt_valid_from, h.ended as dbt_valid_to
        from price_history h join named_products p using (id_product)""",
    "d_customers": """
        select dbt_scd_id as customer_sk, id_customer as customer_id, full_name, email, cpf, address, city, state,
          zip_code, created_at, updated_at,
          if(row_number() over (partition by id_customer order by dbt_valid_from) = 1 and created_at < dbt_valid_from,
             created_at, dbt_valid_from) as valid_from, dbt_valid_to as valid_to, dbt_valid_to is null as is_current
        from h_customers""",
    "d_products": """
        select dbt_scd_id as product_sk, id_product as product_id, sku, product_name, id_category as category_id,
          category_name, category_description, sale_price, unit_cost, current_stock, created_at, updated_at,
          if(row_number() over (partition by id_product order by dbt_valid_from) = 1 and created_at < dbt_valid_from,
             created_at, dbt_valid_from) as valid_from, dbt_valid_to as valid_to, dbt_valid_to is null as is_current
        from h_products""",
    "item_sums": """
        select id_order, count(*) as order_line_count, sum(quantity)::bigint as total_quantity,
          sum(subtotal)::decimal(20,2) as items_subtotal from s_order_items group by id_order""",
    "payment_sums": """
        select id_order, max(payment_method) as payment_method, max(payment_status) as payment_status,
          sum(amount)::decimal(20,2) as payment_amount, max(payment_date) as payment_date
        from s_payments group by id_order""",
    # Orders with the latest version that had started, kept only while it is in force.
    "placed_orders": """
        select o.* exclude (seq), if(v.valid_to is null or o.order_date < v.valid_to, v.customer_sk, null) as customer_sk
        from (select *, 1 as seq from s_orders) o
        asof left join d_customers v on o.id_customer = v.customer_id and o.order_date >= v.valid_from""",
    "f_orders": """
        select o.id_order as order_id, o.id_customer as customer_id, o.customer_sk, o.order_date,
          o.current_status as order_status, o.total_value as order_total, o.shipping_value,
          ifnull(i.order_line_count, 0) as order_line_count, ifnull(i.total_quantity, 0) as total_quantity,
          ifnull(i.items_subtotal, 0)::decimal(20,2) as items_subtotal, p.payment_method, p.payment_status,
          p.payment_amount, p.payment_date, o.updated_at, o._extracted_at
        from placed_orders o left join item_sums i using (id_order) left join payment_sums p using (id_order)""",
    "region_marks": f"""
        select n_name as table_name, max(o_orderkey) filter (o_orderdate < timestamp '{CUT_TS}') as before_cut,
          max(o_orderkey) filter (o_orderdate >= timestamp '{CUT_TS}') as after_cut
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1""",
    "doubled_customers": """
        select * from d_customers union all by name
        select * replace (customer_sk || 'x' as customer_sk, valid_to + interval 1 day as valid_to)
        from d_customers where valid_to is not null""",
    "doubled_products": """
        select * from d_products union all by name
        select * replace (product_sk || 'x' as product_sk, valid_to + interval 1 day as valid_to)
        from d_products where valid_to is not null""",
    # Two runs over the segments alive at the cut and at the end.
    "run_versions": f"""
        select id_customer, b.segment as state, timestamp '{FIRST_RUN}' as started,
          if(e.id_customer is null or e.segment is distinct from b.segment, timestamp '{SECOND_RUN}', null) as ended,
          b.change_ts, b.change_version
        from state_cut b left join state_end e using (id_customer)
        union all
        select id_customer, e.segment, timestamp '{SECOND_RUN}', null, e.change_ts, e.change_version
        from state_end e left join state_cut b using (id_customer)
        where b.id_customer is null or e.segment is distinct from b.segment""",
    "run_dim": """
        select id_customer, md5(id_customer::varchar || '|' || started::varchar) as customer_sk,
          if(started = min(started) over (partition by id_customer), least(c.created_at, started), started) as valid_from,
          ended as valid_to
        from run_versions join s_customers c using (id_customer)""",
}

ORACLE: dict[str, Callable[[], str]] = {}


def sql(body: str) -> str:
    """``body`` behind all parts it names, directly or through other parts, in dependency order."""
    wanted: list[str] = []

    def visit(text: str) -> None:
        for name in PARTS:
            if name not in wanted and re.search(rf"\b{name}\b", text):
                visit(PARTS[name])
                wanted.append(name)

    visit(body)
    parts = ",\n".join(f"{name} as ({PARTS[name].strip()})" for name in wanted)
    return f"with {parts}\n{body.strip()}" if parts else body.strip()


def add(name: str, body: str) -> None:
    ORACLE[name] = lambda: sql(body)


def bad(column: str, missing: bool = True) -> str:
    either = f"{column} is null or " if missing else ""
    return f"({either}{DATE_BAD.format(column)})"


def violations(table: str, record_id: str, rules: dict[str, str], source: str) -> str:
    return "\nunion all\n".join(
        f"select '{table}.{c}' as field_name, {record_id}::varchar as record_id from ({source}) where {rule}"
        for c, rule in rules.items()
    )


# -- sources, sinks, shaping
_described_columns = (
    ("id_payment", "long", "null", "null"), ("id_order", "long", "null", "null"), ("payment_method", "string", "null", "null"),
    ("payment_status", "string", "null", "null"), ("amount", "decimal", "10", "2"), ("payment_date", "timestamp_ntz", "null", "null"),
    ("_extracted_at", "timestamp_ntz", "null", "null"),
)
add(
    "source_schema",
    " union all ".join(
        f"select {k}::int as ordinal, '{c}' as column_name, '{t}' as data_type, {p}::int as numeric_precision, "
        f"{s}::int as numeric_scale, (select count({c}) from raw_payments) as n_values"
        for k, (c, t, p, s) in enumerate(_described_columns, start=1)
    ),
)
_numbers = {
    "bigint": "bigint", "int": "int", "smallint": "smallint", "tinyint": "smallint", "decimal": "decimal(38,0)", "numeric": "decimal(38,0)",
    "money": "decimal(19,4)", "smallmoney": "decimal(10,4)", "float": "double", "real": "double", "decimal_18_4": "decimal(18,4)",
}
add(
    "map_source_types",
    "select event_id, event_id % 2 = 1 as as_bit, strftime(ts, '%Y-%m-%d %H:%M:%S') || case when microsecond(ts) % 1000000 = 0 then '' else "
    "rtrim(strftime(ts, '.%f'), '0') end as as_time, "
    + ", ".join(f"(event_id % 100)::{kind} as as_{name}" for name, kind in _numbers.items())
    + ", "
    + ", ".join(f"ts as as_{name}" for name in ("date", "datetime", "datetime2", "smalldatetime"))
    + ", "
    + ", ".join(f"hex(encode(props)) as as_{name}" for name in ("binary", "varbinary", "image"))
    + ", as_time as as_nvarchar, as_time as as_xml from events",
)
add("ensure_layers", "select * from raw_payments")
add("route_layer", "select *, unnest(['gold', 'bronze']) as layer from item_sums")
add("full_extract", "select *, 'I' as _operation from raw_orders")
add(
    "incremental_extract",
    """select f.id_customer, c.* exclude (id_customer), f.op as _operation, f.change_version
       from customer_feed f left join (
         select * from raw_customers where id_customer not in (
           select id_customer from customer_feed group by id_customer having arg_max(op, change_version) = 'D')) c
       on f.id_customer = c.id_customer
       where f.change_version > (select (max(change_version) + min(change_version)) // 2 from customer_feed)""",
)
add("stamp_extracted_at", f"select * replace (timestamp '{RUN_TS}' as _extracted_at) from raw_orders")
add(
    "normalize_timestamps",
    """select event_id, e.moment as "at", strftime(e.moment, '%Y-%m-%d %H:%M:%S.%f') as at_text
       from (select event_id, if(event_type = 'click', ts - interval 2 hours, ts) as moment from events) e""",
)
add("land_parquet", "select * from raw_payments")
add(
    "conform_columns",
    """select id_order, id_customer, order_date, total_value::decimal(10,2) as total_value,
         shipping_value::decimal(10,2) as shipping_value, current_status, null::timestamp as updated_at,
         null::varchar as _operation, null::timestamp as _extracted_at from raw_orders""",
)
add("load_by_name", "select * from raw_payments")
_entities = ("customers", "categories", "products", "orders", "order_items", "payments")
add(
    "reconcile_counts",
    " union all ".join(
        f"select '{n}' as table_name, count(*) as extracted, count(*) as loaded from raw_{n}" for n in _entities
    ),
)
add("drop_landing", "select * from raw_payments")
_keys = dict(zip(_entities, ("id_customer", "id_category", "id_product", "id_order", "id_item", "id_payment")))
add(
    "bronze_sources",
    " union all ".join(
        f"select 'raw_{n}' as table_name, count(*) as n_rows, max({k}) as last_key from raw_{n}" for n, k in _keys.items()
    ),
)
add(
    "materialize_view",
    """select category_name, count(*) as n_lines, sum(subtotal)::decimal(20,2) as sold
       from s_order_items join named_products using (id_product) group by category_name""",
)
add("materialize_table", "select * from payment_sums")

# -- merge and ingestion state
add(
    "version_bounds",
    """select 'customers' as table_name, max(change_version) as upper, min(change_version) as min_valid from customer_feed
       union all select 'products', max(change_version), min(change_version) from product_feed""",
)
add(
    "read_watermark",
    """select 'customers' as table_name, max(change_version) as last_sync_version from customer_feed
       union all select 'products', max(change_version) from product_feed""",
)
add(
    "refresh_decision",
    """select *, coalesce(not (last_version between min_valid and upper), true) as full_refresh
       from (select id_customer, min(change_version) filter (op = 'I') as last_version,
               min(change_version) filter (segment = 'F') as min_valid, max(change_version) filter (op <> 'I') as upper
             from customer_feed group by id_customer)""",
)
add(
    "dedupe_keep_last",
    """select id_customer, change_ts, max(change_version) as change_version, arg_max(op, change_version) as op,
         arg_max(row(segment), change_version)[1] as segment from customer_feed group by id_customer, change_ts""",
)
# The last change of a key over the whole feed decides, whatever the batches were.
add("merge_changes", "select * from merged_at_cut")
add("full_refresh_merge", "select * from state_end")
add(
    "upsert_watermark",
    """select table_name, coalesce(after_cut, before_cut) as last_sync_version from region_marks""",
)
add(
    "noop_advance",
    """select *, null::varchar as table_name, null::bigint as last_sync_version from state_end
       union all by name select table_name, coalesce(after_cut, before_cut) as last_sync_version from region_marks""",
)
add("atomic_commit", "select *, (select max(o_orderkey) from orders) as watermark from state_end")
add(
    "ingest_all",
    " union all ".join(
        f"select '{n}' as table_name, count(*) as n_rows, timestamp '{RUN_TS}' as stamp, 7::bigint as last_sync_version "
        f"from raw_{n}"
        for n in _entities
    ),
)
add("cdc_stream", "select * from merged_by_year")

ORACLE["merge_changes_bucketed"] = ORACLE["merge_changes"]
add(
    "cdc_versions",
    """select id_customer, segment, change_ts, change_version from customer_feed
       qualify max(change_version) over (partition by id_customer) = change_version and op <> 'D'""",
)
_content = {
    "categories": ("id_category", "category_name", "description", "_extracted_at"),
    "order_items": ("id_item", "id_order", "id_product", "quantity", "unit_price", "_extracted_at"),
    "payments": ("id_payment", "id_order", "payment_method", "payment_status", "amount", "payment_date", "_extracted_at"),
}
_hashed = " union all ".join(
    f"""select '{n}' as table_name, cast('0x' || substr(md5({" || '|' || ".join(f"coalesce({c}::varchar, '~')" for c in columns)}), 1, 15)
        as bigint) as h from raw_{n}"""
    for n, columns in _content.items()
)
add(
    "reconcile_content",
    f"""select table_name, stage, count(*) as "rows", sum(h)::decimal(38,0) as total, bit_xor(h) as mixed
        from ({_hashed}), (values ('landed'), ('merged')) stages(stage) group by all""",
)
add(
    "test_unique_bitmap",
    "select id_payment as value, 2 as n_rows, 'payments' as table_name from s_payments where id_payment % 11 = 4",
)
add(
    "test_relationships_bitmap",
    """select id_order as value, count(*) as n_rows, 'payments' as parent from s_order_items
       where id_order not in (select id_order from s_payments) group by 1""",
)
_given = {n: [c.split()[0] for c in kinds.split(", ")] for n, kinds in TABLES.items()}
add(
    "test_not_null_footers",
    " union all ".join(
        f"select '{n}' as table_name, '{c}' as column_name, count(*) - count({c}) as n_rows from {n}" for n, columns in _given.items() for c in columns
    ),
)

# -- staging
add("stg_customers", "select * from (" + PARTS["s_customers"].replace("tracked_customers", "raw_customers") + ")")
for _n in _entities[1:]:
    add(f"stg_{_n}", f"select * from s_{_n}")

# -- history
add("snapshot_customers", "select * from h_customers")
add("snapshot_products", "select * from h_products")
add(
    "scd2_apply",
    """select id_customer, state, change_ts, change_version,
         md5(id_customer::varchar || '|' || started::varchar) as dbt_scd_id, started as dbt_updated_at,
         started as dbt_valid_from, ended as dbt_valid_to from run_versions""",
)
ORACLE["scd2_apply_changed"] = ORACLE["scd2_apply"]
add(
    "scd2_fold",
    """select id_customer, segment, md5(id_customer::varchar || '|' || started::varchar) as dbt_scd_id,
         started as dbt_updated_at, started as dbt_valid_from, ended as dbt_valid_to from segment_history""",
)
add(
    "scd2_keys",
    """select id_customer, change_ts, md5(concat_ws('|', id_customer, change_ts)) as version_key
       from customer_feed group by all""",
)
add("snapshot_input_products", "select * from named_products")

# -- marts
add("dim_customers", "select * from d_customers")
add("dim_products", "select * from d_products")
add(
    "backdate_first_version",
    """select h.id_customer, h.created_at, h.dbt_valid_from, h.dbt_valid_to, d.valid_from
       from h_customers h join d_customers d on h.dbt_scd_id = d.customer_sk""",
)
add("order_item_totals", "select * from item_sums")
add("payment_totals", "select * from payment_sums")
add("asof_customer_version", "select id_order, id_customer, order_date, customer_sk from placed_orders")
add(
    "range_join_versions",
    """select o.id_order, o.id_customer, o.order_date, v.customer_sk from s_orders o left join doubled_customers v
       on o.id_customer = v.customer_id and o.order_date >= v.valid_from
       and o.order_date < coalesce(v.valid_to, timestamp '9999-12-31')""",
)
add("fct_orders", "select * from f_orders")
add("order_item_totals_kept", "select * from item_sums")
add("payment_totals_kept", "select * from payment_sums")

# -- data tests
add(
    "test_unique",
    """select l_orderkey::varchar || '-' || l_linenumber::varchar as value, count(*) as n_rows
       from lineitem group by 1 having count(*) > 1""",
)
_payment_columns = (
    "id_payment",
    "id_order",
    "payment_method",
    "payment_status",
    "amount",
    "payment_date",
    "_extracted_at",
)
add(
    "test_not_null",
    "select * from ("
    + " union all ".join(
        f"select '{c}' as column_name, count(*) - count({c}) as n_rows from s_payments" for c in _payment_columns
    )
    + ") where n_rows > 0",
)
add(
    "test_relationships",
    """select id_order as value, count(*) as n_rows from s_order_items i
       where id_order is not null and not exists (from s_payments p where p.id_order = i.id_order) group by id_order""",
)
_staged = {
    "customers": """select * replace (if(state = 'AF', null, updated_at) as updated_at,
        if(state = 'AS', timestamp '2101-01-01', created_at) as created_at) from (
        select * replace (upper(state) as state) from raw_customers)""",
    "products": """select * replace (case current_stock when 1 then timestamp '1899-12-31 23:59:59' else created_at end as
        created_at, case current_stock when 2 then timestamp '1900-01-01' else updated_at end as updated_at)
        from s_products""",
    "orders": """select * replace (if(shipping_value = 12 and current_status = 'SHIPPED', null, order_date) as order_date)
        from s_orders""",
    "payments": """select * replace (if(payment_method = 'PIX', null,
        if(payment_status = 'REJECTED', timestamp '2101-06-01', payment_date)) as payment_date) from s_payments""",
    "order_items": "select * replace (if(quantity = 50, null, _extracted_at) as _extracted_at) from s_order_items",
    "categories": """select * replace (if(category_name = 'PROMO', timestamp '1899-01-01', _extracted_at) as _extracted_at)
        from s_categories""",
}
_full = ("created_at", "updated_at", "_extracted_at")
_staged_rules = {
    "customers": {c: bad(c) for c in _full},
    "products": {c: bad(c) for c in _full},
    "orders": {c: bad(c) for c in ("order_date", "updated_at", "_extracted_at")},
    "payments": {
        "payment_date": f"({bad('payment_date', False)} or (payment_date is null and payment_status <> 'PENDING'))",
        "_extracted_at": bad("_extracted_at"),
    },
    "order_items": {"_extracted_at": bad("_extracted_at")},
    "categories": {"_extracted_at": bad("_extracted_at")},
}
add(
    "test_staging_dates",
    "\nunion all\n".join(violations(f"stg_{n}", _keys[n], _staged_rules[n], _staged[n]) for n in _staged),
)
_versioned = {
    **{c: bad(c) for c in ("created_at", "updated_at", "valid_from")},
    "valid_to": bad("valid_to", False),
}
add(
    "test_gold_dates",
    "\nunion all\n".join(
        (
            violations(
                "dim_customers",
                "customer_sk",
                _versioned,
                """select * replace (if(state = 'P' and valid_to is not null, timestamp '2150-01-01', valid_to) as valid_to,
                   case when state <> 'F' then created_at end as created_at) from d_customers""",
            ),
            violations(
                "dim_products",
                "product_sk",
                _versioned,
                """select * replace (if(current_stock = 1, timestamp '1850-01-01', updated_at) as updated_at)
                   from d_products""",
            ),
            violations(
                "fct_orders",
                "order_id",
                {
                    "order_date": bad("order_date"),
                    "updated_at": bad("updated_at"),
                    "payment_date": bad("payment_date", False),
                },
                """select * replace (if(payment_status = 'REJECTED', timestamp '1850-01-01', payment_date) as payment_date)
                   from f_orders""",
            ),
        )
    ),
)
_moments = ("dbt_updated_at", "dbt_valid_from", "dbt_valid_to", "created_at", "updated_at")
_any = " or ".join(bad(c, False) for c in _moments)
add(
    "test_snapshot_dates",
    f"""select 'snapshot_customers' as snapshot_name, id_customer::varchar as record_id from (
          select * replace (case state when 'P' then timestamp '1899-06-01' when 'O' then created_at end as created_at)
          from h_customers) where {_any}
        union all select 'snapshot_products', id_product::varchar from (
          select * replace (if(current_stock = 1, timestamp '2200-01-01', dbt_valid_to) as dbt_valid_to)
          from h_products) where {_any}""",
)
add(
    "test_scd2_single_current",
    """select 'customers' as dimension_name, customer_id::varchar as business_key from d_customers
       group by customer_id having count(*) filter (coalesce(is_current or state = 'F', false)) > 1
       union all select 'products', product_id::varchar from d_products
       group by product_id having count(*) filter (is_current or sale_price < 10000) > 1""",
)
add(
    "test_scd2_ranges",
    """select 'customers' as dimension_name, customer_id::varchar as business_key, valid_from, valid_from as valid_to
       from d_customers where state = 'F'
       union all select 'products', product_id::varchar, valid_from, created_at
       from d_products where sale_price < 10000 and created_at <= valid_from""",
)
_pairs = """select '{n}s' as dimension_name, a.{n}_id::varchar as business_key, a.{n}_sk as first_version,
    b.{n}_sk as overlapping_version from doubled_{n}s a join doubled_{n}s b
    on a.{n}_id = b.{n}_id and a.{n}_sk < b.{n}_sk and greatest(a.valid_from, b.valid_from) <
    least(coalesce(a.valid_to, timestamp '9999-12-31'), coalesce(b.valid_to, timestamp '9999-12-31'))"""
add("test_scd2_overlap", _pairs.format(n="customer") + " union all " + _pairs.format(n="product"))


def _report() -> str:
    """Expected counts over the damaged tables, each counted on its own."""
    from tidemark.plans.suite import NOT_NULL, RELATIONSHIPS, UNIQUE

    ids = {"snapshot_customers": "h_customers", "snapshot_products": "h_products", "dim_customers": "d_customers"}
    base = {**ids, "dim_products": "d_products", "fct_orders": "f_orders"}
    for table, (twice, replaced) in DAMAGE.items():
        source = base.get(table, table.replace("stg_", "s_"))
        if source == "s_customers":
            # the staged table as it is ingested, whose creation dates nothing has moved
            source = "(" + PARTS["s_customers"].replace("tracked_customers", "raw_customers") + ")"
        changed = ", ".join(f"{value} as {column}" for column, value in replaced.items())
        PARTS[f"bad_{table}"] = f"select * replace ({changed}) from {source} union all by name select * from {source} where {twice}"
    counts: dict[str, str] = {}
    for t, c in UNIQUE.items():
        counts[f"unique:{t}.{c}"] = f"(select count(*) from (select {c} from bad_{t} where {c} is not null group by 1 having count(*) > 1))"
    for t, columns in NOT_NULL.items():
        for c in columns:
            counts[f"not_null:{t}.{c}"] = f"(select count(*) - count({c}) from bad_{t})"
    for t, c, parent, key in RELATIONSHIPS:
        known = f"select {key} from bad_{parent} where {key} is not null"
        counts[f"relationships:{t}.{c}"] = f"(select count(*) from bad_{t} where {c} is not null and {c} not in ({known}))"
    staged = "\nunion all\n".join(violations(f"stg_{n}", _keys[n], _staged_rules[n], f"from bad_stg_{n}") for n in _staged)
    placed = {**{c: bad(c) for c in ("order_date", "updated_at")}, "payment_date": bad("payment_date", False)}
    gold = (("dim_customers", "customer_sk", _versioned), ("dim_products", "product_sk", _versioned), ("fct_orders", "order_id", placed))
    golden = "\nunion all\n".join(violations(t, key, rules, f"from bad_{t}") for t, key, rules in gold)
    counts["staging_dates"] = f"(select count(*) from ({staged}))"
    counts["gold_dates"] = f"(select count(*) from ({golden}))"
    both = lambda text: " + ".join(f"({text.format(n=n)})" for n in ("customer", "product"))
    counts["snapshot_dates"] = both(f"select count(*) from bad_snapshot_{{n}}s where {_any}")
    counts["several_current"] = both(
        "select count(*) from (select {n}_id from bad_dim_{n}s group by 1 having count(*) filter (coalesce(is_current, false)) > 1)"
    )
    counts["empty_ranges"] = both("select count(*) from bad_dim_{n}s where valid_to <= valid_from")
    counts["overlaps"] = both(
        """select count(*) from bad_dim_{n}s a join bad_dim_{n}s b on a.{n}_id = b.{n}_id and a.{n}_sk < b.{n}_sk
           and a.valid_from < coalesce(b.valid_to, timestamp '9999-12-31') and b.valid_from < coalesce(a.valid_to, timestamp '9999-12-31')"""
    )
    return sql(" union all ".join(f"select '{name}' as test, ({count})::bigint as violations" for name, count in counts.items()))


ORACLE["run_tests"] = ORACLE["run_tests_kept"] = _report

# -- source repairs
add("backfill_created_at", "select * from tracked_customers")
_described = " ".join(f"when starts_with(category_name, '{p}') then '{d}'" for p, d in reversed(DESCRIPTIONS))
add("refresh_category_descriptions", f"select * replace (case {_described} else description end as description) from s_categories")
_totals = """select o.id_order, o.total_value::decimal(22,2) as stored_total,
    (o.shipping_value + coalesce((select sum(i.quantity * i.unit_price) from s_order_items i
      where i.id_order = o.id_order), 0))::decimal(22,2) as computed_total from s_orders o"""
add("compute_order_total", f"select id_order, computed_total as order_total from ({_totals})")
add("check_order_total", f"select * from ({_totals}) where stored_total <> computed_total")

# -- whole runs
_run_fact = """select o.id_order as order_id, o.id_customer as customer_id, v.customer_sk, o.order_date,
          o.current_status as order_status, o.total_value as order_total, o.shipping_value,
          ifnull(i.order_line_count, 0) as order_line_count, ifnull(i.total_quantity, 0) as total_quantity,
          ifnull(i.items_subtotal, 0)::decimal(20,2) as items_subtotal, p.payment_method, p.payment_status,
          p.payment_amount, p.payment_date, o.updated_at, {stamp} as _extracted_at
        from s_orders o left join run_dim v on o.id_customer = v.id_customer and o.order_date >= v.valid_from
          and (v.valid_to is null or o.order_date < v.valid_to)
        left join item_sums i on i.id_order = o.id_order left join payment_sums p on p.id_order = o.id_order"""
add("run_cycle", _run_fact.format(stamp=f"timestamp '{SECOND_RUN}'"))
_moved = " or ".join(f"({where})" for where in EARLIER["orders"][:2])
add("fct_orders_follow", _run_fact.format(stamp=f"if({_moved.replace('id_order', 'o.id_order')}, timestamp '{SECOND_RUN}', timestamp '{FIRST_RUN}')"))
add(
    "run_select",
    f"""select md5(id_product::varchar || '|' || '{FIRST_RUN}') as product_sk, id_product as product_id, sku, product_name,
          id_category as category_id, category_name, category_description, sale_price, unit_cost, current_stock,
          created_at, updated_at, least(created_at, timestamp '{FIRST_RUN}') as valid_from,
          null::timestamp as valid_to, true as is_current from named_products""",
)
