"""A SQL Server database with change tracking as the source of a run.

Only small catalogue answers come to the driver. A table is pulled whole, in ranges of its
key, when it has to be refreshed fully; otherwise the database joins its change log with it
and sends the changed rows alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.types import cast_to_source_types
from tidemark.operators.merge import needs_full_refresh
from tidemark.plans.cycle import Source, SourceTable
from tidemark.sources.entities import ENTITIES
from tidemark.sources.jdbc import read_jdbc, split_predicates

Read = Callable[..., DataFrame]


def columns_query(table: str, schema: str = "dbo") -> str:
    return (
        "select column_name, data_type, numeric_precision, numeric_scale, ordinal_position "
        f"from information_schema.columns where table_schema = '{schema}' and table_name = '{table}'"
    )


def versions_query(table: str, schema: str = "dbo") -> str:
    return (
        "select change_tracking_current_version() as upper_version, "
        f"change_tracking_min_valid_version(object_id(N'{schema}.{table}')) as min_valid"
    )


def changes_query(table: str, key: str, columns: Iterable[str], after: int, schema: str = "dbo") -> str:
    """Changed rows since a version: the key from the log, the rest from the table if the row is still there."""
    rest = "".join(f", now.[{c}] as [{c.lower()}]" for c in columns if c.lower() != key)
    return (
        f"select log.[{key}] as [{key}]{rest}, log.sys_change_version as change_version, "
        f"log.sys_change_operation as op, case when now.[{key}] is null then 0 else 1 end as found "
        f"from changetable(changes {schema}.{table}, {after}) as log "
        f"left join {schema}.{table} as now on now.[{key}] = log.[{key}]"
    )


def starts_query(table: str, key: str, splits: int, schema: str = "dbo") -> str:
    """First keys of ``splits`` ranges that hold equally many rows, however unevenly the keys are spread.

    The database finds them in one pass over the index of the key and sends a row for each.
    """
    parts = f"select [{key}], ntile({splits}) over (order by [{key}]) as part from {schema}.{table} where [{key}] is not null"
    return f"select min([{key}]) as start from ({parts}) as ranges group by part"


def declared_columns(answer: DataFrame) -> dict[str, tuple]:
    """Column name to ``(type, precision, scale)``, in the order of the table."""
    rows = sorted(answer.collect(), key=lambda r: r["ordinal_position"])
    return {r["column_name"]: (r["data_type"], r["numeric_precision"], r["numeric_scale"]) for r in rows}


def sqlserver_source(
    spark: SparkSession,
    connection: Mapping[str, str],
    watermarks: Mapping[str, int],
    names: Iterable[str] = tuple(ENTITIES),
    splits: int = 16,
    read: Read = read_jdbc,
) -> Source:
    """All tables as of the version current now, or their changes behind the given watermarks.

    The version is asked for once and first, so every table is read at or after it and
    later changes come again with the next run. A table without a usable watermark is
    pulled whole, in ``splits`` ranges of its key with equally many rows.
    """

    def ask(query: str) -> DataFrame:
        return read(spark, connection, query)

    names = list(names)
    floors = {n: ask(versions_query(n)).first() for n in names}
    upper = min((f["upper_version"] for f in floors.values() if f["upper_version"] is not None), default=None)
    tables = {}
    for name in names:
        key = ENTITIES[name].key
        declared = declared_columns(ask(columns_query(name)))
        if not declared:
            raise RuntimeError(f"source table {name} has no columns")
        min_valid, last = floors[name]["min_valid"], watermarks.get(name)
        # Behind an expired watermark the log cannot be asked for; the table is refreshed fully then.
        if upper is not None and not needs_full_refresh(last, min_valid, upper):
            beside = {"change_version": ("bigint",), "op": ("nvarchar",), "found": ("int",)}
            changed = cast_to_source_types(ask(changes_query(name, key, declared, last)), {**declared, **beside})
            tables[name] = SourceTable(min_valid=min_valid, changed=changed)
            continue
        starts = [r["start"] for r in ask(starts_query(name, key, splits)).collect()]
        pulled = read(spark, connection, f"select * from dbo.{name}", split_predicates(f"[{key}]", starts))
        tables[name] = SourceTable(cast_to_source_types(pulled, declared), min_valid=min_valid)
    return Source(tables, upper)
