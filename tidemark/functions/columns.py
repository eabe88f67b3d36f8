"""Column expressions shared by the layers. All are built-ins, so codegen stays on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(10,2)"
# First instant that is valid, first instant that is too late (years 1900 to 2100 are valid).
FIRST_VALID = "timestamp_ntz'1900-01-01 00:00:00'"
FIRST_INVALID = "timestamp_ntz'2101-01-01 00:00:00'"
OPEN_END = "timestamp_ntz'9999-12-31 00:00:00'"


def money(value: Column) -> Column:
    """Round half up to two decimals; an overflow raises under ANSI mode."""
    return value.cast(MONEY)


def clean_upper(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def clean_lower(name: str) -> Column:
    return F.lower(F.trim(F.col(name)))


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def year_out_of_range(value: Column) -> Column:
    """``year not between 1900 and 2100`` as plain bounds, which Parquet can filter on."""
    return (value < F.expr(FIRST_VALID)) | (value >= F.expr(FIRST_INVALID))


def missing_or_out_of_range(value: Column) -> Column:
    return value.isNull() | year_out_of_range(value)


def open_ended(valid_to: Column) -> Column:
    return F.coalesce(valid_to, F.expr(OPEN_END))


def version_key(parts: Sequence[str], valid_from: str) -> Column:
    """Surrogate key of one version; the order of the parts is part of the contract."""
    return F.md5(F.concat_ws("|", *[F.col(p).cast("string") for p in (*parts, valid_from)]))


def distinct_from(one: Column, other: Column) -> Column:
    """True when the values differ, with NULL equal only to NULL, also inside structs."""
    return ~one.eqNullSafe(other)
