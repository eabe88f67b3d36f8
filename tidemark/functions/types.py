"""Source catalogue types and their Spark counterparts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source type name -> Spark type. Names not listed become strings.
SOURCE_TYPES: Mapping[str, T.DataType] = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
    "tinyint": T.ShortType(),
    "decimal": T.DecimalType(38, 0),
    "numeric": T.DecimalType(38, 0),
    "money": T.DecimalType(19, 4),
    "smallmoney": T.DecimalType(10, 4),
    "float": T.DoubleType(),
    "real": T.DoubleType(),
    "bit": T.BooleanType(),
    "date": T.TimestampNTZType(),
    "datetime": T.TimestampNTZType(),
    "datetime2": T.TimestampNTZType(),
    "smalldatetime": T.TimestampNTZType(),
    "time": T.StringType(),
    "binary": T.BinaryType(),
    "varbinary": T.BinaryType(),
    "image": T.BinaryType(),
}


def map_type(sql_type: str, precision: int | None = None, scale: int | None = None) -> T.DataType:
    """Spark type of a source column; exact numerics keep their declared precision."""
    name = sql_type.lower()
    if precision is not None and name in ("decimal", "numeric"):
        return T.DecimalType(precision, scale or 0)
    return SOURCE_TYPES.get(name, T.StringType())


def cast_to_source_types(df: DataFrame, declared: Mapping[str, tuple]) -> DataFrame:
    """Project ``df`` to the declared columns, each cast to its mapped type.

    ``declared`` maps a column name to ``(sql_type,)`` or ``(sql_type, precision, scale)``.
    """
    return df.select(*[F.col(name).cast(map_type(*spec)).alias(name.lower()) for name, spec in declared.items()])
