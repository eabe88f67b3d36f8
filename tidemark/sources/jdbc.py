"""Reading a table or a change query of a relational source through a JDBC driver."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def split_predicates(key: str, starts: Iterable[int]) -> list[str]:
    """Conditions that cut a table into ranges of ``key``, which begin at the given values but for the first.

    Every row meets exactly one of them, one without a key the first, whatever the values:
    stale starts cost balance, never rows.
    """
    cuts = sorted(set(starts))[1:]
    if not cuts:
        return ["1 = 1"]
    between = [f"{key} >= {low} and {key} < {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"{key} < {cuts[0]} or {key} is null", *between, f"{key} >= {cuts[-1]}"]


def read_jdbc(spark: SparkSession, connection: Mapping[str, str], query: str, predicates: Sequence[str] = ()) -> DataFrame:
    """The rows of a query; with predicates one task reads those of each.

    ``connection`` holds the reader's options, ``url`` and ``driver`` among them.
    """
    options = {"fetchsize": "10000", **connection}
    if not predicates:
        return spark.read.format("jdbc").options(**options, query=query).load()
    url = options.pop("url")
    # A split read takes the query as a derived table.
    return spark.read.jdbc(url, f"({query}) as pulled", predicates=list(predicates), properties=options)
