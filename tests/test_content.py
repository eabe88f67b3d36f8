"""Digests of content, keys as bitmaps, counts from footers, and jobs side by side."""

import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import checks
from tidemark.operators.digests import ContentMismatch, assert_same, digest_of
from tidemark.plans import cycle, store
from tidemark.sources import landing

ROWS = [(1, "a", None), (2, None, "a"), (2, None, "a"), (3, "c", "")]
SCHEMA = "k bigint, a string, b string"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def test_digest_tells_content_apart(spark):
    digest = digest_of(table(spark, ROWS))
    assert digest.rows == 4 and digest == digest_of(table(spark, ROWS[::-1]).repartition(3))
    for other in (
        [*ROWS[:3], (3, "", "c")],  # one value swapped, as many rows
        [(1, None, "a"), *ROWS[1:]],  # a value moved to another column
        [ROWS[0], ROWS[0], ROWS[1], ROWS[3]],  # other rows twice
        [*ROWS[:3], (3, "c", None)],
    ):
        assert len(other) == 4 and digest_of(table(spark, other)) != digest
        with pytest.raises(ContentMismatch):
            assert_same(digest, digest_of(table(spark, other)))
    assert digest_of(table(spark, [])).rows == 0


def test_landed_content_is_checked(spark, tmp_path):
    path, digest = landing.land_digested(table(spark, ROWS), str(tmp_path), "t", "one")
    assert landing.load(spark, path, table(spark, ROWS).schema, expected=digest).count() == 4
    table(spark, [*ROWS[:3], (3, "x", "")]).write.mode("overwrite").parquet(path)
    with pytest.raises(ContentMismatch, match="landing/t/one"):
        landing.load(spark, path, table(spark, ROWS).schema, expected=digest)


def test_merged_content_is_checked(spark, tmp_path):
    house = store.Warehouse(spark, str(tmp_path / "h"), buckets=2)
    commit = house.head().next()
    house.replace(commit, "t", table(spark, ROWS[:2]), "k")
    batch = table(spark, [(1, "new", "b", "U"), (2, None, None, "D"), (9, "x", "y", None)], SCHEMA + ", _operation string")
    house.merge_into(commit, "t", batch, "k")
    cycle.reconcile_merged(house, commit, "t", batch, "k")
    for wrong in ([(1, "new", "c", "U")], [(2, "back", None, "U")], [(1, None, None, "D")]):
        with pytest.raises(ContentMismatch):
            cycle.reconcile_merged(house, commit, "t", table(spark, wrong, batch.schema), "k")


def integers(kind, rnd):
    if kind == "dense":
        return [*range(-40_000, 40_000)]
    return [rnd.randint(-(2**60), 2**60) for _ in range(3000)]


@pytest.mark.parametrize("kind", ["dense", "sparse"])
def test_bitmaps_find_what_grouping_finds(spark, rows, kind):
    values = integers(kind, random.Random(4))
    for extra in ([], [None, None], [values[0], values[-1], values[-1], None]):
        df = table(spark, [(v,) for v in [*values, *extra]], "k bigint").repartition(4)
        assert rows(checks.unique_by_bitmap(df, "k")) == rows(checks.unique(df, "k"))
    parent = table(spark, [(v,) for v in [*values, None]], "p bigint")
    for child in (values, values[:5], [*values, None, None], [*values, max(values) + 1, min(values) - 1, min(values) - 1]):
        df = table(spark, [(v,) for v in child], "k bigint")
        assert rows(checks.relationships_by_bitmap(df, "k", parent, "p")) == rows(checks.relationships(df, "k", parent, "p"))
    none = table(spark, [], "k bigint")
    assert checks.unique_by_bitmap(none, "k").isEmpty() and checks.relationships_by_bitmap(none, "k", parent, "p").isEmpty()
    assert checks.relationships_by_bitmap(parent, "p", none, "k").count() == len(values)
    text = table(spark, [("a",), ("a",)], "k string")
    assert rows(checks.unique_by_bitmap(text, "k")) == [("a", 2)]


def test_bitmaps_do_not_list_a_clean_table(spark):
    df = spark.range(100_000).select(F.col("id").alias("k"))
    plan = checks.unique_by_bitmap(df, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" in plan or "LocalLimit 0" in plan


def test_footers_answer_null_counts(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    data = [(i if i % 3 else None, None, "x" * i, float(i)) for i in range(50)]
    table(spark, data, "a int, b string, `c d` string, e double").repartition(3).write.parquet(path)
    columns = ["a", "b", "c d", "e"]
    assert rows(checks.footer_counts(spark, path, columns)) == rows(checks.null_counts(spark.read.parquet(path), columns))
    with checks._settings(spark, {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}):
        plan = spark.read.parquet(path).agg(F.count("*"), F.count("a"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(a)]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_jobs_side_by_side_have_pools_and_fail_together(spark):
    seen, context = {}, spark.sparkContext
    context.setLocalProperty("callers.note", "kept")

    def work(name):
        assert spark.range(10).count() == 10
        seen[name] = (context.getLocalProperty("spark.scheduler.pool"), context.getLocalProperty("callers.note"))
        return name.upper()

    assert cycle.side_by_side(work, ["a", "b"], spark) == {"a": "A", "b": "B"}
    assert seen == {"a": ("a", "kept"), "b": ("b", "kept")}
    assert context.getLocalProperty("spark.scheduler.pool") is None
    assert context.getConf().get("spark.scheduler.mode") == "FAIR"
    started = threading.Event()

    def broken(name):
        if name == "slow":
            started.set()
            slow = F.expr("reduce(sequence(0, 100000 + cast(id as int)), 0L, (a, x) -> (a * 31 + x) % 1000003)")
            return spark.range(0, 10**6, numPartitions=64).select(F.sum(slow)).first()
        started.wait(30)
        time.sleep(2)
        raise KeyError("broken")

    begin = time.time()
    with pytest.raises(KeyError, match="broken"):
        cycle.side_by_side(broken, ["slow", "broken"], spark)
    assert time.time() - begin < 60 and not spark.sparkContext.statusTracker().getActiveJobsIds()
