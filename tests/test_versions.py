"""A change table followed by version, and tables bucketed for Spark's planner."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import checks, merge, scd2
from tidemark.plans import bucketed, store
from tidemark.sources import versions
from tidemark.sources.landing import new_run_id

COLUMNS = "id bigint, v string, change_version bigint, op string"


class Log:
    """A change table that grows and is cut, and the table that it belongs to."""

    def __init__(self, spark, path):
        self.spark, self.path, self.rows, self.number = spark, path, {}, 0

    def add(self, *changes):
        out = []
        for key, value, op in changes:
            self.number += 1
            out.append((key, value, self.number, op))
            self.rows.pop(key, None)
            if op != "D":
                self.rows[key] = (key, value, self.number)
        self.spark.createDataFrame(out, COLUMNS).coalesce(1).write.mode("append").parquet(self.path)

    def expire(self, before):
        rows = [tuple(r) for r in self.spark.read.schema(COLUMNS).parquet(self.path).collect()]
        kept = [r for r in rows if r[2] >= before]
        self.spark.createDataFrame(kept, COLUMNS).write.mode("overwrite").parquet(self.path)

    def current(self):
        return self.spark.createDataFrame(list(self.rows.values()), "id bigint, v string, change_version bigint")


@pytest.fixture
def log(spark, tmp_path):
    return Log(spark, str(tmp_path / "changes"))


@pytest.fixture
def house(spark, tmp_path):
    return store.Warehouse(spark, str(tmp_path / "house"), buckets=2)


def follow(house, log, tmp_path):
    query = versions.follow_versions(house, "t", "id", log.path, COLUMNS, log.current, str(tmp_path / "progress"), step=2)
    query.awaitTermination()
    return query


def test_restarts_go_on_and_an_expired_log_refreshes(spark, house, log, tmp_path, rows, monkeypatch):
    log.add((1, "a", "I"), (2, "b", "I"), (3, "c", "I"))
    follow(house, log, tmp_path)
    assert rows(house.read("bronze/t")) == sorted(log.rows.values()) and house.head().watermarks == {"t": 3}
    log.add((1, "A", "U"), (2, None, "D"))
    log.add((4, "d", "I"), (1, "AA", "U"), (4, None, "D"))
    before = house.head().number
    follow(house, log, tmp_path)
    assert rows(house.read("bronze/t")) == sorted(log.rows.values()) and house.head().watermarks == {"t": 8}
    assert house.head().number == before + 1
    follow(house, log, tmp_path)
    assert house.head().number == before + 1  # nothing new, nothing published

    # killed before a batch is published; the next start does it again
    log.add((5, "e", "I"), (3, "C", "U"))
    with monkeypatch.context() as patch:
        patch.setattr(store.Warehouse, "publish", lambda *_: (_ for _ in ()).throw(OSError("driver lost here")))
        with pytest.raises(Exception, match="driver lost here"):
            follow(house, log, tmp_path)
    assert house.head().watermarks == {"t": 8}
    follow(house, log, tmp_path)
    assert rows(house.read("bronze/t")) == sorted(log.rows.values()) and house.head().watermarks == {"t": 10}

    # the log loses versions that were not read yet: the table is taken whole, and the stream starts behind it
    log.add((6, "f", "I"), (7, "g", "I"), (5, None, "D"))
    log.expire(12)
    follow(house, log, tmp_path)
    assert rows(house.read("bronze/t")) == sorted(log.rows.values()) and house.head().watermarks == {"t": 13}
    log.add((6, "F", "U"))
    follow(house, log, tmp_path)
    assert rows(house.read("bronze/t")) == sorted(log.rows.values()) and house.head().watermarks == {"t": 14}


def test_versions_are_cut_into_ranges(log):
    log.add(*[(k, "x", "I") for k in range(9)])
    reader = versions.VersionReader(["id", "change_version"], {"path": log.path, "version": "change_version", "after": "2", "step": "3"})
    assert reader.initialOffset() == {"version": 2} and reader.latestOffset() == {"version": 9}
    parts = reader.partitions({"version": 2}, {"version": 9})
    assert [(p.after, p.until) for p in parts] == [(2, 5), (5, 8), (8, 9)]
    seen = [v for p in parts for batch in reader.read(p) for v in batch.column("change_version").to_pylist()]
    assert seen == [3, 4, 5, 6, 7, 8, 9]
    assert reader.partitions({"version": 9}, {"version": 9}) == []
    assert versions.version_range("file://" + log.path, "change_version") == (1, 9)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_bucketed_tables_are_joined_without_exchange(spark, tmp_path, rows):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    names = {}

    def save(df, key="k"):
        name = f"t_{new_run_id()}"
        names[name] = str(tmp_path / name)
        return bucketed.save_bucketed(df, name, key, 4, names[name])

    try:
        target = spark.range(500).selectExpr("id as k", "cast(id % 7 as string) as v")
        batch = spark.range(400, 600).selectExpr("id as k", "'new' as v", "if(id % 3 = 0, 'D', 'U') as _operation")
        plain, quick = merge.merge(target, batch, "k"), merge.merge(save(target), save(batch), "k")
        assert exchanges(plain) > 0 == exchanges(quick) and rows(plain) == rows(quick)
        history = scd2.scd2_apply(scd2.empty_history(target), target, "k", ["v"], "2024-01-01 00:00:00")
        now = target.filter("k <> 3").withColumn("v", F.when(F.col("k") == 9, "x").otherwise(F.col("v")))
        step = [scd2.scd2_step(h, n, "k", ["v"], "2024-01-02 00:00:00") for h, n in ((history, now), (save(history), save(now)))]
        assert exchanges(step[1]) == 0 and rows(step[0]) == rows(step[1])
        child = spark.range(0, 700, 2).selectExpr("id as c")
        found = [checks.relationships(c, "c", t, "k") for c, t in ((child, target), (save(child, "c"), save(target)))]
        assert exchanges(found[1]) == 0 and rows(found[0]) == rows(found[1])
        assert exchanges(checks.unique(save(target), "k")) == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name, path in names.items():
            bucketed.drop_bucketed(spark, name, path)
