from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import cast_to_source_types, map_type
from tidemark.operators import conform, merge
from tidemark.sources import entities, landing

TARGET = "k bigint, v string"
BATCH = "k bigint, v string, _operation string"


def test_merge_cases(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (9, "keep")], TARGET)
    batch = spark.createDataFrame(
        [(1, "A", "U"), (4, "new", "U"), (2, "B", "I"), (3, None, "D"), (5, None, "D")], BATCH
    )
    assert rows(merge.merge(target, batch, "k")) == [(1, "A"), (2, "B"), (4, "new"), (9, "keep")]


def test_merge_null_operation_replaces_but_never_inserts(spark, rows):
    target = spark.createDataFrame([(1, "a")], TARGET)
    batch = spark.createDataFrame([(1, "A", None), (2, "B", None)], BATCH)
    assert rows(merge.merge(target, batch, "k")) == [(1, "A")]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(st.integers(0, 6), st.sampled_from("ab"), max_size=5),
    st.dictionaries(st.integers(0, 6), st.tuples(st.sampled_from("xy"), st.sampled_from(["I", "U", "D", None])), max_size=5),
)
def test_merge_is_idempotent_and_matches_a_dictionary(spark, rows, old, new):
    target = spark.createDataFrame(list(old.items()), TARGET)
    batch = spark.createDataFrame([(k, v, op) for k, (v, op) in new.items()], BATCH)
    want = {k: v for k, v in old.items() if k not in new}
    want |= {k: v for k, (v, op) in new.items() if op in ("I", "U") or (op is None and k in old)}
    once = merge.merge(target, batch, "k")
    assert rows(once) == sorted(want.items(), key=repr)
    assert rows(merge.merge(once, batch, "k")) == rows(once)


def test_latest_per_key_takes_the_last_and_limits_before_the_shuffle(spark, rows, capsys):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, "z")], "k bigint, n bigint, v string")
    last = merge.latest_per_key(df, ["k"], ["n"])
    assert rows(last, "k", "v") == [(1, "c"), (2, "z")]
    last.explain()
    assert capsys.readouterr().out.count("WindowGroupLimit") == 2


@pytest.mark.parametrize(
    "last,min_valid,upper,full",
    [(None, 1, 9, True), (5, None, 9, True), (2, 3, 9, True), (10, 3, 9, True), (3, 3, 9, False), (9, 3, 9, False)],
)
def test_refresh_decision(spark, last, min_valid, upper, full):
    assert merge.needs_full_refresh(last, min_valid, upper) is full
    df = spark.createDataFrame([(last, min_valid, upper)], "a bigint, b bigint, c bigint")
    assert df.select(merge.refresh_decision(F.col("a"), F.col("b"), F.col("c"))).first()[0] is full


def test_version_bounds_need_a_version(spark):
    log = spark.createDataFrame([(4,), (7,)], "change_version bigint")
    assert merge.read_bounds(log) == (7, 4)
    with pytest.raises(RuntimeError):
        merge.read_bounds(log.filter("change_version > 7"))


def test_full_refresh_replaces_everything(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b")], TARGET)
    batch = entities.full_extract(spark.createDataFrame([(2, "B"), (3, "C"), (None, "lost")], TARGET))
    assert rows(merge.full_refresh(target, batch, "k")) == [(2, "B"), (3, "C")]
    assert rows(merge.full_refresh(target, batch.filter("k > 99"), "k")) == []


def test_empty_batch_only_moves_the_watermark(spark, rows):
    target = spark.createDataFrame([(1, "a")], TARGET)
    state = spark.createDataFrame([("t", 3), ("u", 4)], merge.STATE_SCHEMA)
    update = spark.createDataFrame([("t", 8)], merge.STATE_SCHEMA)
    nothing = spark.createDataFrame([], BATCH)
    same, advanced = merge.advance_if_empty(target, state, nothing, "k", update)
    assert same is target
    assert rows(advanced) == [("t", 8), ("u", 4)]
    assert rows(merge.watermark(advanced, "t")) == [(8,)]
    assert rows(merge.watermark(advanced, "absent")) == []


def test_incremental_extract_takes_key_from_change(spark, rows):
    log = spark.createDataFrame(
        [(1, 5, "U"), (2, 6, "D"), (3, 2, "I"), (4, 7, "U"), (5, 99, "U")], "k bigint, change_version bigint, op string"
    )
    source = spark.createDataFrame([(1, "now"), (3, "old"), (5, "later")], TARGET)
    plain = entities.incremental_extract(log, source, "k", 2, upper=9)
    assert rows(plain) == [(1, "now", "U", 5), (2, None, "D", 6), (4, None, "U", 7)]
    gone = entities.incremental_extract(log, source, "k", 2, upper=9, absent_is_delete=True)
    assert rows(gone, "k", "_operation") == [(1, "U"), (2, "D"), (4, "D")]


def test_type_map():
    assert map_type("BIGINT") == T.LongType()
    assert map_type("tinyint") == map_type("smallint") == T.ShortType()
    assert map_type("decimal", 12, 3) == T.DecimalType(12, 3)
    assert map_type("numeric", 12) == T.DecimalType(12, 0)
    assert map_type("numeric") == T.DecimalType(38, 0)
    assert map_type("money", 19, 4) == T.DecimalType(19, 4)
    assert map_type("smallmoney") == T.DecimalType(10, 4)
    assert map_type("real") == T.DoubleType()
    assert map_type("bit") == T.BooleanType()
    assert map_type("date") == map_type("datetime2") == T.TimestampNTZType()
    assert map_type("time") == map_type("uniqueidentifier") == map_type("datetimeoffset") == T.StringType()
    assert map_type("image") == T.BinaryType()


def test_cast_to_source_types_raises_on_bad_values(spark):
    df = spark.createDataFrame([("x",)], "n string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cast_to_source_types(df, {"n": ("int",)}).collect()


def test_timestamps_become_naive_utc(spark):
    texts = ["2024-01-01 10:00:00.123456+02:00", "2024-01-01 10:00:00Z", "2024-01-01 10:00:00.5", "1960-06-01 00:00:00.000001-03:00"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, at string")
    want = [
        "2024-01-01 08:00:00.123456",
        "2024-01-01 10:00:00.000000",
        "2024-01-01 10:00:00.500000",
        "1960-06-01 03:00:00.000001",
    ]
    for zone in ("UTC", "America/Sao_Paulo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            out = conform.normalize_ts(df, ["at"]).orderBy("i").select(conform.iso_text(F.col("at"))).collect()
            assert [r[0] for r in out] == want
            instants = df.select("i", F.col("at").cast("timestamp").alias("at")).filter("i <> 2")
            out = conform.normalize_ts(instants, ["at"]).orderBy("i").select(conform.iso_text(F.col("at"))).collect()
            assert [r[0] for r in out] == [want[0], want[1], want[3]]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform.normalize_ts(spark.createDataFrame([("soon",)], "at string"), ["at"]).collect()


def test_conform_and_load_by_name(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    shaped = conform.conform(spark.createDataFrame([(1, 2)], "a int, extra int"), schema)
    assert shaped.columns == ["a", "b", "_operation", "_extracted_at"]
    assert tuple(shaped.first()) == (1, None, None, None)
    loaded = conform.load_by_name(spark.createDataFrame([("x", "7")], "B string, A string"), schema)
    assert tuple(loaded.first()) == (7, "x")
    with pytest.raises(ValueError, match="only in case"):
        conform.load_by_name(spark.createDataFrame([(1, 2)], "a int, A int"), schema)
    stamped = conform.with_extracted_at(shaped, "2024-01-01 00:00:00.000009")
    assert stamped.first()["_extracted_at"] == datetime(2024, 1, 1, 0, 0, 0, 9)


def test_schema_of_a_source(spark, rows):
    source = spark.createDataFrame([(1, 2)], "ID int, Name int")
    assert entities.read_schema(source).fieldNames() == ["id", "name"]
    assert rows(entities.schema_rows(source), "ordinal", "column_name") == [(1, "id"), (2, "name")]
    empty = spark.createDataFrame([], T.StructType([]))
    assert entities.read_schema(empty, required=False) is None
    with pytest.raises(ValueError):
        entities.read_schema(empty)


def test_landing_counts_and_purges(spark, tmp_path):
    df = spark.range(10)
    path, written = landing.land(df, str(tmp_path), "t", landing.new_run_id())
    assert written == 10
    assert landing.load(spark, path, df.schema, expected=10).count() == 10
    with pytest.raises(conform.CountMismatch):
        landing.load(spark, path, df.schema, expected=11)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        landing.land(df, str(tmp_path), "t", path.rsplit("/", 1)[1])
    assert landing.purge(spark, path)
    assert not (tmp_path / "landing" / "t" / path.rsplit("/", 1)[1]).exists()


def test_full_refresh_sorts_rows_of_repeated_keys_only(spark, rows):
    target = spark.createDataFrame([], "k bigint, v string, at int")
    sound = spark.createDataFrame([(1, "a", 1), (2, None, 2), (None, "lost", 3)], target.schema)
    once = merge.full_refresh(target, sound, "k", ["at"])
    assert rows(once) == [(1, "a", 1), (2, None, 2)]
    assert "Window" not in once._jdf.queryExecution().optimizedPlan().toString()
    # the newest row of a key stays, the other columns break ties, and equal rows are one
    more = sound.unionAll(spark.createDataFrame([(1, "b", 0), (3, "x", 4), (3, "y", 4), (3, None, 4), (4, "z", 5), (4, "z", 5)], target.schema))
    want = [(1, "a", 1), (2, None, 2), (3, "y", 4), (4, "z", 5)]
    assert rows(merge.full_refresh(target, more, "k", ["at"])) == want
