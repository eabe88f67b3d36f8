"""Type 2 steps, the fold over a feed, and the joins on validity ranges."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ranges, scd2, skew
from tidemark.session import checkpointed

DAY0 = datetime(2020, 1, 1)
SOURCE = "k bigint, v string, note string"
FEED = "k bigint, v string, change_ts timestamp_ntz, change_version bigint, op string"


def day(n):
    return DAY0 + timedelta(days=n)


def versions(df):
    out = [(r.k, r.v, r.dbt_valid_from, r.dbt_valid_to) for r in df.collect()]
    return sorted(out, key=repr)


def apply(spark, history, source_rows, n):
    source = spark.createDataFrame(source_rows, SOURCE)
    history = scd2.empty_history(source) if history is None else history
    return scd2.scd2_apply(history, source, "k", ["v"], day(n))


def test_step_opens_keeps_and_closes(spark):
    first = apply(spark, None, [(1, "a", "x"), (2, "b", "x"), (3, None, "x"), (4, "d", "x"), (5, None, "x")], 0)
    assert {r[2:] for r in versions(first)} == {(day(0), None)}
    same = apply(spark, first, [(1, "a", "other"), (2, "b", "x"), (3, None, "x"), (4, "d", "x"), (5, None, "x")], 1)
    assert versions(same) == versions(first)
    assert {r.note for r in same.collect()} == {"x"}  # an unwatched column alone changes nothing
    # 1 changes, 2 is deleted, 3 NULL to value, 4 value to NULL, 5 NULL to NULL, 6 is new
    third = apply(spark, same, [(1, "A", "y"), (3, "c", "y"), (4, None, "y"), (5, None, "y"), (6, "f", "y")], 2)
    assert versions(third) == sorted(
        [
            (1, "a", day(0), day(2)),
            (1, "A", day(2), None),
            (2, "b", day(0), day(2)),
            (3, None, day(0), day(2)),
            (3, "c", day(2), None),
            (4, "d", day(0), day(2)),
            (4, None, day(2), None),
            (5, None, day(0), None),
            (6, "f", day(2), None),
        ],
        key=repr,
    )
    # 2 reappears after a gap
    again = apply(spark, third, [(2, "b", "z"), (1, "A", "z")], 3)
    assert [(r[2], r[3]) for r in versions(again) if r[0] == 2] == [(day(0), day(2)), (day(3), None)]
    assert again.count() == again.select("dbt_scd_id").distinct().count()


def test_step_may_leave_deleted_keys_open(spark):
    first = apply(spark, None, [(1, "a", "x")], 0)
    source = spark.createDataFrame([], SOURCE)
    kept = scd2.scd2_apply(first, source, "k", ["v"], day(1), hard_deletes=False)
    assert versions(kept) == [(1, "a", day(0), None)]


def test_duplicate_source_keys_are_refused(spark):
    with pytest.raises(ValueError, match="not unique"):
        scd2.assert_unique(spark.createDataFrame([(1, "a", ""), (1, "b", "")], SOURCE), "k")


def random_feed(seed, n, hot=True):
    """Changes where one key has a third of the rows, with ties, deletes and NULLs."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = 0 if hot and rnd.random() < 0.34 else rnd.randrange(1, 12)
        when = day(rnd.randrange(n // 2) if key == 0 else rnd.randrange(40))
        out.append((key, rnd.choice(["a", "b", None]), when, i, rnd.choice("IUUUD")))
    return out


def fold_by_hand(feed):
    """The same history in plain Python: last change per instant, then version by version."""
    last = {}
    for k, v, ts, n, op in feed:
        if (k, ts) not in last or last[k, ts][0] < n:
            last[k, ts] = (n, v, op)
    out, open_ = [], {}
    for (k, ts), (_, v, op) in sorted(last.items()):
        if k in open_ and (op == "D" or open_[k][0] != v):
            old, start = open_.pop(k)
            out.append((k, old, start, ts))
        if op != "D" and k not in open_:
            open_[k] = (v, ts)
    out += [(k, v, ts, None) for k, (v, ts) in open_.items()]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fold_matches_plain_python_with_and_without_cuts(spark, seed):
    rows = random_feed(seed, 300)
    feed = spark.createDataFrame(rows, FEED)
    want = fold_by_hand(rows)
    assert versions(scd2.scd2_fold(feed, "k", ["v"])) == want
    cuts = skew.find_cuts(feed, "k", "change_ts", rows_per_slice=20)
    assert any(k == 0 and len(points) > 3 for k, points in cuts.rows)
    assert versions(scd2.scd2_fold(feed, "k", ["v"], cuts=cuts)) == want


def test_fold_survives_one_crowded_instant(spark):
    rows = [(0, "a", day(i), i, "U") for i in range(10)] + [(0, "b" if i % 2 else None, day(4), 100 + i, "U") for i in range(200)]
    rows += [(1, "z", day(2), 999, "I")]
    feed = spark.createDataFrame(rows, FEED)
    cuts = skew.find_cuts(feed, "k", "change_ts", rows_per_slice=20)
    assert cuts.crowded
    assert versions(scd2.scd2_fold(feed, "k", ["v"], cuts=cuts)) == fold_by_hand(rows)


def test_fold_equals_steps_batch_by_batch(spark):
    rows = [(k, v, ts, n, op) for k, v, ts, n, op in random_feed(7, 60, hot=False) if ts < day(12)]
    feed = spark.createDataFrame(rows, FEED)
    history, alive = None, {}
    for ts in sorted({r[2] for r in rows}):
        for k, v, _, _, op in sorted((r for r in rows if r[2] == ts), key=lambda r: r[3]):
            alive.pop(k, None)
            if op != "D":
                alive[k] = v
        source = spark.createDataFrame(list(alive.items()), "k bigint, v string")
        if history is None:
            history = scd2.empty_history(source)
        step = scd2.scd2_apply(history, source, "k", ["v"], ts)
        history = spark.createDataFrame(step.collect(), step.schema)
    assert versions(scd2.scd2_fold(feed, "k", ["v"])) == versions(history)
    ids = {r.dbt_scd_id for r in history.collect()}
    assert ids == {r.dbt_scd_id for r in scd2.scd2_fold(feed, "k", ["v"]).collect()}


def test_plain_fold_has_one_shuffle(spark, capsys):
    feed = spark.createDataFrame(random_feed(1, 20), FEED)
    scd2.scd2_fold(feed, "k", ["v"]).explain()
    assert capsys.readouterr().out.count("Exchange") == 1


DIM = "k bigint, sk string, valid_from timestamp_ntz, valid_to timestamp_ntz"
FACT = "id bigint, k bigint, at timestamp_ntz"


def in_force(facts, dim):
    out = []
    for i, k, at in facts:
        hits = [
            sk for dk, sk, lo, hi in dim if dk == k and None not in (k, at) and at >= lo and (hi is None or at < hi)
        ]
        out += [(i, sk) for sk in hits] or [(i, None)]
    return sorted(out, key=repr)


def hot_history(seed, n):
    """Chained versions with gaps; key 0 has most of them. Facts crowd on one instant."""
    rnd = random.Random(seed)
    dim = []
    for k, count in [(0, n), (1, 3), (2, 1)]:
        at = 0
        for i in range(count):
            end = at + rnd.randrange(1, 4)
            dim.append((k, f"{k}-{i:04d}", day(at), None if i == count - 1 and k != 1 else day(end)))
            at = end + rnd.choice([0, 0, 2])
    facts = [(i, rnd.choice([0, 0, 0, 1, 2, 3, None]), day(rnd.randrange(3 * n))) for i in range(4 * n)]
    facts += [(10_000 + i, 0, day(n)) for i in range(2 * n)]
    facts += [(20_000, 0, None), (20_001, 0, day(-5))]
    return facts, dim


@pytest.mark.parametrize("seed", [1, 2])
def test_version_in_force_with_and_without_cuts(spark, rows, seed):
    facts, dim = hot_history(seed, 60)
    want = in_force(facts, dim)
    f, v = spark.createDataFrame(facts, FACT), spark.createDataFrame(dim, DIM)
    moments = f.select("k", "at").unionAll(v.select("k", "valid_from"))
    cuts = skew.find_cuts(moments, "k", "at", rows_per_slice=15)
    assert cuts is not None
    for cut in (None, cuts):
        assert rows(ranges.asof_version(f, v, "k", "at", "sk", cut), "id", "sk") == want
        assert rows(ranges.range_join(f, v, "k", "at", cut), "id", "sk") == want
        assert rows(ranges.versions_in_force(f, v, "k", "at", "sk", cut), "id", "sk") == want
    assert not ranges.has_overlap(v, "k", "sk") and not ranges.has_overlap(v, "k", "sk", cuts)


def test_ends_are_half_open(spark, rows):
    dim = [(1, "a", day(0), day(5)), (1, "b", day(5), day(8)), (1, "c", day(10), None)]
    facts = [(0, 1, day(0)), (1, 1, day(5)), (2, 1, day(8)), (3, 1, day(-1)), (4, 1, day(10)), (5, 9, day(1))]
    f, v = spark.createDataFrame(facts, FACT), spark.createDataFrame(dim, DIM)
    want = [(0, "a"), (1, "b"), (2, None), (3, None), (4, "c"), (5, None)]
    assert rows(ranges.asof_version(f, v, "k", "at", "sk"), "id", "sk") == want
    assert rows(ranges.range_join(f, v, "k", "at"), "id", "sk") == want


def test_range_join_repeats_facts_for_overlapping_versions(spark, rows):
    rnd = random.Random(5)
    dim = [(0, f"v{i:03d}", day(a := rnd.randrange(60)), rnd.choice([day(a + 1), day(a + rnd.randrange(0, 9))])) for i in range(25)]
    dim += [(0, f"w{i:03d}", day(61 + 2 * i), day(62 + 2 * i)) for i in range(20)] + [(1, "x", day(5), None), (1, "y", day(9), None)]
    facts = [(i, rnd.choice([0, 0, 1, 2, None]), day(rnd.randrange(110))) for i in range(150)]
    f, v = spark.createDataFrame(facts, FACT), spark.createDataFrame(dim, DIM)
    cuts = skew.find_cuts(f, "k", "at", rows_per_slice=10)
    for cut in (None, cuts):
        assert rows(ranges.range_join(f, v, "k", "at", cut), "id", "sk") == in_force(facts, dim)
        assert rows(ranges.versions_in_force(f, v, "k", "at", "sk", cut), "id", "sk") == in_force(facts, dim)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_overlapping_pairs_against_all_pairs(spark, rows, seed):
    rnd = random.Random(seed)
    dim = []
    for i in range(60):
        a = rnd.randrange(200)
        dim.append((rnd.choice([0, 0, 1]), f"v{i:03d}", day(a), rnd.choice([day(a + rnd.randrange(-1, 6)), day(a + 40), day(a + 1)])))
    dim += [(0, "open", day(190), None)]
    far = datetime(9999, 12, 31)
    want = sorted(
        (k1, s1, s2)
        for k1, s1, f1, t1 in dim
        for k2, s2, f2, t2 in dim
        if k1 == k2 and s1 < s2 and f1 < (t2 or far) and f2 < (t1 or far)
    )
    v = spark.createDataFrame(dim, DIM)
    cuts = skew.find_cuts(v, "k", "valid_from", rows_per_slice=6)
    assert want and cuts is not None
    for cut in (None, cuts):
        assert rows(ranges.overlapping_pairs(v, "k", "sk", cut)) == want
        assert ranges.has_overlap(v, "k", "sk", cut)


def test_versions_that_do_not_touch_need_no_ranks(spark, rows):
    """Facts are ranked only where versions overlap; a sound table is matched by the sorted pass alone."""
    dim = [(k, f"{k}-{i}", day(i), day(i + 1)) for k in (1, 2) for i in range(5)]
    facts = [(i, k, day(n)) for i, (k, n) in enumerate([(1, 0), (1, 4), (1, 9), (2, 2), (3, 1), (None, 1)])]
    f = spark.createDataFrame(facts, "id bigint, k bigint, at timestamp_ntz")
    for more, ranked in (([], False), ([(1, "over", day(3), None)], True)):
        v = spark.createDataFrame(dim + more, DIM)
        got = ranges.versions_in_force(f, v, "k", "at", "sk")
        assert ("_rank" in got._jdf.queryExecution().optimizedPlan().toString()) == ranked
        assert rows(got, "id", "sk") == in_force(facts, dim + more)


def test_overlaps_are_found_in_one_pass(spark, rows, monkeypatch):
    """Keys with too many overlaps are told by the pass that pairs the others, hot keys by their slices."""
    dim = [(k, f"{k}-{i:02d}", day(i), day(i + n)) for k, n in ((1, 2), (2, ranges.NEAR + 1), (3, ranges.NEAR + 2)) for i in range(12)]
    v = spark.createDataFrame(dim, DIM).withColumn("_until", F.col("valid_to"))
    passed = ranges._near_pairs(v, "k", "sk", None)
    assert [r.k for r in passed.filter("_beyond").select("k").distinct().collect()] == [3]
    cuts = skew.find_cuts(v.filter("k = 1").union(v.filter("k = 1")), "k", "valid_from", rows_per_slice=6)
    hot = ranges._near_pairs(v, "k", "sk", cuts).filter("k = 1")
    assert 1 < hot.count() < 12 and hot.filter("not _beyond or size(_met) > 0").isEmpty()
    want = sorted((a[0], a[1], b[1]) for a in dim for b in dim if a[0] == b[0] and a[1] < b[1] and b[2] < a[3])
    for cut in (None, cuts):
        assert rows(ranges.overlapping_pairs(v.drop("_until"), "k", "sk", cut)) == want


def test_pairs_of_neighbours_need_no_join(spark, rows):
    """Versions that overlap few others are paired in the sorted pass; only crowded keys are joined by rank."""
    dim = [(k, f"{k}-{i}{twice}", day(i), day(i + 1) + late) for k in (1, 2) for i in range(30) for twice, late in (("", timedelta(0)), ("x", timedelta(hours=20)))]
    dim += [(1, None, day(3), day(9)), (None, "n", day(3), day(9)), (1, "m", None, day(9))]
    crowd = [(3, f"c{i:02d}", day(5), day(6 + i % 4)) for i in range(9)]
    for data, joined in ((dim, False), (dim + crowd, True)):
        pairs = ranges.overlapping_pairs(spark.createDataFrame(data, DIM), "k", "sk")
        sound = [r for r in data if None not in r[:3]]
        want = [(a[0], a[1], b[1]) for a in sound for b in sound if a[0] == b[0] and a[1] < b[1] and a[2] < b[3] and b[2] < a[3]]
        assert rows(pairs) == sorted(want, key=repr)
        assert ("Join" in pairs._jdf.queryExecution().optimizedPlan().toString()) == joined


def test_facts_without_key_are_spread(spark):
    facts = spark.range(4000).selectExpr("id", "case when id < 0 then id end as k", "timestamp_ntz'2020-01-01' as at")
    versions_ = spark.createDataFrame([(1, "a", day(0), None)], DIM)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for joined in (ranges.range_join(facts, versions_, "k", "at"), ranges.asof_version(facts, versions_, "k", "at", "sk")):
            parts = joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("sk").alias("sk"))
            sizes = [r["n"] for r in parts.collect()]
            assert len(sizes) == 4 and max(sizes) < 1500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_neither_join_compares_all_rows(spark, capsys):
    facts, dim = hot_history(1, 5)
    f, v = spark.createDataFrame(facts, FACT), spark.createDataFrame(dim, DIM)
    ranges.asof_version(f, v, "k", "at", "sk").explain()
    ranges.range_join(f, v, "k", "at").explain()
    plan = capsys.readouterr().out
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_cuts_only_for_hot_keys(spark):
    data = [(0, day(i)) for i in range(400)] + [(1 + i % 50, day(i)) for i in range(400)] + [(None, day(1))] * 100
    df = spark.createDataFrame(data, "k bigint, at timestamp_ntz")
    assert skew.find_cuts(df, "k", "at", rows_per_slice=1000) is None
    cuts = skew.find_cuts(df, "k", "at", rows_per_slice=50)
    assert [k for k, _ in cuts.rows] == [0]
    sliced = skew.with_slice(df.withColumn("id", F.monotonically_increasing_id()), "k", "at", cuts, ["id"])
    sizes = {(r.k, r[1]): r["count"] for r in sliced.groupBy("k", skew.SLICE).count().collect()}
    assert max(n for (k, _), n in sizes.items() if k == 0) < 120
    assert max(n for (k, _), n in sizes.items() if k is None) < 10
    assert sliced.count() == len(data)


def test_every_key_above_a_slice_is_cut_by_its_own_size(spark):
    data = [(k, day(i)) for k in range(40) for i in range(70)] + [(99, day(i % 700)) for i in range(3000)] + [(500 + i, day(i)) for i in range(200)]
    df = spark.createDataFrame(data, "k bigint, at timestamp_ntz")
    cuts = skew.find_cuts(df, "k", "at", rows_per_slice=50)
    sizes = dict((k, len(points)) for k, points in cuts.rows)
    assert set(sizes) == {*range(40), 99} and sizes[99] == 60 and cuts.longest == 60
    sliced = skew.with_slice(df, "k", "at", cuts).groupBy("k", skew.SLICE).count()
    assert max(r["count"] for r in sliced.collect()) <= 100


def test_a_chain_of_overlaps_costs_what_comes_out(spark):
    """Each version overlaps the next one only; ranks spell out exactly the pairs."""
    n = 20_000
    chain = spark.range(n).selectExpr(
        "1L as k", "lpad(cast(id as string), 9, '0') as sk",
        "timestamp_ntz'2020-01-01' + make_dt_interval(0, 0, 0, id * 2) as valid_from",
        "timestamp_ntz'2020-01-01' + make_dt_interval(0, 0, 0, id * 2 + 3) as valid_to",
    )
    pairs = ranges.overlapping_pairs(chain, "k", "sk")
    assert pairs.count() == n - 1
    assert pairs.filter("cast(overlapping_version as int) - cast(first_version as int) <> 1").count() == 0


def test_one_version_over_many_blocks_of_facts(spark, monkeypatch):
    monkeypatch.setattr(ranges, "BLOCK", 16)
    facts = spark.range(300).selectExpr("id", "1L as k", "timestamp_ntz'2020-01-01' + make_dt_interval(cast(id div 3 as int)) as at")
    dim = spark.createDataFrame([(1, "a", day(5), day(80)), (1, "b", day(0), None)], DIM)
    got = ranges.range_join(facts, dim, "k", "at")
    want = [(i, "b") for i in range(300)] + [(i, "a") for i in range(300) if 5 <= i // 3 < 80]
    assert sorted((r.id, r.sk) for r in got.collect()) == sorted(want)


CHECKED = "k bigint, a string, b string, note string"


def versions_of(spark, rows):
    return spark.createDataFrame(rows, CHECKED)


@pytest.mark.parametrize("most", [0, 10**6])
@pytest.mark.parametrize("hard_deletes", [True, False])
def test_two_phases_give_what_one_gives(spark, rows, most, hard_deletes):
    first = [(1, "x", None, "n"), (2, None, "x", "n"), (3, "y", "y", "n"), (4, None, None, "n"), (5, "z", "z", "n")]
    second = [(1, None, "x", "n"), (2, None, "x", "other"), (4, None, "", "n"), (5, "z", "z", "n"), (6, "q", "q", "n"), (None, "q", "q", "n")]

    def narrow(*args):
        return scd2.scd2_step_changed(*args, most=most)

    for stored in (False, True):
        out = []
        for step in (scd2.scd2_step, narrow):
            sides = [versions_of(spark, r) for r in (first, second, first)]
            if stored and step is narrow:
                sides = [s.withColumn(scd2.DIGEST, scd2.check_digest(["a", "b"])) for s in sides]
            history = scd2.empty_history(sides[0])
            for k, side in enumerate(sides):
                history = scd2.scd2_apply(history, side, "k", ["a", "b"], f"2024-01-0{k + 1} 00:00:00", hard_deletes, step)
            out.append(rows(history.drop(scd2.DIGEST)))
        assert out[0] == out[1]


def test_a_digest_that_differs_without_cause_makes_no_version(spark, rows):
    source = versions_of(spark, [(1, "x", None, "n"), (2, "y", "y", "n")])
    history = scd2.scd2_apply(scd2.empty_history(source), source, "k", ["a", "b"], "2024-01-01 00:00:00")
    stale = history.withColumn(scd2.DIGEST, F.struct(F.lit(1).cast("bigint").alias("a"), F.lit(2).cast("bigint").alias("b")))
    now = source.withColumn(scd2.DIGEST, scd2.check_digest(["a", "b"]))
    after = scd2.scd2_step_changed(stale.select(*now.columns, *scd2.METADATA.names), now, "k", ["a", "b"], "2024-01-02 00:00:00")
    assert rows(after.drop(scd2.DIGEST)) == rows(history)


def shuffled_rows(df, columns):
    """Rows that went through exchanges which carry one of ``columns``, after the frame was run."""
    plan, found = df._jdf.queryExecution().executedPlan(), 0
    df._jdf.queryExecution().toRdd().count()
    todo = [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if "AdaptiveSparkPlan" in name:
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in name or name == "ReusedExchange":
            todo.append(node.plan() if "QueryStage" in name else node.child())
            continue
        if name == "Exchange" and any(c in node.output().toString() for c in columns):
            found += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_only_changed_rows_are_shuffled_whole(spark):
    source = spark.range(5000).selectExpr("id as k", "cast(id as string) as a", "'b' as b", "repeat('n', 50) as note")
    history = checkpointed(scd2.scd2_apply(scd2.empty_history(source), source, "k", ["a", "b"], "2024-01-01 00:00:00"))
    changed = source.filter("k <> 7").withColumn("a", F.when(F.col("k") % 1000 == 3, "new").otherwise(F.col("a")))
    wide = scd2.scd2_apply(history, changed, "k", ["a", "b"], "2024-01-02 00:00:00")
    narrow = scd2.scd2_apply(history, changed, "k", ["a", "b"], "2024-01-02 00:00:00", step=scd2.scd2_step_changed)
    whole = ("note", "_old", "_new")
    assert shuffled_rows(narrow, whole) <= 11 < 9000 < shuffled_rows(wide, whole)
    assert narrow.count() == 5005
