import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.corpus import frame, odd_texts, texts
from tidemark.llm import jaccard_join
from tidemark.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(UPPER))
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def brute(ids, rows):
    sets = [shingles(t) for t in rows]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for k, (i, x) in enumerate(zip(ids, sets)):
        for j, y in zip(ids[:k], sets[:k]):
            if x and y and i is not None and j is not None and 100 * len(x & y) >= 80 * len(x | y):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return collections.Counter((i, len(s), None if i is None else root(i)) for i, s in zip(ids, sets))


def rows_for(seed):
    rnd = random.Random(seed)
    word = lambda n: [f"W{rnd.randrange(40)}" for _ in range(n)]
    out = []
    for _ in range(5):
        own = word(rnd.choice([6, 12, 30, 80]))
        for _ in range(rnd.choice([1, 5, 30])):
            copy = list(own)
            for _ in range(rnd.randint(0, max(1, len(own) // 25))):
                copy[rnd.randrange(len(copy))] = rnd.choice(word(1))
            out.append(" ".join(copy))
    passage = word(30)
    out += [" ".join(word(rnd.randint(0, 20)) + passage + word(rnd.randint(0, 20))) for _ in range(30)]
    return [*out, out[0], out[0].lower(), "a b c d", "A  b\tc d", *odd_texts()]


@pytest.mark.parametrize("seed, fanout, sent", [(13, 256, 10**6), (7, 3, 0)])
def test_groups_agree_with_all_pairs(spark, monkeypatch, seed, fanout, sent):
    monkeypatch.setattr(jaccard_join, "FANOUT", fanout)
    monkeypatch.setattr(jaccard_join, "BROADCAST_PAIRS", sent)
    rows = rows_for(seed)
    ids = [None if k % 17 == 3 else k for k in range(len(rows))]
    got = jaccard_join.jaccard_groups(frame(spark, rows, ids).withColumnRenamed("lang", "tag"))
    want = brute(ids, rows)
    assert len({w[2] for w in want}) < len(rows) - 20
    assert collections.Counter(tuple(r) for r in got.collect()) == want


def test_one_of_each_group(spark):
    rows = ["a b c d e f g", "A b c d e f g", "other text here", None, "", "a b c d e f g"]
    got = jaccard_join.one_of_each_group(frame(spark, rows, [4, 2, 7, 8, 9, None])).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted([(2, rows[1]), (7, rows[2]), (8, None), (9, ""), (None, rows[5])], key=repr)
    assert jaccard_join.jaccard_groups(frame(spark, [])).count() == 0


def test_components_do_not_stop_after_a_number_of_rounds(spark, monkeypatch):
    monkeypatch.setattr("tidemark.llm.components.ROUNDS", 1, raising=False)
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)], "a long, b long")
    assert {r.component for r in components(edges).collect()} == {0}


def test_components_of_a_long_chain_and_a_star(spark):
    rnd = random.Random(1)
    names = list(range(120))
    rnd.shuffle(names)
    edges = list(zip(names[:60], names[1:60])) + [(names[60], x) for x in names[61:]] + [(500, 500)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {x: min(names[:60]) for x in names[:60]} | {x: min(names[60:]) for x in names[60:]} | {500: 500}
    assert got == want


def test_a_set_met_by_many_tasks_is_looked_up_once(spark, tmp_path):
    """One set in 16 tasks: each has its text, one row is taken."""
    rows = ["one two three four five six seven eight nine ten"] * 64 + texts(8, 20)
    docs = frame(spark, rows).repartition(16)
    own = docs.select("doc_id", "text").mapInArrow(jaccard_join._keyed_rows, "doc_id long, t long, tag long, n long, task int, packed binary")
    path = str(tmp_path / "own")
    own.write.parquet(path)
    held = spark.read.parquet(path).filter("packed is not null")
    holders = held.groupBy("t", "tag").agg(F.min("task").alias("task"))
    often = held.groupBy("t", "tag").count().agg(F.max("count")).first()[0]
    classes = jaccard_join.Classes(held.select("t", "tag", "task", "packed"), holders)
    for few in (True, False):
        found = classes.of(holders.select("t", "tag"), few).groupBy("t", "tag").count()
        assert often > 1 and found.count() == holders.count() and found.agg(F.max("count")).first()[0] == 1


def test_lists_are_shuffled_once(spark, monkeypatch):
    """What is known of a list and the join with it read the same exchange."""
    plans = []
    put = jaccard_join._Tables.put

    def noted(self, name, df):
        plans.append((name, df))
        return put(self, name, df)

    monkeypatch.setattr(jaccard_join._Tables, "put", noted)
    jaccard_join.jaccard_groups(frame(spark, texts(8, 40))).count()
    stars = dict(plans)["stars"]
    stars.collect()
    text = stars._jdf.queryExecution().executedPlan().toString()
    assert text.count("MapInArrow") == 1 or "ReusedExchange" in text


def test_sketch_counters_travel_packed():
    counts = np.random.default_rng(1).poisson(1.5, jaccard_join.BLOCK).astype(np.int32)
    counts[:4] = 0, 2**31 - 1, 70_000, 255
    packed = jaccard_join._packed_counts(counts)
    assert (jaccard_join._unpacked_counts(packed) == counts).all()
    assert len(packed) * 8 < counts.nbytes


def test_signatures_lose_no_link():
    rnd = np.random.default_rng(2)
    for _ in range(300):
        n, extra = rnd.integers(1, 3000), rnd.integers(0, 3000, 2) // rnd.integers(1, 20)
        hashes = np.unique(rnd.integers(0, 2**63, n + extra.sum()).astype(np.uint64))
        rnd.shuffle(hashes)
        a, b = hashes[: n + extra[0]], np.concatenate([hashes[:n], hashes[n + extra[0] :]])
        one, other = (np.frombuffer(jaccard_join.signature(x), np.uint64) for x in (a, b))
        near = jaccard_join.may_link(one, len(a), other[None], np.array([len(b)]), 80)[0]
        assert near or 100 * n < 80 * len(hashes)


def test_sets_far_from_all_they_meet_send_no_text(spark, monkeypatch):
    """A passage that many texts share makes them meet; only those that are near by their signatures are unpacked."""
    rnd = random.Random(4)
    word = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    passage, chunks = word(10), [word(40) for _ in range(8)]
    some = lambda k: sum(rnd.sample(chunks, k), [])
    rows = [" ".join(passage + some(2)) for _ in range(16)] + [" ".join(some(3)) for _ in range(60)]
    put, sent = jaccard_join._Tables.put, {}

    def noted(self, name, df):
        out = put(self, name, df)
        sent[name] = out.count()
        return out

    monkeypatch.setattr(jaccard_join._Tables, "put", noted)
    got = jaccard_join.jaccard_groups(frame(spark, rows))
    assert collections.Counter(tuple(r) for r in got.collect()) == brute(range(len(rows)), rows)
    assert sent["near"] < sent["pairs"] and 2 * sent["near-meetings"] < sent["meetings"], sent


def test_many_sets_meet_by_signatures_as_by_texts(spark, monkeypatch):
    """Parts of several batches, heads of several slices."""
    monkeypatch.setattr(jaccard_join, "FANOUT", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        rows = rows_for(5)
        got = jaccard_join.jaccard_groups(frame(spark, rows))
        assert collections.Counter(tuple(r) for r in got.collect()) == brute(range(len(rows)), rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
