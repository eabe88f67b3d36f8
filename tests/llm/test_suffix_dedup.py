import collections
import contextlib
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.corpus import frame, texts
from tidemark.llm import suffix_dedup
from tidemark.llm.anchors import PASSAGE, anchors
from tidemark.llm.scratch import Scratch
from tidemark.llm.suffix_sort import deep_shallow, shared_windows
from tidemark.llm.words import buffer


def brute(rows, n=PASSAGE):
    raw = [(t or "").encode() for t in rows]
    often = collections.Counter(b[i : i + n] for b in raw for i in range(len(b) - n + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - n + 1):
            if often[b[i : i + n]] > 1:
                gone[i : i + n] = True
        kept = bytes(c for c, g in zip(b, gone) if not g)
        runs = int((gone[:-1] & ~np.insert(gone[:-2], 0, False)).sum()) if len(b) else 0
        out.append((len(b), int(gone[:-1].sum()), runs, hashlib.sha256(kept).hexdigest(), gone[:-1]))
    return out


def rows_for(seed):
    own = texts(seed, 40)
    return [*own, "a" * 1000, "ab" * 150, "a" * 199, "a" * 200, "b" * 200, "b" * 200, "q" * 201, own[0] + own[0], "日本語" * 90]


def test_sorting_agrees_with_sorted():
    rnd = random.Random(3)
    for _ in range(400):
        stems = [bytes(rnd.choice(b"abcd"[: rnd.choice([1, 2, 4])]) for _ in range(rnd.randint(0, 120))) for _ in range(3)]
        strings = []
        for _ in range(rnd.randint(0, 30)):
            s = bytearray(rnd.choice(stems))
            if s and rnd.random() < 0.6:
                s[rnd.randrange(len(s))] = rnd.choice(b"abcd\0")
            strings.append(bytes(s[: rnd.randint(0, len(s))]) if rnd.random() < 0.3 else bytes(s))
        order = deep_shallow(strings, rnd.choice([0, 8, 16, 64]))
        assert [strings[k] for k in order] == sorted(strings) and sorted(order) == list(range(len(strings)))


def test_shared_windows_agree_with_brute_force():
    rnd = random.Random(4)
    for _ in range(300):
        n = rnd.choice([6, 8])
        seen = collections.Counter()
        for _ in range(rnd.randint(1, 12)):
            left, right = (bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, n - 2))) for _ in range(2))
            if len(left) + len(right) + 2 >= n:
                seen[left + b"gg" + right, len(left)] += rnd.choice([1, 1, 2])
        if not seen:
            continue
        contexts, places, counts = [c for c, _ in seen], [p for _, p in seen], list(seen.values())
        starts = lambda c, p: [s for s in range(0, min(p, len(c) - n) + 1) if p - s + 2 <= n]
        often = collections.Counter()
        for c, p, m in zip(contexts, places, counts):
            for s in starts(c, p):
                often[c[s : s + n], p - s] += m
        groups = np.repeat([0, 1], len(contexts))
        first, last = shared_windows(contexts * 2, np.array(places * 2), np.array(counts * 2), groups, n)
        for k, (c, p) in enumerate(zip(contexts * 2, places * 2)):
            hits = [s for s in starts(c, p) if often[c[s : s + n], p - s] > 1]
            assert (first[k], last[k]) == ((min(hits), max(hits)) if hits else (-1, -1))


def test_every_window_belongs_to_one_anchor():
    import pyarrow as pa

    data, offsets = buffer(pa.array(rows_for(1), pa.large_string()))
    _, at, start, end, owner = anchors(data, offsets)
    windows = [(k, s) for a, b, k in zip(start, end, owner) for s in range(a, b - PASSAGE + 1)]
    want = [(k, s) for k in range(len(offsets) - 1) for s in range(offsets[k], offsets[k + 1] - PASSAGE + 1)]
    assert windows == want and all(s <= a for a, s in zip(at, start))


@pytest.mark.parametrize("group", [5000, 2])
def test_digests_agree_with_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    rows = rows_for(7)
    ids = [None if k % 9 == 0 else k // 2 for k in range(len(rows))]
    got = suffix_dedup.passage_digests(frame(spark, rows, ids).withColumnRenamed("lang", "t"))
    want = collections.Counter((i, *r[:4]) for i, r in zip(ids, brute(rows)))
    assert sum(w[2] > 0 for w in want) > 10
    assert collections.Counter(tuple(r) for r in got.collect()) == want


def test_texts_without_repeats(spark):
    rows = rows_for(7)
    got = {r.doc_id: r for r in suffix_dedup.without_repeats(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for k, (text, want) in enumerate(zip(rows, brute(rows))):
        if text is None:
            assert got[k].text is None and got[k].n_chars is None
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[1], want[4].astype(int), [1]])))
        parts = [text.encode()[a:b] for a, b in zip(edges[::2], edges[1::2])]
        assert got[k].text == "".join(p.decode("utf-8", "ignore") for p in parts)
        assert got[k].n_chars == len(got[k].text)
    assert suffix_dedup.passage_digests(frame(spark, [])).count() == 0


@pytest.mark.parametrize("few", [0, 10**6])
def test_a_hot_gram_goes_to_several_tasks(spark, few):
    """A gram that a third of all anchors have, joined by broadcast and by shuffle."""
    rows = [(k, 3, 7 if k % 3 == 0 else k, k % 2) for k in range(3000)] + [(9000, 1, 1, 5), (9000, 2, 1, 5)]
    scratch = Scratch(spark, "test")
    found = scratch.put("anchors", spark.createDataFrame(rows, "t long, place long, gram long, context long").repartition(4))
    with shuffled_joins(spark):
        again = suffix_dedup._again(found, scratch, few, hot=100)
        tasks = {r.p for r in again.filter("gram = 7").select(F.spark_partition_id().alias("p")).collect()}
        got = sorted(map(tuple, again.collect()))
    often = collections.Counter(r[2] for r in rows)
    kinds = {g: {r[3] for r in rows if r[2] == g} for g in often}
    assert got == sorted((*r, len(kinds[r[2]]) > 1) for r in rows if often[r[2]] > 1)
    assert len(tasks) > 1


@contextlib.contextmanager
def shuffled_joins(spark):
    """No broadcast but by hint, no joining of small partitions."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_long_texts(spark):
    """Texts of 100,000 characters with a shared passage, their hot gram and all."""
    rnd = random.Random(5)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(300))
    long = ["".join(rnd.choice("abcdefghij ") for _ in range(50_000)) for _ in range(3)]
    rows = [a + passage + b for a, b in zip(long, long[::-1])]
    got = {r.doc_id: r for r in suffix_dedup.passage_digests(frame(spark, rows)).collect()}
    # every half stands in two texts or twice in one, so all goes but what joins are new
    for k, want in enumerate(brute(rows)):
        assert tuple(got[k])[1:] == tuple(want[:4])


def test_cutting_texts_shuffles_them_once(spark):
    """Only spans travel to the documents: no second copy of the texts, and none of what is left of them."""
    passage = " ".join(f"word{i}" for i in range(60))
    data = [(1, f"first {passage} one é", 7), (2, f"second {passage} two", 7), (3, None, 7), (4, "short", 7)] * 2
    documents = spark.createDataFrame(data, "doc_id long, text string, n_chars int")
    out = suffix_dedup.without_repeats(documents)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "octet_length" not in plan and "MapInArrow" in plan and "kept_sha256" not in plan
    assert sorted((r.doc_id, r.text, r.n_chars) for r in out.collect()) == sorted(
        [(1, "", 0), (2, "", 0), (3, None, 7), (4, "short", 7)] * 2, key=lambda r: r[0]
    )


def test_no_answer_is_dealt_out_to_the_anchors_of_a_group(spark):
    """A context that stands once carries its place, one that stands twice goes whole: nothing joins anchors with what was sorted."""
    rows = rows_for(7)
    plan = suffix_dedup.repeated_spans(frame(spark, rows))._jdf.queryExecution().optimizedPlan().toString()
    assert "_sorted_groups" in plan and not re.search(r"Join Inner.*context", plan)


@pytest.mark.parametrize("few", [0, 10**6])
def test_whole_contexts(spark, few):
    """Anchors of grams with one context and those of contexts that stand twice, by broadcast and by shuffle."""
    rows = [(1, 1, 7, 1, True), (2, 2, 7, 1, True), (3, 3, 7, 2, True), (4, 4, 8, 1, False), (5, 5, 8, 1, False), (6, 6, 9, 1, True)]
    again = spark.createDataFrame(rows, "t long, place long, gram long, context long, mixed boolean")
    repeated = spark.createDataFrame([(7, 1)], "gram long, context long")
    assert sorted(map(tuple, suffix_dedup._whole_contexts(again, repeated, few).collect())) == [(1, 1), (2, 2), (4, 4), (5, 5)]
