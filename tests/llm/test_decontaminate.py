import itertools
import random
import re

import pytest

from tests.llm.corpus import frame, texts, words
from tidemark.llm.decontaminate import MASKS, SPAN, SUBSTITUTIONS, WINDOW, decontaminated, leaks

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall((text or "").lower())


def brute(docs, items):
    found = set()
    for (i, d), (j, b) in itertools.product(enumerate(docs), enumerate(items)):
        x, y = split(d), split(b)
        n = min(WINDOW, len(y))
        allowed = SUBSTITUTIONS if len(y) >= WINDOW else 0
        if n and any(
            sum(p != q for p, q in zip(x[a : a + n], y[c : c + n])) <= allowed for a in range(len(x) - n + 1) for c in range(len(y) - n + 1)
        ):
            found.add((i, j))
    return found


def test_masks_are_complete():
    assert all(m[0] == 0 and m[-1] == SPAN - 1 for m in MASKS)
    for bad in itertools.combinations(range(WINDOW), SUBSTITUTIONS):
        assert any(not {p + o for o in m} & set(bad) for m in MASKS for p in range(WINDOW - SPAN + 1))


def test_leaks_agree_with_brute_force(spark):
    rnd = random.Random(8)
    items = [" ".join(words(rnd, n)) for n in (40, 13, 14, 9, 5, 2, 25)] + [None, "", "!!"]
    docs = texts(9, 20)
    for item in items[:7]:
        for changes in range(5):
            own = split(item)
            for _ in range(changes):
                own[rnd.randrange(len(own))] = "other"
            docs.append("Before, " + " ".join(words(rnd, 6)) + " " + ", ".join(own).upper() + ". after")
            docs.append(" ".join(own[rnd.randrange(4) :][: rnd.randint(3, 20)]))
    frame_docs = frame(spark, docs)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = brute(docs, items)
    assert len(want) > 20
    for limit in (10**6, 0):
        got = leaks(frame_docs.withColumnRenamed("lang", "words"), bench, limit)
        assert {(r.doc_id, r.item_id) for r in got.collect()} == want
    clean = {r.doc_id for r in decontaminated(frame_docs, bench).collect()}
    assert clean == set(range(len(docs))) - {i for i, _ in want}


def test_both_joins_give_the_same_rows(spark):
    rnd = random.Random(5)
    items = [" ".join(words(rnd, n)) for n in (30, 13, 7, 3)]
    docs = [*texts(6, 10), *(f"before {item} after" for item in items), items[0].replace("W", "v", 1), items[1], items[1]]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    small, large = (sorted(map(tuple, leaks(frame(spark, docs), bench, limit).collect())) for limit in (10**6, 0))
    assert small == large and max(r[-1] for r in small) > 30


def test_null_ids_and_repeated_rows(spark):
    leak = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    docs = frame(spark, [leak, "clean text", leak], ids=[None, None, 4])
    bench = spark.createDataFrame([(1, leak), (1, leak)], "item_id long, text string")
    assert [(r.doc_id, r.text) for r in decontaminated(docs, bench).collect()] == [(None, "clean text")]
    assert decontaminated(docs, bench.limit(0)).count() == 3 and leaks(docs.limit(0), bench).count() == 0


@pytest.mark.parametrize("broadcast_words", [0, 10**6])
def test_long_leaking_texts(spark, broadcast_words):
    """200,000 words that repeat one passage, and as many clean ones; nothing but few words goes with a hit."""
    rnd = random.Random(6)
    passage = [f"p{rnd.randrange(10**6)}" for _ in range(200)]
    clean = [f"c{rnd.randrange(10**6)}" for _ in range(200_000)]
    rows = [" ".join(passage * 1000), " ".join(clean), " ".join([*clean[:100_000], *passage[50:63], *clean[100_000:]]), None, ""]
    benchmark = spark.createDataFrame([(1, " ".join(passage))], "item_id long, text string")
    got = {r.doc_id: r for r in leaks(frame(spark, rows), benchmark, broadcast_words).collect()}
    assert set(got) == {0, 2}
    assert (got[0].doc_word, got[0].item_word, got[0].n_differ) == (0, 0, 0)
    assert (got[2].doc_word, got[2].item_word, got[2].n_differ) == (100_000, 50, 0)


@pytest.mark.parametrize("broadcast_texts", [0, 10])
def test_both_ways_of_dropping_leave_the_same(spark, broadcast_texts):
    rows = [*texts(2), " ".join(f"b{k}" for k in range(40))]
    benchmark = spark.createDataFrame([(1, " ".join(f"b{k}" for k in range(30)))], "item_id long, text string")
    left = {r.doc_id for r in decontaminated(frame(spark, rows), benchmark, broadcast_texts).collect()}
    assert left == set(range(len(rows) - 1))
