import random
import zlib

import numpy as np

from tests.llm.corpus import SCHEMA
from tidemark.llm.toxicity import CODES, DECAY, PATTERNS, SYMBOLS, _dense, _examples, kernel, symbols, toxicity, vectors, word_scores

BAD = ("zorgle", "blunkard", "snivver", "krattock")


def corpus(n=400, seed=2):
    rnd = random.Random(seed)
    plain = ["river", "stone", "walking", "slowly", "the", "of", "lights", "over", "garden", "window", "paper", "morning"]
    rows = []
    for i in range(n):
        own = [" ".join(rnd.choice(plain) for _ in range(8)).capitalize() + "." for _ in range(rnd.randint(2, 6))]
        toxic = int(rnd.random() < 0.3)
        for _ in range(2 * toxic):
            k = rnd.randrange(len(own))
            own[k] = own[k].replace(" ", f" {rnd.choice(BAD)} ", 1)
        rows.append((i, " ".join(own), "en", "s", 0, toxic))
    return rows


def tables(spark, rows):
    docs = spark.createDataFrame([r[:5] for r in rows], SCHEMA)
    return docs, spark.createDataFrame([(r[0], 1, r[5]) for r in rows], "doc_id long, quality int, toxic int")


def test_kernel_agrees_with_counting_subsequences():
    chosen = [b"zorgle", b"aab", b"zo", b"garden", b"z.o-r*g l e", b""]
    row, code, value = vectors(chosen)
    assert len(row) == len(code) == len(value)

    def direct(word):
        s = [0, *(c - 96 for c in word), 0]
        out, norm = np.zeros(CODES), 0.0
        for i in range(len(s)):
            for a, b in PATTERNS:
                if i + b < len(s) and 0 not in s[i + 1 : i + b]:
                    out[(s[i] * SYMBOLS + s[i + a]) * SYMBOLS + s[i + b]] += DECAY ** (b - 2)
                    norm += DECAY ** (2 * (b - 2))
        return out / max(np.sqrt(norm), 1e-9)

    dense = _dense([b"zorgle", b"garden"])
    # the last symbol of a batch has no edge after it, others share the next word's
    for word, got in zip((b"zorgle", b"aab", b"garden"), kernel([b"zorgle", b"aab", b"garden"], dense)):
        want = [float(direct(word) @ direct(x)) for x in (b"zorgle", b"garden")]
        assert np.allclose(got, want, atol=0.25)


def test_symbols_glue_letters_and_drop_signs():
    data = np.frombuffer(b"i d.i o*t it  is a b", np.uint8)
    s = symbols(data, np.array([0, 9, 9, 20]))
    assert s.n_texts == 3 and set(s.owner.tolist()) <= {0, 2}
    assert len(word_scores(s, np.zeros(CODES, np.float32))) == len(s.owner)


def test_words_of_other_scripts_differ():
    chosen = [w.encode() for w in ("дурачок", "человек", "погулять", "μωρόςκαι", "дура-чок")]
    near = kernel(chosen, _dense(chosen[:1]))[:, 0]
    assert near[4] > 0.99 * near[0] and max(near[1:4]) < 0.5 * near[0]


def test_held_out_accuracy_and_inserted_characters(spark):
    rows = corpus()
    docs, labels = tables(spark, rows)
    extra = [(1000, "The river zor.gle walks."), (1001, "The river."), (1002, None), (1003, ""), (1004, "a " * 3000), (None, "the garden")]
    docs = docs.unionByName(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in extra], SCHEMA))
    got = toxicity(docs.withColumnRenamed("lang", "score"), labels).collect()
    assert len(got) == len(rows) + len(extra)
    by = {r.doc_id: r for r in got}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert all(by[r[0]].held_out == (zlib.crc32(str(r[0]).encode()) % 5 == 0) for r in rows)
    assert sum(by[r[0]].predicted == r[5] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert by[1000].score > by[1001].score and by[1002].score == by[1003].score


def test_without_labels(spark):
    docs, labels = tables(spark, corpus(20))
    assert {r.score for r in toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity(docs.limit(0), labels.limit(0)).count() == 0


def test_a_repeated_id_gives_the_sample_one_row(spark):
    rows = corpus(200)
    docs, labels = tables(spark, rows)
    hot = next(r for r in rows if r[5] and zlib.crc32(str(r[0]).encode()) % 5)
    copies = spark.createDataFrame([(hot[0], f"{hot[1]} {k % 40}", "en", "s", 0) for k in range(100)], SCHEMA)
    learnt = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    sample = _examples(docs.unionByName(copies), labels).collect()
    assert len(sample) == len(learnt) and sum(r.label for r in sample) == sum(r[5] for r in learnt)
    again = _examples(copies.repartition(3).unionByName(docs), labels).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, sample))
