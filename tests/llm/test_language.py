import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from tests.llm.corpus import SCHEMA, odd_texts
from tidemark.llm import language
from tidemark.llm.language import gram_hashes, languages, most_frequent, text_scores, train, word_counts
from tidemark.llm.scratch import Scratch

SYLLABLES = {
    "en": "the and ing her tion of wh ly".split(),
    "de": "der sch ung und ein ich ße ü".split(),
    "ru": "при ото ств ния ого ко".split(),
    "zh": list("的一是不了人我在有他这"),
}


def document(rnd, lang, n):
    own = SYLLABLES[lang]
    return " ".join("".join(rnd.choice(own) for _ in range(rnd.randint(1, 4))).capitalize() for _ in range(n))


def corpus(n=240, seed=2):
    rnd = random.Random(seed)
    names = list(SYLLABLES)
    # one language holds half of the rows
    picked = ["en" if rnd.random() < 0.5 else rnd.choice(names) for _ in range(n)]
    return [(i, document(rnd, lang, rnd.randint(5, 60)), lang) for i, lang in enumerate(picked)]


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, t, lang in rows], SCHEMA)


def fold(i):
    return zlib.crc32(str(i).encode()) % 4


def test_held_out_languages_are_found(spark):
    data = corpus()
    got = {r.doc_id: r for r in languages(table(spark, data)).collect()}
    assert len(got) == len(data)
    held = [i for i, _, _ in data if fold(i) == 2]
    assert held and all(got[i].held_out == (fold(i) == 2) for i in got)
    assert sum(got[i].lang_pred == data[i][2] for i in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_scores_agree_with_a_plain_model(spark):
    """Words, n-grams and backing off, computed with strings and dictionaries."""
    data = [(t, lang) for _, t, lang in corpus(80)]
    words = defaultdict(Counter)
    for text, lang in data:
        words[lang].update(re.findall(r"[^\W\d_]+", text.lower()))
    names = sorted(words)
    total = {lang: sum(words[lang].values()) for lang in names}

    def grams(word, size):
        marked = "\x01" + word + "\x02"
        return [marked[i : i + size] for i in range(len(marked) - size + 1)]

    counted = {size: {lang: Counter() for lang in names} for size in range(1, 6)}
    for size in counted:
        for lang in names:
            for word, n in words[lang].items():
                for gram in grams(word, size):
                    counted[size][lang][gram] += n

    def logs(counts, key, sums):
        low = math.log(0.5 / max(sums.values()))
        return [max(math.log(counts[lang][key] / sums[lang]), low) if counts[lang][key] else low for lang in names]

    def word_score(word):
        if any(word in words[lang] for lang in names):
            return logs(words, word, total)
        for size in range(5, 0, -1):
            sums = {lang: sum(counted[size][lang].values()) for lang in names}
            known = [g for g in grams(word, size) if any(g in counted[size][lang] for lang in names)]
            if known:
                return np.mean([logs(counted[size], g, sums) for g in known], 0)
        return None

    model = train(spark.createDataFrame(data, "text string, lang string"), Scratch(spark, "test"))
    assert model.languages == tuple(names)
    texts = [t for _, t, _ in corpus(30, seed=9)] + ["theand thewhwh Θ", "тheing 12 of_the", "一x", "QQQ", "", "of 的 ûû"]
    means, counts = text_scores(pa.array(texts), model)
    for text, mean, n in zip(texts, means, counts):
        want = [s for s in map(word_score, re.findall(r"[^\W\d_]+", text.lower())) if s is not None]
        assert n == len(want)
        if want:
            assert np.allclose(mean, np.mean(want, 0), rtol=1e-5)


def test_word_counts_and_gram_hashes_are_whole(spark, rows):
    data = [("The the ünD", "a"), ("the и и", "b"), ("x" * 50_000, "a"), ("", "b"), ("12 _ 3", "a")]
    got = rows(word_counts(spark.createDataFrame(data * 3, "text string, lang string").repartition(4)), "lang", "word", "n")
    assert got == sorted([("a", "the", 6), ("a", "ünd", 3), ("b", "the", 3), ("b", "и", 6), ("a", "x" * 50_000, 3)], key=repr)
    for size in range(1, 6):
        hashes, owner = gram_hashes(pa.array(["añb", "b", "añbc", "x"]), size)
        marked = ["\x01añb\x02", "\x01b\x02", "\x01añbc\x02", "\x01x\x02"]
        want = [(m[i : i + size], k) for k, m in enumerate(marked) for i in range(len(m) - size + 1)]
        assert owner.tolist() == [k for _, k in want]
        assert len(set(hashes.tolist())) == len({g for g, _ in want})


def test_bounded_vocabulary_is_cut_at_a_frequency(spark):
    counts = spark.createDataFrame([(h, n) for h in range(100) for n in (h, 1)], "hash long, n long")
    for most in (0, 1, 7, 50, 99, 100, 1000):
        kept = {r.hash for r in most_frequent(counts, most).collect()}
        assert len(kept) <= most
        assert not kept or min(kept) > max(set(range(100)) - kept, default=-1)
        assert len(kept) >= 0.5 * min(most, 100) or most < 7


def test_odd_texts_and_tables(spark, monkeypatch):
    data = corpus(60)
    extra = odd_texts()
    odd = [(1000 + k, t, None) for k, t in enumerate([*extra, "12 %", "ŋŋ ŋ", "of the " * 60_000])]
    frame = table(spark, [*data, *odd, (None, "the of", "en"), data[3], data[3]]).selectExpr("*", "1 as score", "'x' as lang_pred", "2 as fold")
    got = languages(frame).collect()
    assert len(got) == len(data) + len(odd) + 3
    by_id = {r.doc_id: r for r in got}
    for own, text, _ in odd:
        r = by_id[own]
        letters = any(c.isalpha() for c in text or "")
        assert (r.lang_pred == "und") == (not letters) and (letters or r.score == 0)
    assert by_id[1000 + len(extra) + 2].lang_pred == "en" and by_id[None].held_out is False
    nothing = languages(table(spark, [(i, t, None) for i, t, _ in data])).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert languages(spark.createDataFrame([], SCHEMA)).count() == 0
    # as many languages as rows, of which only some fit the model
    monkeypatch.setattr(language, "LANGUAGES", 5)
    many = languages(table(spark, [(i, t, f"l{i}") for i, t, _ in data])).collect()
    assert len({r.lang_pred for r in many}) <= 5 and len(many) == len(data)
