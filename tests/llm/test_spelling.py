import random
import re
import zlib
from collections import Counter

import pytest

from tests.llm.corpus import SCHEMA, frame, texts
from tidemark.llm.scratch import Scratch
from tidemark.llm.spelling import near_words, spelling_variants


def counted(rows):
    total = Counter()
    for own, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if own is None else own}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    words = counted(rows)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def ladder():
    """Words whose forms lead over several steps, ties and runs of one letter."""
    chain = {"aaaaaaaaaa": 1300, "aaaaaaaaab": 120, "aaaaaaaabb": 11, "aaaaaaabbb": 2, "aaaaaaaaa": 1300, "ÀÿÀÿÀÿÀÿ": 40, "ÀÿÀÿÀÿÀ": 3}
    return [" ".join([w] * n) for w, n in chain.items()]


def corpus():
    rnd = random.Random(3)
    pool = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(6, 9))) for _ in range(250)]
    out = []
    for _ in range(60):
        picked = [rnd.choice(pool) for _ in range(80)]
        for k in range(0, 80, 5):
            w = picked[k]
            at = rnd.randrange(len(w))
            picked[k] = rnd.choice([w[:at] + w[at + 1 :], w[:at] + "x" + w[at:], w[:at] + "y" + w[at + 1 :], w.upper()])
        out.append(rnd.choice([" ", "-", "\n"]).join(picked))
    return out


def test_agrees_with_brute_force(spark, rows):
    data = [*corpus(), *ladder(), *texts(4), "z" * 5000 + " " + "z" * 5000 + " " + "z" * 4999, "×" * 9 + " " + "×" * 9]
    ids = [*range(len(data) - 3), None, None, 7]
    got = rows(spelling_variants(frame(spark, data, ids)), *COLUMNS)
    assert got == sorted(brute(zip(ids, data)), key=repr)
    steps = {w: (form, root) for w, form, root, *_ in got}
    assert any(form is not None and root not in (w, form) for w, (form, root) in steps.items())


@pytest.mark.parametrize("crowd", [0, 1, 3, 10**6])
def test_crowded_forms_lose_and_double_no_pair(spark, rows, crowd):
    words = sorted({w for t in corpus() for w in t.split() if len(w) >= 7})[:400]
    want = sorted(((a, len(a), b, len(b)) for a in words for b in words if one_edit(a, b)), key=repr)
    table = spark.createDataFrame([(w, len(w)) for w in words], "word string, n long")
    for symbols in ((2, 4, 256), (8, 32, 256), (1, 256)):
        assert rows(near_words(table, Scratch(spark, "test"), symbols, crowd), "word", "n", "other", "other_n") == want


def test_empty_and_extra_columns(spark, rows):
    empty = spark.createDataFrame([], SCHEMA)
    got = spelling_variants(empty)
    assert got.count() == 0 and tuple(got.columns) == COLUMNS
    clashing = frame(spark, ["letters letters lettters lettters"] * 9 + [None, ""]).selectExpr("*", "1 as word", "2 as n", "3 as root", "4 as id")
    assert rows(spelling_variants(clashing), *COLUMNS) == brute(enumerate(["letters letters lettters lettters"] * 9))
