import hashlib
import math
import random

import numpy as np

from tidemark.llm.grid_codes import CellCache, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """The contract in plain Python."""
    kept = []
    for own, vector, label in rows:
        if vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((own, [math.floor(1024 * x) for x in vector], label))
    d = len(kept[0][1]) // 4
    first = {}
    for own, vector, _ in kept:
        if own is not None:
            first[own] = min(first.get(own, vector), vector)
    ids = sorted(first)[:256]
    books = [[first[i][p * d : (p + 1) * d] for i in ids] for p in range(4)]

    def nearest(p, part):
        distances = [sum((a - b) ** 2 for a, b in zip(part, entry)) for entry in books[p]]
        best = min(distances)
        return distances.index(best), best

    for _ in range(4):
        for p in range(4):
            groups = {}
            for _, vector, _ in kept:
                part = vector[p * d : (p + 1) * d]
                groups.setdefault(nearest(p, part)[0], []).append(part)
            for e, members in groups.items():
                books[p][e] = [sum(column) // len(members) for column in zip(*members)]
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    out, by_label = [], {}
    for own, vector, label in kept:
        found = [nearest(p, vector[p * d : (p + 1) * d]) for p in range(4)]
        error = sum(f[1] for f in found)
        by_label[label] = by_label.get(label, 0) + error
        out.append([own, "".join(f"{f[0]:02x}" for f in found), error, label])
    return sorted([(own, code, error, by_label[label], digest) for own, code, error, label in out], key=repr)


def vectors(n, size=8, seed=1):
    rnd = random.Random(seed)
    centres = [[rnd.uniform(-0.5, 0.5) for _ in range(size)] for _ in range(30)]
    rows = []
    for i in range(n):
        vector = [float(np.float32(x + rnd.gauss(0, 0.03))) for x in rnd.choice(centres)]
        rows.append((i, vector, rnd.choice([0, 0, 0, 1, 2, None])))
    return rows


def test_agrees_with_brute_force(spark, rows):
    data = vectors(400)
    size = 8
    same = data[5][1]
    data += [(1000 + i, same, 0) for i in range(30)]  # copies tie everywhere
    data += [(3, data[9][1], 1), (None, data[11][1], 2)]  # a repeated and a missing id
    data += [(2000, None, 0), (2001, [0.1] * 7 + [None], 0), (2002, [0.1] * 7 + [float("nan")], 1), (2003, [float("inf")] * size, 1)]
    got = rows(vector_codes(spark.createDataFrame(data, SCHEMA).repartition(5)), "vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert got == brute(data)


def test_fewer_vectors_than_entries_and_negative_halves(spark, rows):
    data = [(9 - i, [(-1) ** i * (i + 0.5) / 1024] * 4, None) for i in range(7)]
    got = rows(vector_codes(spark.createDataFrame(data, SCHEMA)), "vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert got == brute(data)


def test_odd_tables(spark, rows):
    empty = vector_codes(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0
    odd = [(1, [], 0), (2, [0.5] * 6, 0), (None, [0.5] * 8, 0), (3, [0.25] * 8, 0), (4, [0.25] * 12, 0), (5, [1e30] * 8, 0)]
    frame = spark.createDataFrame(odd, SCHEMA).selectExpr("*", "1 as id", "2 as code", "3 as grid", "4 as error")
    got = rows(vector_codes(frame), "vec_id", "code", "error")
    # the length of the smallest id's vector counts; too large components count as not finite; the one entry lies between
    assert got == [(3, "00000000", 8 * 128 * 128), (None, "00000000", 8 * 128 * 128)]
    assert vector_codes(spark.createDataFrame([(None, [0.5] * 8, 0)], SCHEMA)).count() == 0


def test_rare_labels_are_joined_too(spark, rows):
    data = [(i, v, i if i < 60 else None) for i, v, _ in vectors(80)]
    from tidemark.llm.grid_codes import with_label_error

    coded = vector_codes(spark.createDataFrame(data, SCHEMA)).select("vec_id", "error")
    labels = spark.createDataFrame([(i, label) for i, _, label in data], "vec_id long, label int")
    got = rows(with_label_error(coded.join(labels, "vec_id"), most=10), "vec_id", "label_error")
    assert got == sorted(((r[0], r[3]) for r in brute(data)), key=repr)


def test_cells_leave_no_nearer_entry_out():
    rng = np.random.default_rng(5)
    book = rng.integers(-300, 300, (256, 5))
    parts = np.concatenate([rng.integers(-400, 400, (2000, 5)), book[:50], (book[:50] + book[50:100]) // 2]).astype(np.int32)
    distances = ((parts[:, None, :].astype(np.int64) - book) ** 2).sum(-1)
    for bits in (2, 5, 9, 12):
        cache = CellCache(book, bits)
        for _ in range(2):  # the second time from memory
            index, best = cache.nearest(parts)
            assert (index == distances.argmin(1)).all() and (best == distances.min(1)).all()
    assert CellCache(book, 4).nearest(parts[:1])[0].shape == (1,)
