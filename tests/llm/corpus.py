"""Small texts with copies, shared passages and odd cases."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rnd: random.Random, n: int, size: int = 300) -> list[str]:
    return [f"w{rnd.randrange(size)}é" if rnd.random() < 0.1 else f"W{rnd.randrange(size)}" for _ in range(n)]


def odd_texts() -> list:
    return [None, "", "   ", "\n\t", "a", "one two three", "日本 語 𝔘", "x" * 700, "ab " * 400, "<|endoftext|> tail", "don't  stop now"]


def texts(seed: int, n: int = 60) -> list:
    rnd = random.Random(seed)
    shared = [" ".join(words(rnd, k)) for k in (50, 70, 12)]
    out = []
    for _ in range(n):
        parts = [" ".join(words(rnd, rnd.randint(0, 60))), rnd.choice([*shared, "", ""]), " ".join(words(rnd, rnd.randint(0, 30)))]
        out.append(". ".join(parts))
    for k in range(n // 3):
        own = out[k].split(" ")
        own[rnd.randrange(len(own))] = "changed"
        out.append(" ".join(own))
    return [*out, out[1], out[1], *odd_texts()]


def frame(spark, rows: list, ids=None):
    ids = range(len(rows)) if ids is None else ids
    data = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, rows)]
    return spark.createDataFrame(data, SCHEMA)
