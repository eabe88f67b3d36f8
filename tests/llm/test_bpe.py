import hashlib
import random

import public_tokenizers
import pytest

from tests.llm.corpus import frame, texts
from tidemark.llm.bpe import bpe_round_trip, codec, encode_long, tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "e", "th", "ing", " ", "  ", "\n", "'s", "'", "ve", "!!", "$$$", "<|endoftext|>", "<|endo", "é", "日本", "𝔘", "1", "\t", " ", " the", "x" * 7, "?'ll", "́"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_joined_leaves_equal_one_piece():
    rnd, model = random.Random(1), tokenizer(PATH)
    for _ in range(600):
        own = rnd.sample(PARTS, rnd.choice([1, 2, 3, len(PARTS)]))
        text = "".join(rnd.choice(own) for _ in range(rnd.randint(1, 400)))
        assert encode_long(model, text, rnd.choice([7, 16, 33, 100])).tolist() == model.encode(text, add_special_tokens=False).ids


def test_quick_codec_equals_the_library():
    model, quick = tokenizer(PATH), codec(PATH)
    assert quick.quick is not None and codec(public_tokenizers.path("word_bpe_49k.json")).quick is None
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    every = ["".join(f"{chr(c)}a {chr(c)}1{chr(c)}" for c in points[k : k + 128]) for k in range(0, len(points), 128)]
    assert [x.tolist() for x in quick.encode(every)] == [x.ids for x in model.encode_batch(every, add_special_tokens=False)]


@pytest.mark.parametrize("name, leaf", [("byte_bpe_50k.json", 32768), ("byte_bpe_50k.json", 40), ("word_bpe_49k.json", 32768)])
def test_round_trip(spark, name, leaf):
    path = public_tokenizers.path(name)
    rows = [*texts(6), "tail <|endoftext|>", "z" * 5000, " " * 3000]
    ids = [None if k % 8 == 0 else k for k in range(len(rows))]
    got = sorted((tuple(r) for r in bpe_round_trip(frame(spark, rows, ids).withColumnRenamed("lang", "key"), path, leaf, keep_ids=True).collect()), key=repr)
    model = tokenizer(path)
    want = []
    for i, text in zip(ids, rows):
        tokens = model.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(tokens), sha(",".join(map(str, tokens))), sha(model.decode(tokens, skip_special_tokens=False)), tokens))
    assert got == sorted(want, key=repr)
    assert bpe_round_trip(frame(spark, []), path, leaf).count() == 0


def test_levels_of_a_long_text_and_tasks_of_its_leaves(spark):
    rnd, model = random.Random(5), tokenizer(PATH)
    rows = ["".join(rnd.choice(PARTS) for _ in range(n)) for n in (900, 901, 40, 2500)] + ["𝔘\n" * 700, "\r\n x" * 300]
    got = bpe_round_trip(frame(spark, rows), PATH, leaf=20, keep_ids=True, fan=3)
    assert {r.doc_id: r.ids for r in got.collect()} == {k: model.encode(t, add_special_tokens=False).ids for k, t in enumerate(rows)}
    leaves = sum(-(-len(t) // 20) for t in rows if len(t) > 20)
    assert f"REPARTITION_BY_NUM, [plan_id=" in got._jdf.queryExecution().executedPlan().toString()
    assert f", {-(-leaves // 16)})" in got._jdf.queryExecution().executedPlan().toString()
