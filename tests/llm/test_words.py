import random
import tracemalloc

import pyarrow as pa

from tidemark.llm.bpe import Codec, tokenizer
from tidemark.llm.jaccard_join import shingle_sets
from tidemark.llm.words import buffer, slices


def test_a_slice_takes_little_memory():
    """What the passes over a slice allocate is kept by a reused worker, whatever it does next."""
    rnd = random.Random(11)
    texts = [" ".join(rnd.choice(["a", "bc", "def", "ghijk"]) for _ in range(600)) for _ in range(2500)]
    batch = pa.RecordBatch.from_arrays([pa.array([*texts, None, ""])], names=["text"])
    pieces = list(slices([batch], "text"))
    assert sum(p.num_rows for p in pieces) == batch.num_rows
    assert [t for p in pieces for t in p.column("text").to_pylist()] == [*texts, None, ""]
    whole = shingle_sets(*buffer(batch.column("text")))
    tracemalloc.start()
    found = [hash(s.tobytes()) for p in pieces for s in shingle_sets(*buffer(p.column("text")))]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [hash(s.tobytes()) for s in whole]
    assert most < 24 << 20, most


def test_the_second_library_is_read_only_when_needed():
    import public_tokenizers

    tokenizer.cache_clear()
    codec = Codec(public_tokenizers.path("byte_bpe_50k.json"))
    codec.digests(codec.encode(["some text"]))
    assert codec.quick and not tokenizer.cache_info().currsize
    assert codec.model is tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
