"""BPE encoding and decoding of whole texts, long ones by tree concatenation.

A long text is cut into leaves that are encoded in parallel, wherever the cut falls. Two
neighbours are then joined: the tokens around the cut are encoded anew in a window that
grows until its first tokens agree with the left half and its last tokens with the right
half, token by token and pre-token by pre-token. A sequence of tokens is the encoding of
its text exactly if every window of it is, so the joined tokens are those of the whole.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
import zstandard
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from tidemark.llm.words import slices

# Longest text, in code points, that is encoded in one piece, and the size of a leaf.
LEAF = 32_768
# Tokens on each side of a cut that the first window holds; longer than any special token has
# characters, so that no window starts inside of one that the cut has split.
WINDOW = 64
# Tokens in which a window has to agree with a half.
AGREE = 4
# Neighbouring stretches of a text that one task joins; longer texts take a level more.
FAN = 64
# Leaves that one task encodes, and the most tasks they are dealt to.
LEAVES = 16
TASKS = 20_000


# Fixed value: how byte-level vocabularies of this kind split text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return model


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Codec:
    """Encodes and decodes many short texts with the vocabulary of ``path``.

    A plain byte-level vocabulary whose merges come in the order of their ids goes to the
    faster of the two installed libraries, which gives the same ids (a test compares them on
    all code points); any other one goes to tokenizers.
    """

    def __init__(self, path: str):
        self.path = path
        self.quick = self.tokens = None
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if not self._plain(spec):
            return
        bytes_of = byte_of()
        raw = {bytes(bytes_of[c] for c in token): k for token, k in spec["model"]["vocab"].items() if all(c in bytes_of for c in token)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {token: k for token, k in raw.items() if k not in special.values()}
        size = max([*ranks.values(), *special.values()]) + 1
        if len(ranks) + len(special) != size:
            return
        self.quick = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
        self.tokens = _Table({k: t for t, k in ranks.items()} | {k: t.encode() for t, k in special.items()}, size)
        self.numbers = _Table({k: b"%d," % k for k in range(size)}, size)

    @property
    def model(self) -> Tokenizer:
        """Read when it is first asked for: a worker that has the faster one need not hold both."""
        return tokenizer(self.path)

    @staticmethod
    def _plain(spec: dict) -> bool:
        model, split, decoder = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("decoder") or {}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        start = len(model["vocab"]) - len(merges) - sum(t["content"] in model["vocab"] for t in spec["added_tokens"])
        return (
            model.get("type") == "BPE"
            and spec.get("normalizer") is None
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and split.get("type") == decoder.get("type") == "ByteLevel"
            and bool(split.get("use_regex", True)) and not split.get("add_prefix_space")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"])
            and all(model["vocab"].get(a + b) == start + k for k, (a, b) in enumerate(merges))
        )

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.quick:
            return [self.quick.encode_to_numpy(t, allowed_special="all").astype(np.int64) for t in texts]
        return [np.array(x.ids, np.int64) for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def digests(self, ids: list[np.ndarray]) -> tuple[list[str], list[str]]:
        """SHA-256 of each text's ids, joined by commas, and of its decoded text."""
        if self.tokens is None:
            decoded = [self.model.decode(x.tolist(), skip_special_tokens=False) for x in ids]
            return [_digest(",".join(map(str, x.tolist())).encode()) for x in ids], [_digest(d.encode()) for d in decoded]
        joined = [_digest(part[:-1]) for part in self.numbers.spell(ids)]
        return joined, [_digest(part.decode("utf-8", "replace").encode()) for part in self.tokens.spell(ids)]


class _Table:
    """Byte strings by number, to be strung together in array passes."""

    def __init__(self, strings: dict[int, bytes], size: int):
        every = [strings[k] for k in range(size)]
        self.data = np.frombuffer(b"".join(every), np.uint8)
        self.sizes = np.array([len(x) for x in every], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def spell(self, ids: list[np.ndarray]) -> list[bytes]:
        if not ids:
            return []
        flat = np.concatenate(ids).astype(np.int64)
        sizes = self.sizes[flat]
        ends = np.cumsum(sizes)
        at = np.arange(int(sizes.sum())) + np.repeat(self.starts[flat] - (ends - sizes), sizes)
        out = self.data[at].tobytes()
        edges = np.concatenate([[0], ends])[np.cumsum([0, *(len(x) for x in ids)])]
        return [out[a:b] for a, b in zip(edges, edges[1:])]


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


class Pieces:
    """Tokens of a stretch of text: ids, first and last code point of each, start-of-pre-token marks."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, marks: np.ndarray):
        self.ids, self.starts, self.ends, self.marks = ids, starts, ends, marks

    def __getitem__(self, part: slice) -> Pieces:
        return Pieces(self.ids[part], self.starts[part], self.ends[part], self.marks[part])

    def shifted(self, by: int) -> Pieces:
        return Pieces(self.ids, self.starts + by, self.ends + by, self.marks)

    def __add__(self, other: Pieces) -> Pieces:
        pairs = zip(
            (self.ids, self.starts, self.ends, self.marks), (other.ids, other.starts, other.ends, other.marks)
        )
        return Pieces(*(np.concatenate(p) for p in pairs))


def encode_pieces(model: Tokenizer, text: str) -> Pieces:
    found = model.encode(text, add_special_tokens=False)
    ids = np.array(found.ids, np.int64)
    offsets = np.array(found.offsets, np.int64).reshape(-1, 2)
    # Pre-tokens follow each other without overlap, so a new one starts where the word changes.
    words = np.array([-1 if w is None else w for w in found.word_ids], np.int64)
    marks = np.ones(len(ids), bool)
    marks[1:] = (words[1:] != words[:-1]) | (words[1:] < 0)
    return Pieces(ids, offsets[:, 0], offsets[:, 1], marks)


def _clean(pieces: Pieces, k: int, text: str) -> bool:
    """Whether a window may start with token ``k``: at a whole character that opens no contraction."""
    whole = k == 0 or pieces.starts[k] >= pieces.ends[k - 1]
    return bool(whole) and (bool(pieces.marks[k]) or text[pieces.starts[k]] != "'")


def join(model: Tokenizer, text: str, left: Pieces, right: Pieces, start: int, end: int) -> Pieces:
    """Tokens of ``text[start:end]`` from those of its two halves, offsets counting in ``text``."""
    if not len(left.ids) or not len(right.ids):
        return left + right
    size = WINDOW
    while True:
        a, b = max(0, len(left.ids) - size), min(len(right.ids), size)
        while a > 0 and not _clean(left, a, text):
            a -= 1
        while b < len(right.ids) and right.starts[b] < right.ends[b - 1]:
            b += 1
        low = int(left.starts[a]) if a else start
        high = int(right.ends[b - 1]) if b < len(right.ids) else end
        if a == 0 and b == len(right.ids):
            return encode_pieces(model, text[start:end]).shifted(start)
        middle = encode_pieces(model, text[low:high]).shifted(low)
        if (a == 0 or _same(middle[:AGREE], left[a : a + AGREE], False)) and (
            b == len(right.ids) or _same(middle[-AGREE:], right[b - AGREE : b], True)
        ):
            first = middle[:1]
            if a:
                first = left[a : a + 1]
            return left[:a] + first + middle[1:] + right[b:]
        size *= 2


def _same(x: Pieces, y: Pieces, marked: bool) -> bool:
    """Equal tokens at equal places; ``marked``: also the mark of the first of them."""
    if len(x.ids) != len(y.ids):
        return False
    k = 0 if marked else 1
    pairs = ((x.ids, y.ids), (x.starts, y.starts), (x.ends, y.ends), (x.marks[k:], y.marks[k:]))
    return all(np.array_equal(p, q) for p, q in pairs)


def tree(model: Tokenizer, text: str, leaves: list[tuple[int, int, Pieces]]) -> Pieces:
    """Join neighbours level by level until one stretch is left."""
    while len(leaves) > 1:
        pairs = []
        for k in range(0, len(leaves) - 1, 2):
            (a, _, left), (_, b, right) = leaves[k], leaves[k + 1]
            pairs.append((a, b, join(model, text, left, right, a, b)))
        leaves = pairs + leaves[len(leaves) // 2 * 2 :]
    return leaves[0][2]


def encode_long(model: Tokenizer, text: str, leaf: int = LEAF) -> np.ndarray:
    """Ids of a text of any length; the same as encoding it in one piece."""
    cuts = [*range(0, max(len(text), 1), leaf), len(text)]
    leaves = [(a, b, encode_pieces(model, text[a:b]).shifted(a)) for a, b in zip(cuts, cuts[1:])]
    return tree(model, text, leaves).ids


def _digest(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def _pack(pieces: Pieces) -> bytes:
    gaps = np.diff(pieces.starts, prepend=0)
    rows = np.stack([pieces.ids, gaps, pieces.ends - pieces.starts, pieces.marks.astype(np.int64)]).astype(np.int32)
    return zstandard.compress(rows.tobytes(), 1)


def _unpack(raw: bytes) -> Pieces:
    ids, gaps, sizes, marks = np.frombuffer(zstandard.decompress(raw), np.int32).reshape(4, -1).astype(np.int64)
    starts = np.cumsum(gaps)
    return Pieces(ids, starts, starts + sizes, marks.astype(bool))


def bpe_round_trip(documents: DataFrame, path: str, leaf: int = LEAF, keep_ids: bool = False, fan: int = FAN) -> DataFrame:
    """One row per document: count and digest of its token ids, digest of the decoded text.

    ``path`` names a vocabulary of the tokenizers library that every executor can read.
    ``keep_ids`` adds the ids themselves. A null text counts as empty: no ids. Repeated rows
    give a row each; other columns are ignored.

    Texts up to ``leaf`` code points are encoded where they are. Longer ones are cut into
    leaves that are dealt over all tasks; then tasks join ``fan`` neighbours each, level by
    level, which encodes only the windows around the cuts, until a text is in one piece.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    if keep_ids:
        schema, names = schema + ", ids array<long>", [*names, "ids"]
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = codec(path)
        for piece in slices(batches, "text"):
            ids = model.encode(piece.column("text").to_pylist())
            columns = [piece.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()), *(pa.array(d, pa.string()) for d in model.digests(ids))]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(ids, pa.list_(pa.int64()))] * keep_ids], names=names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tokenizer(path)
        for piece in slices(batches, "piece"):
            tokens = [_pack(encode_pieces(model, text)) for text in piece.column("piece").to_pylist()]
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(tokens, pa.binary())], names=["key", "start", "piece", "tokens"])

    def neighbours(group: pd.DataFrame) -> tuple[str, Pieces]:
        group = group.sort_values("start")
        leaves, at = [], 0
        for text, raw in zip(group.piece, group.tokens):
            leaves.append((at, at + len(text), _unpack(raw).shifted(at)))
            at += len(text)
        text = "".join(group.piece)
        return text, tree(tokenizer(path), text, leaves)

    def merged(group: pd.DataFrame) -> pd.DataFrame:
        text, pieces = neighbours(group)
        return pd.DataFrame([{"key": group.key.iloc[0], "start": group.start.min(), "piece": text, "tokens": _pack(pieces)}])

    def joined(group: pd.DataFrame) -> pd.DataFrame:
        ids = neighbours(group)[1].ids
        (ids_digest,), (decoded,) = codec(path).digests([ids])
        out = {"key": group.key.iloc[0], "n_tokens": len(ids), "ids_sha256": ids_digest, "decoded_sha256": decoded}
        return pd.DataFrame([out | ({"ids": ids.tolist()} if keep_ids else {})])

    short = docs.filter(F.length("text") <= leaf).mapInArrow(whole, schema)
    # Equal long texts are encoded once; the digest is their key, so null and repeated ids are safe.
    long = docs.filter(F.length("text") > leaf).withColumn("key", F.sha2("text", 256))
    size = F.length("text")
    total, longest = docs.filter(size > leaf).agg(F.sum(F.ceil(size / leaf)), F.max(size)).first()
    tasks = min(TASKS, -(-(total or 0) // LEAVES) or 1)
    # One pass over a text cuts all its leaves; asking for each by its place would count from the start every time.
    cuts = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{leaf}}}"), F.lit(0))
    level = "key string, start int, piece string, tokens binary"
    leaves = (
        long.dropDuplicates(["key"])
        .select("key", F.posexplode(cuts).alias("start", "piece"))
        .select("key", (F.col("start") * leaf).alias("start"), "piece")
        .repartition(tasks, "key", "start")
        .mapInArrow(cut, level)
    )
    stretch = leaf * fan
    while (longest or 0) > stretch:
        leaves = leaves.groupBy("key", F.expr(f"start div {stretch}").alias("part")).applyInPandas(merged, level)
        stretch *= fan
    whole_ids = leaves.groupBy("key").applyInPandas(joined, schema.replace(f"doc_id {kind}", "key string"))
    return short.unionByName(long.select("doc_id", "key").join(whole_ids, "key").drop("key"))
