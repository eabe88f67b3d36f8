"""N-gram Jaccard join: groups of documents linked by their sets of word shingles.

Each set lists its rarest shingles, enough that sets at or above the threshold have one in
common; an inverted index holds the lists. Relations between sets spare most comparisons:

* Equal sets are one class and share all answers.
* In every list the smallest set is compared with the others first. Those whose sizes rule a
  link out are skipped; sizes say where in a list a set stands.
* The others that have come into the first set's group by then get their answers from it:
  whatever they link to is in that group too, or asks them itself. Only sets outside the
  group go on, and are compared with all sets that meet the same first set, many at once
  and without pairs being written out; a link within one group is not looked at again.

So a group of copies costs a few comparisons a set, however large it is. Before texts move, sets
meet by signatures alone, a few bits a shingle: these differ in no more bits than the sets in
shingles, so that a set that differs in too many from all it meets needs no text. Links are
verified on whole sets, and the groups are those of comparing all pairs.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.components import components
from tidemark.llm.words import LOWER, NOT_SPACE, between, buffer, mix, prefixes, slices, spans, windows
from tidemark.session import shared_dir

WORDS = 5
# Counters of the frequency sketch that orders shingles, whatever the size of the corpus.
COUNTERS = 1 << 21
BLOCK = 1 << 15
# Sets that one task compares with one set, or that it compares with others at once.
FANOUT = 256
# Least and most bits of a set's signature; between, a power of two of at least two bits a shingle.
BITS = 512, 16_384
# Pairs that are sent to every executor to pick the texts they need; more are joined by shuffle.
BROADCAST_PAIRS = 150_000


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted hashes of each text's distinct shingles of five words, or of all its words if fewer."""
    starts, ends, owner = spans(LOWER[data], offsets, NOT_SPACE)
    hashes = between(prefixes(LOWER[data]), starts, ends)
    shingles, at = windows(hashes, owner, WORDS)
    n = len(offsets) - 1
    cuts = np.searchsorted(owner[at], np.arange(n + 1))
    edges = np.searchsorted(owner, np.arange(n + 1))
    out = []
    for k in range(n):
        if cuts[k] < cuts[k + 1]:
            out.append(np.unique(shingles[cuts[k] : cuts[k + 1]]))
            continue
        total = np.uint64(0)
        with np.errstate(over="ignore"):
            for h in hashes[edges[k] : edges[k + 1]]:
                total = total * np.uint64(0x9E3779B97F4A7C15) + h
        few = edges[k + 1] - edges[k]
        out.append(mix(np.array([total + np.uint64(few)], np.uint64)) if few else np.zeros(0, np.uint64))
    return out


def class_key(shingles: np.ndarray) -> tuple[int, int]:
    """Two hashes that stand for a set; together 79 bits."""
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:10], "little") & 0x7FFF


def signature(shingles: np.ndarray) -> bytes:
    """Whether an odd number of the shingles falls on each of some bits: what two sets share cancels out."""
    width = min(max(BITS[0], 1 << (2 * len(shingles)).bit_length()), BITS[1])
    odd = np.bincount((shingles & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _folded(signs: np.ndarray, words: int) -> np.ndarray:
    """Signatures, given as words, as they would be with fewer bits."""
    while signs.shape[-1] > words:
        half = signs.shape[-1] // 2
        signs = signs[..., :half] ^ signs[..., half:]
    return signs


def may_link(sign: np.ndarray, size: int, others: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which of the others a set may link with, by signatures as words and by sizes.

    Sets of ``s`` shingles, added up, that differ in ``d`` have ``(s - d) / 2`` in common and
    ``(s + d) / 2`` together; their signatures differ in no more than ``d`` bits.
    """
    words = min(len(sign), others.shape[1])
    bits = np.bitwise_count(_folded(sign, words) ^ _folded(others, words)).sum(axis=1, dtype=np.int64)
    return 100 * (sizes + size - bits) >= percent * (sizes + size + bits)


def needed(n: int, percent: int) -> int:
    """Least overlap that a set of ``n`` must have with any set it reaches ``percent`` with."""
    return -(-percent * n // 100)


def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(COUNTERS, np.int64)
    for piece in slices(batches, "text"):
        for shingles in shingle_sets(*buffer(piece.column("text"))):
            np.add.at(total, (shingles >> np.uint64(43)).astype(np.int64), 1)
    blocks = np.minimum(total, 2**31 - 1).astype(np.int32).reshape(-1, BLOCK)
    used = np.flatnonzero(blocks.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used), pa.array([_packed_counts(blocks[k]) for k in used], pa.binary())], names=["block", "counts"]
    )


def _packed_counts(counts: np.ndarray) -> bytes:
    """Counters by byte planes, compressed: a task's are small, so that three planes are all but empty."""
    return zstandard.ZstdCompressor(level=1).compress(counts.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked_counts(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").ravel()


def _sketch_sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a task's blocks; a block has as many rows as there were tasks and fixed size."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
            own = total.setdefault(block, np.zeros(BLOCK, np.int64))
            own += _unpacked_counts(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int64()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["block", "counts"]
    )


def frequency_sketch(documents: DataFrame) -> np.ndarray:
    """Counters of all shingles of all documents; their number is fixed, so they fit anywhere."""
    found = documents.select("text").mapInArrow(_sketch_rows, "block long, counts binary")
    out = np.zeros((COUNTERS // BLOCK, BLOCK), np.int64)
    for row in found.repartition(16, "block").mapInArrow(_sketch_sum, "block long, counts binary").collect():
        out[row.block] += np.frombuffer(row.counts, np.int64)
    return np.minimum(out.ravel(), 2**31 - 1).astype(np.int32)


def _keyed_rows(batches: Iterator[pa.RecordBatch], signed: bool = False) -> Iterator[pa.RecordBatch]:
    """Class, size and packed text of every document; of equal sets a task, whose number is noted, packs one text.

    ``signed`` adds the signature of every set whose text is packed.
    """
    pack, task = zstandard.ZstdCompressor(level=3), TaskContext.get().partitionId()
    seen: set[tuple[int, int]] = set()
    for piece in slices(batches, "text"):
        sets = shingle_sets(*buffer(piece.column("text")))
        keys = [class_key(s) for s in sets]
        packed, signs = [], []
        for key, text, shingles in zip(keys, piece.column("text"), sets):
            packed.append(None if key in seen else pack.compress((text.as_py() or "").encode("utf-8", "surrogatepass")))
            signs.append(None if key in seen or not signed else signature(shingles))
            seen.add(key)
        columns = [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64())]
        columns += [pa.array([len(s) for s in sets], pa.int64()), pa.array([task] * len(sets), pa.int32()), pa.array(packed, pa.binary())]
        columns, names = [piece.column("doc_id"), *columns], ["doc_id", "t", "tag", "n", "task", "packed"]
        if signed:
            columns, names = [*columns, pa.array(signs, pa.binary())], [*names, "signature"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _signed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _keyed_rows(batches, signed=True)


def postings(documents: DataFrame, sketch: np.ndarray, percent: int) -> DataFrame:
    """``token, t, what``: a row per listed shingle; ``what`` packs tag, size and role.

    The role tells whether the shingle is early enough to meet sets that are no smaller. A task
    lists equal sets once.
    """
    counters = documents.sparkSession.sparkContext.broadcast(sketch)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for piece in slices(batches, "text"):
            tokens, owners, what = [], [], []
            for shingles in shingle_sets(*buffer(piece.column("text"))):
                n = len(shingles)
                listed = n - needed(n, percent) + 1
                if n < 2:
                    continue  # equal sets are one class already
                key = class_key(shingles)
                if key in seen:
                    continue
                seen.add(key)
                often = counters.value[(shingles >> np.uint64(43)).astype(np.int64)]
                order = np.lexsort((shingles, often))[:listed]
                # a set no larger than its partner shares more of its own shingles, so an earlier one
                early = n - -(-2 * percent * n // (100 + percent)) + 1
                tokens.append(shingles[order].view(np.int64))
                owners.append(np.full(listed, key[0]))
                what.append((key[1] << 48) | (n << 1) | (np.arange(listed) < early))
            if tokens:
                columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in (tokens, owners, what)]
                yield pa.RecordBatch.from_arrays(columns, names=["token", "t", "what"])

    return documents.select("text").mapInArrow(rows, "token long, t long, what long")


def _fields() -> list[Column]:
    what = F.col("what")
    return [
        F.shiftrightunsigned(what, 48).alias("tag"),
        F.shiftrightunsigned(what, 1).bitwiseAND(F.lit((1 << 47) - 1)).alias("n"),
        what.bitwiseAND(F.lit(1)).alias("early"),
    ]


def _overlap_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlap of each first set with the others of its group; rows come with the first set ahead."""
    unpack = zstandard.ZstdDecompressor()
    first, own = None, np.zeros(0, np.uint64)
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            piece = batch.slice(at, 64)
            texts = [unpack.decompress(p).decode("utf-8", "surrogatepass") for p in piece.column("packed").to_pylist()]
            sets = shingle_sets(*buffer(pa.array(texts, pa.large_string())))
            out = []
            columns = (piece.column(c).to_pylist() for c in ("pt", "ptag", "part", "member", "t", "tag"))
            for shingles, pt, ptag, part, member, t, tag in zip(sets, *columns):
                if not member:
                    first, own = (pt, ptag, part), shingles
                    continue
                if first != (pt, ptag, part):
                    raise ValueError("a set arrived without the one that it is compared with")
                common = len(np.intersect1d(own, shingles, assume_unique=True))
                out.append((pt, ptag, t, tag, common, len(own) + len(shingles) - common))
            names = ["pt", "ptag", "t", "tag", "common", "either"]
            columns = [pa.array([r[k] for r in out], pa.int64()) for k in range(6)]
            yield pa.RecordBatch.from_arrays(columns, names=names)


@dataclass(frozen=True)
class Classes:
    """Packed texts, sizes and signatures of all classes, some of them in several rows, and for each class which row to take."""

    texts: DataFrame
    holders: DataFrame

    def of(self, wanted: DataFrame, few: bool) -> DataFrame:
        """``wanted`` (t, tag and more) with what is kept of each set, once; a few of them are sent to where that is."""
        held = wanted.join(self.holders, ["t", "tag"])
        return self.texts.join(F.broadcast(held) if few else held, _HOLDER)


def promising(wanted: DataFrame, classes: Classes, percent: int, home: tuple[str, str]) -> DataFrame:
    """``wanted`` without the sets that can link with none that they meet, as far as signatures tell.

    Rows are those of parts (pt, ptag, part) in which sets (member 1) meet a bounded number of
    others (member 0); ``home`` names the columns in which two sets must differ to be of interest.
    """
    group, columns = ["pt", "ptag", "part"], wanted.columns
    signed = classes.of(wanted, wanted.count() <= BROADCAST_PAIRS).select(*columns, "size", "signature")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, key = _Heads(home, percent), None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in group], axis=1)
            edges = np.flatnonzero(np.insert((keys[1:] != keys[:-1]).any(axis=1), 0, True)).tolist() if len(keys) else []
            out: list[pa.RecordBatch] = []
            for low, high in zip(edges, [*edges[1:], len(keys)]):
                if tuple(keys[low]) != key:
                    out += heads.met()
                    heads, key = _Heads(home, percent), tuple(keys[low])
                out += heads.meet(batch.slice(low, high - low))
            yield from (b.select(columns) for b in out if b.num_rows)
        yield from (b.select(columns) for b in heads.met() if b.num_rows)

    dealt = signed.repartition(*group).sortWithinPartitions(*group, "member")
    return dealt.mapInArrow(check, wanted.schema)


class _Heads:
    """The first sets of a part, by signature, and which of them has met one that it may link with."""

    def __init__(self, home: tuple[str, str], percent: int):
        self.home, self.percent = home, percent
        self.rows: list[pa.RecordBatch] = []
        self.hits: list[np.ndarray] = []
        # per run of rows and width of signature: numbers within the run, signatures, sizes, homes
        self.known: list[list[tuple[np.ndarray, ...]]] = []

    def _read(self, rows: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        signs = [np.frombuffer(s, np.uint64) for s in rows.column("signature").to_pylist()]
        return signs, rows.column("size").to_numpy(), np.stack([rows.column(c).to_numpy() for c in self.home], axis=1)

    def _add(self, rows: pa.RecordBatch) -> None:
        signs, sizes, homes = self._read(rows)
        widths = np.array([len(s) for s in signs])
        of = [np.flatnonzero(widths == w) for w in np.unique(widths)]
        self.rows.append(rows)
        self.hits.append(np.zeros(rows.num_rows, bool))
        self.known.append([(at, np.stack([signs[k] for k in at]), sizes[at], homes[at]) for at in of])

    def meet(self, rows: pa.RecordBatch) -> list[pa.RecordBatch]:
        """Keeps what comes as first sets, and returns of the others those that may link with one of these."""
        member = rows.column("member").to_numpy() == 1
        first = int(np.argmax(member)) if member.any() else rows.num_rows
        if first:
            self._add(rows.slice(0, first))
        others = rows.slice(first)
        hit = np.zeros(others.num_rows, bool)
        for k, (sign, size, own) in enumerate(zip(*self._read(others))) if others.num_rows else ():
            for known, hits in zip(self.known, self.hits):
                for at, signs, sizes, homes in known:
                    near = may_link(sign, size, signs, sizes, self.percent) & (homes != own).any(axis=1)
                    hits[at] |= near
                    hit[k] |= near.any()
        return [others.filter(pa.array(hit))]

    def met(self) -> list[pa.RecordBatch]:
        return [rows.filter(pa.array(hit)) for rows, hit in zip(self.rows, self.hits)]


def overlaps(pairs: DataFrame, classes: Classes, tables: _Tables, percent: int) -> DataFrame:
    """``pt, ptag, t, tag, common, either`` for distinct pairs of classes, of those at least that reach ``percent``.

    A first set meets its partners in parts of bounded size, so no task gets all of them.
    """
    parts = pairs.groupBy("pt", "ptag").agg(F.ceil(F.count("*") / FANOUT).cast("int").alias("parts"))
    members = pairs.join(parts, ["pt", "ptag"]).select(
        "pt", "ptag", F.pmod(F.xxhash64("t", "tag"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("member"), "t", "tag"
    )
    heads = parts.select(
        "pt", "ptag", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("member"),
        F.col("pt").alias("t"), F.col("ptag").alias("tag"),
    )
    wanted = tables.put("near", promising(members.unionByName(heads), classes, percent, ("t", "tag")))
    rows = classes.of(wanted, wanted.count() <= BROADCAST_PAIRS)
    group = ["pt", "ptag", "part"]
    return (
        rows.select(*group, "member", "t", "tag", "packed")
        .repartition(*group)
        .sortWithinPartitions(*group, "member")
        .mapInArrow(_overlap_rows, "pt long, ptag long, t long, tag long, common long, either long")
    )


class _Tables:
    """Tables of one join in the shared folder."""

    def __init__(self, spark):
        self.spark = spark
        self.folder = f"{shared_dir(spark)}/jaccard-{uuid.uuid4().hex}"

    def put(self, name: str, df: DataFrame) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{self.folder}/{name}")
        return self.spark.read.parquet(f"{self.folder}/{name}")


def _linked(percent: int) -> Column:
    return 100 * F.col("common") >= percent * F.col("either")


_PAIR = ["pt", "ptag", "t", "tag"]
# A set's text is looked up by its class and the task that holds it.
_HOLDER = ["t", "tag", "task"]


def links(classes: Classes, listed: DataFrame, tables: _Tables, percent: int) -> DataFrame:
    """Groups ``t, tag, component`` of all classes that link with another one."""
    # One shuffle serves both what is known of a list and the join with it: both ask it for the same packed columns.
    packed = listed.filter("token is not null").select("token", "t", "what").repartition("token")
    dealt = packed.select("token", "t", *_fields())
    lists = dealt.groupBy("token").agg(
        F.count("*").alias("members"),
        F.max("early").alias("any_early"),
        F.min(F.struct("n", "t", "tag")).alias("first"),
        F.max(F.struct("n", "t", "tag")).alias("last"),
        F.bit_xor(F.xxhash64("t", "tag")).alias("mark"),
        F.sum(F.shiftrightunsigned(F.xxhash64("tag", "t"), 32)).alias("sum"),
    )
    lists = lists.filter((F.col("first") != F.col("last")) & (F.col("any_early") == 1))
    # Lists of the same sets give the same pairs: one of them is enough.
    lists = lists.groupBy("first", "last", "members", "mark", "sum").agg(F.min("token").alias("token"))
    others = dealt.join(lists.select("token", "first"), "token").select(
        F.col("first.t").alias("pt"), F.col("first.tag").alias("ptag"), "t", "tag", F.col("first.n").alias("pn"), "n"
    )
    # Lists with the same first set are one star around it.
    stars = tables.put("stars", others.filter("t != pt or tag != ptag").distinct())
    pairs = tables.put("pairs", stars.filter(F.col("pn") * 100 >= percent * F.col("n")).select(*_PAIR))
    found = tables.put("overlaps", overlaps(pairs, classes, tables, percent))
    edges = found.filter(_linked(percent)).select(*_PAIR).distinct()
    groups = tables.put("groups", _groups(edges))
    more = tables.put("rest", _compared(_open(stars, groups), classes, tables, percent))
    return groups if more.isEmpty() else tables.put("all-groups", _groups(edges.unionByName(more).distinct()))


def _open(stars: DataFrame, groups: DataFrame) -> DataFrame:
    """Sets of each star with their size ``n``, group ``ot, otag``, and whether they are outside the first set's (``open``).

    Stars in which no such set could meet another one are left out.
    """
    own = F.coalesce("component", F.struct("t", "tag"))
    lead = F.coalesce("lead", F.struct(F.col("pt").alias("t"), F.col("ptag").alias("tag")))
    leads = groups.select(F.col("t").alias("pt"), F.col("tag").alias("ptag"), F.col("component").alias("lead"))
    placed = stars.join(groups, ["t", "tag"], "left").join(leads, ["pt", "ptag"], "left")
    placed = placed.select(*_PAIR, "n", own["t"].alias("ot"), own["tag"].alias("otag"), (own != lead).alias("open"))
    sizes = placed.groupBy("pt", "ptag").agg(F.count("*").alias("members"), F.count_if("open").alias("waiting"))
    return placed.join(sizes.filter("waiting > 0 and members > 1").select("pt", "ptag"), ["pt", "ptag"])


def _meetings(placed: DataFrame, percent: int) -> DataFrame:
    """Which sets of a star meet in which part: ``pt, ptag, part, member, t, tag, ot, otag``.

    Open sets stand in blocks by size, each a step of the threshold wide and dealt to parts of
    at most ``FANOUT``. A set skips the blocks whose sizes rule a link out, and an open set those
    of larger sets too, as they come to it; so it is sent to few parts however many sets a star has.
    """
    star, fields = ["pt", "ptag"], ["t", "tag", "ot", "otag"]
    step = F.floor(F.log("n") / F.log(F.lit(100 / percent))).cast("long") if percent < 100 else F.col("n")
    placed = placed.withColumn("step", step)
    blocks = placed.filter("open").groupBy(*star, "step").agg(
        F.ceil(F.count("*") / FANOUT).alias("parts"), F.count("*").alias("heads"), F.min("n").alias("least"), F.max("n").alias("most")
    )
    numbered = lambda part: (F.col("step") * F.lit(1 << 32) + part).alias("part")
    near = F.explode(F.sequence(F.col("own") - 2, F.col("own") + 2)).alias("step")
    members = placed.select(*star, *fields, "n", "open", F.col("step").alias("own")).select("*", near).join(blocks, [*star, "step"])
    fits = (100 * F.col("most") >= percent * F.col("n")) & (percent * F.col("least") <= 100 * F.col("n"))
    smaller = ~F.col("open") | (F.col("least") <= F.col("n"))
    alone = F.col("open") & (F.col("heads") == 1) & (F.col("own") == F.col("step"))
    members = members.filter(fits & smaller & ~alone)
    members = members.select(*star, "step", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("p"), *fields)
    heads = placed.filter("open").join(blocks.select(*star, "step", "parts"), [*star, "step"])
    heads = heads.join(members.select(*star, "step").distinct(), [*star, "step"], "left_semi")
    heads = heads.select(*star, numbered(F.pmod(F.xxhash64("t", "tag"), F.col("parts"))), F.lit(0).alias("member"), *fields)
    return heads.unionByName(members.select(*star, numbered(F.col("p")), F.lit(1).alias("member"), *fields))


def _compared(placed: DataFrame, classes: Classes, tables: _Tables, percent: int) -> DataFrame:
    """Links that tie groups together, found by comparing the open sets of a star with all that they could link with.

    Each part meets its sets one after the other and holds nothing but its own open sets.
    """
    group, fields = ["pt", "ptag", "part"], ["t", "tag", "ot", "otag"]
    wanted = tables.put("meetings", _meetings(placed, percent))
    wanted = tables.put("near-meetings", promising(wanted, classes, percent, ("ot", "otag")))
    rows = classes.of(wanted, wanted.count() <= BROADCAST_PAIRS).select(*group, "member", *fields, "packed")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        block, key = _Block(percent), None
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                piece = batch.slice(at, 64)
                texts = [unpack.decompress(p).decode("utf-8", "surrogatepass") for p in piece.column("packed").to_pylist()]
                sets = shingle_sets(*buffer(pa.array(texts, pa.large_string())))
                columns = (piece.column(c).to_pylist() for c in (*group, "member", *fields))
                out: list[tuple] = []
                for shingles, *row in zip(sets, *columns):
                    if tuple(row[:3]) != key:
                        block, key = _Block(percent), tuple(row[:3])
                    node, home = (row[4], row[5]), (row[6], row[7])
                    if row[3]:
                        out += block.links(shingles, node, home)
                    else:
                        block.add(shingles, node, home)
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(4)], names=_PAIR)

    dealt = rows.repartition(*group).sortWithinPartitions(*group, "member")
    return dealt.mapInArrow(compare, "pt long, ptag long, t long, tag long")


class _Block:
    """Some sets and an index of their shingles, against which other sets are held one by one."""

    def __init__(self, percent: int):
        self.percent = percent
        self.sets: list[np.ndarray] = []
        self.nodes: list[tuple[int, int]] = []
        self.homes: list[tuple[int, int]] = []
        self.parent: dict[tuple[int, int], tuple[int, int]] = {}
        self.index: tuple[np.ndarray, np.ndarray] | None = None

    def root(self, home: tuple[int, int]) -> tuple[int, int]:
        while self.parent.setdefault(home, home) != home:
            self.parent[home] = home = self.parent[self.parent[home]]
        return home

    def add(self, shingles: np.ndarray, node: tuple[int, int], home: tuple[int, int]) -> None:
        self.sets.append(shingles)
        self.nodes.append(node)
        self.homes.append(home)

    def links(self, shingles: np.ndarray, node: tuple[int, int], home: tuple[int, int]) -> list[tuple]:
        """Links of a set with the block's that tie two groups together which were apart so far."""
        if not self.sets:
            return []
        if self.index is None:
            every = np.concatenate(self.sets)
            owner = np.repeat(np.arange(len(self.sets)), [len(s) for s in self.sets])
            order = np.argsort(every, kind="stable")
            self.index = every[order], owner[order]
            self.sizes = np.array([len(s) for s in self.sets])
        every, owner = self.index
        low, high = np.searchsorted(every, shingles, "left"), np.searchsorted(every, shingles, "right")
        count = high - low
        at = np.arange(int(count.sum())) + np.repeat(low - (np.cumsum(count) - count), count)
        common = np.bincount(owner[at], minlength=len(self.sets))
        out = []
        for k in np.flatnonzero(100 * common >= self.percent * (self.sizes + len(shingles) - common)).tolist():
            a, b = self.root(self.homes[k]), self.root(home)
            if self.nodes[k] != node and a != b:
                self.parent[a] = b
                out.append((*self.nodes[k], *node))
        return out


def _groups(edges: DataFrame) -> DataFrame:
    node = lambda t, tag: F.struct(F.col(t).alias("t"), F.col(tag).alias("tag"))
    found = components(edges.select(node("pt", "ptag").alias("a"), node("t", "tag").alias("b")))
    return found.select("node.t", "node.tag", "component")


def jaccard_groups(documents: DataFrame, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, size of its set, smallest doc_id it is connected with by links.

    Two documents link when ``100 * common >= percent * either``. A null or empty text, or one
    of white space, has an empty set and is linked with nothing. Rows that share an id count
    as one document; rows without an id are linked with nothing and have a null component.
    Repeated rows give a row each; other columns are ignored.
    """
    tables = _Tables(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, t long, tag long, n long, task int, packed binary, signature binary"
    own = documents.select("doc_id", "text").mapInArrow(_signed_rows, fields)
    own = tables.put("documents", own)
    known = own.filter("n > 0 and doc_id is not null")
    ids = known.groupBy("t", "tag").agg(F.min("doc_id").alias("class"))
    # Each task that met a class has its text; the one with the least number holds it.
    texts = own.filter("packed is not null")
    holders = tables.put("holders", texts.groupBy("t", "tag").agg(F.min("task").alias("task")))
    classes = Classes(texts.select(*_HOLDER, "packed", F.col("n").alias("size"), "signature"), holders)
    sketch = frequency_sketch(documents)
    listed = postings(documents.filter("doc_id is not null"), sketch, percent)
    groups = links(classes, listed, tables, percent)
    # Every class with its group, the group named by its least id.
    named = ids.join(groups, ["t", "tag"], "left")
    group = F.coalesce("component", F.struct("t", "tag"))
    named = named.select("t", "tag", group.alias("group"), "class")
    least = named.groupBy("group").agg(F.min("class").alias("least"))
    named = tables.put("named", named.join(least, "group").select("t", "tag", "least"))
    # An id that stands for several texts ties their groups together.
    several = known.join(named, ["t", "tag"]).groupBy("doc_id").agg(F.min("least").alias("a"), F.max("least").alias("b"))
    several = tables.put("several", several.filter("a != b").select("a", "b"))
    if not several.isEmpty():
        tied = tables.put("tied", components(several))
        named = named.join(tied, F.col("least") == F.col("node"), "left").select("t", "tag", F.coalesce("component", "least").alias("least"))
    member = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return own.join(named, ["t", "tag"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(member, F.col("least")).otherwise(F.col("doc_id")).alias("component_id")
    )


def one_of_each_group(documents: DataFrame, percent: int = 80) -> DataFrame:
    """The documents, all columns kept, with one left of each group: the one with the smallest id.

    Of rows that share an id, the one with the least text stays. Rows without an id and texts
    without words belong to no group and all stay.
    """
    grouped = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)) & F.col("doc_id").isNotNull()
    groups = jaccard_groups(documents, percent)
    kept = groups.filter("n_shingles > 0 and doc_id = component_id").select("doc_id").distinct()
    names = [f"`{c}`" for c in documents.columns]
    found = documents.filter(grouped).join(kept, "doc_id", "left_semi")
    one = found.groupBy("doc_id").agg(F.min_by(F.struct(*names), "text").alias("row")).select("row.*")
    return documents.filter(~grouped).unionByName(one)
