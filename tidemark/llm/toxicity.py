"""Toxicity: a support vector machine on a subsequence string kernel with Nyström landmarks.

The kernel of two words counts the subsequences of three symbols that they share, a gap in
either one lowering the weight; symbols that are no letters are left out beforehand. So an
insult with inserted or left-out characters stays close to the insult. Landmark words span
the Nyström feature space, a linear machine is trained in it on sentences, and a text
scores by its worst word and by how many words are bad. Since kernel values are sums over subsequences, landmarks and
weights fold into one table per subsequence, and scoring whole texts needs array passes only.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.quality_rules import SAMPLE_CHARS, one_text_each, sigmoid
from tidemark.llm.words import SPACE, buffer, slices

# Labelled documents of each class that the model is fitted on at most; every row is scored.
SAMPLE_TOXIC, SAMPLE_CLEAN = 1200, 1500
LANDMARKS = 128
DECAY = 0.6
# A word that a larger share of the clean sentences uses is no insult.
RARE = 0.0003
# Places of the second and third symbol of a subsequence after the first.
PATTERNS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
WEIGHTS = tuple(DECAY ** (last - 2) for _, last in PATTERNS)
SYMBOLS = 48
CODES = SYMBOLS**3

# Symbols: 0 the edge of a word, 1-26 letters, 27 digits, 28-31 bytes that open a character beyond
# ASCII, 32-47 those that go on with one (the two together tell letters of a script apart), 255 left out.
_SYMBOL = np.full(256, 255, np.uint8)
_SYMBOL[SPACE] = 0
for _k in range(26):
    _SYMBOL[[65 + _k, 97 + _k]] = 1 + _k
_SYMBOL[48:58] = 27
_SYMBOL[128:192] = 32 + np.arange(128, 192) % 16
_SYMBOL[192:] = 28 + np.arange(192, 256) % 4


@dataclass
class Symbols:
    """Symbol string of a batch: words between edges, ``edges[k]`` before word k; ``owner`` its text."""

    values: np.ndarray
    edges: np.ndarray
    sizes: np.ndarray
    owner: np.ndarray
    n_texts: int


def symbols(data: np.ndarray, offsets: np.ndarray) -> Symbols:
    """Words of all texts as symbols; single letters that follow each other make one word."""
    n = len(offsets) - 1
    raw = np.insert(_SYMBOL[data], offsets[:-1], 0) if len(data) else np.zeros(n, np.uint8)
    at = offsets[:-1] + np.arange(n)  # the edge that opens each text
    kept = raw != 255
    moved = np.cumsum(kept) - 1
    raw, at = raw[kept], moved[at]
    opens = np.zeros(len(raw) + 1, bool)
    opens[at] = True
    # of several edges in a row the last stays, and the one that opens a text counts for it
    edge = raw == 0
    edges = np.flatnonzero(edge & ~np.append(edge[1:], True))
    if not len(edges):
        return Symbols(raw, edges, edges, edges, n)
    owner = np.searchsorted(at, edges, "right") - 1
    ends = np.append(np.flatnonzero(edge & ~np.insert(edge[:-1], 0, True)), len(raw))
    ends = ends[np.searchsorted(ends, edges, "right")]
    sizes = ends - edges - 1
    glued = np.zeros(len(edges), bool)
    glued[1:] = (sizes[1:] == 1) & (sizes[:-1] == 1) & (owner[1:] == owner[:-1])
    letters = np.ones(len(raw), bool)
    letters[edge] = False
    letters[edges[~glued]] = True
    place = np.cumsum(letters) - 1
    values, edges, owner = raw[letters], place[edges[~glued]], owner[~glued]
    return Symbols(values, edges, np.diff(np.append(edges, len(values))) - 1, owner, n)


def _norms(longest: int) -> np.ndarray:
    """By word size: the length of a word's vector if no subsequence occurred twice."""
    size = np.arange(longest + 1)
    total = np.zeros(longest + 1)
    for (_, last), weight in zip(PATTERNS, WEIGHTS):
        total += np.maximum(size + 2 - last, 0) * weight**2
    return np.sqrt(np.maximum(total, 1e-9))


def subsequences(s: Symbols) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Per pattern: codes of the subsequences, where they start, and their weight."""
    values = np.append(s.values, np.zeros(5, np.uint8)).astype(np.int32)
    n = len(s.values)
    if not n:
        return
    following = np.append(s.edges[1:], n)
    room = np.repeat(following, np.diff(np.append(s.edges, n))) - np.arange(n) if len(s.edges) else np.zeros(n)
    for (second, last), weight in zip(PATTERNS, WEIGHTS):
        at = np.flatnonzero(room >= last)
        yield (values[at] * SYMBOLS + values[at + second]) * SYMBOLS + values[at + last], at, weight


def word_scores(s: Symbols, table: np.ndarray) -> np.ndarray:
    """Sum of the table over each word's subsequences, divided by the word's norm."""
    if not len(s.edges):
        return np.zeros(0)
    total = np.zeros(len(s.values), np.float32)
    for code, at, weight in subsequences(s):
        total[at] += table[code] * np.float32(weight)
    # a text may open with edges of others before it; the first word starts at its own edge
    return np.add.reduceat(total, s.edges) / _norms(int(s.sizes.max()))[s.sizes]


def vectors(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normed sparse vectors of words: row, code and value of each entry."""
    lengths = np.cumsum([0, *(len(w) for w in words)])
    s = symbols(np.frombuffer(b"".join(words), np.uint8), lengths)
    rows, codes, values = [], [], []
    which = np.repeat(s.owner, np.diff(np.append(s.edges, len(s.values)))) if len(s.edges) else s.owner
    norms = np.ones(len(words))
    norms[s.owner] = _norms(int(s.sizes.max(initial=1)))[s.sizes]
    for code, at, weight in subsequences(s):
        rows.append(which[at])
        codes.append(code)
        values.append(np.full(len(at), weight))
    if not rows:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    row = np.concatenate(rows)
    return row, np.concatenate(codes), np.concatenate(values) / norms[row]


def kernel(words: list[bytes], dense: np.ndarray) -> np.ndarray:
    """Kernel of words with landmarks given as dense vectors, a row each."""
    row, code, value = vectors(words)
    out = np.zeros((len(words), len(dense)))
    for k in range(len(dense)):
        out[:, k] = np.bincount(row, value * dense[k][code], len(words))
    return out


def _dense(words: list[bytes]) -> np.ndarray:
    row, code, value = vectors(words)
    out = np.zeros((len(words), CODES), np.float32)
    np.add.at(out, (row, code), value)
    return out


_PARTS = re.compile(rb"[.!?\n]+(?:\s+|$)")
_DROPPED = bytes(b for b in range(128) if _SYMBOL[b] == 255)
_LOWERED = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def sentences(text: str) -> list[list[bytes]]:
    """Distinct words of each sentence, lower-cased, without what the kernel leaves out."""
    raw = text.encode("utf-8", "surrogatepass").translate(_LOWERED)
    return [sorted(set(part.translate(None, _DROPPED).split())) for part in _PARTS.split(raw) if part.strip()]


def _hints(lines: tuple[set, set]) -> dict[bytes, float]:
    """How much more often each part of a word occurs in sentences of toxic documents (signed G²).

    ``lines`` holds the distinct sentences of clean and of toxic documents, so that copies of
    one document count once.
    """
    seen = [Counter(), Counter()]
    for count, own in zip(seen, lines):
        for words in own:
            count.update({(b" " + w + b" ")[i : i + k] for w in words for k in (5, 6) for i in range(max(1, len(w) + 3 - k))})
    n = [max(1, len(own)) for own in lines]
    out = {}
    for part, often in seen[1].items():
        rare = seen[0].get(part, 0)
        if often < 2 or often / n[1] <= 3 * rare / n[0]:
            continue
        expected = (often + rare) / (n[0] + n[1])
        out[part] = often * np.log(often / (expected * n[1])) + (rare * np.log(rare / (expected * n[0])) if rare else 0)
    return out


def _hinted(word: bytes, hints: dict[bytes, float]) -> float:
    padded = b" " + word + b" "
    return max((hints.get(padded[i : i + k], 0.0) for k in (5, 6) for i in range(max(1, len(word) + 3 - k))), default=0.0)


def _machine(x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float = 1e-5) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps over the rows inside the margin.

    The counterexamples together weigh three times the examples, since one word out of all
    words of a clean text is enough to condemn it.
    """
    x = np.column_stack([x, np.ones(len(x))])
    sign = np.where(y, 1.0, -1.0)
    cost = weights * np.where(y, 0.25 / weights[y].sum(), 0.75 / max(1, weights[~y].sum()))
    keep = ridge * np.eye(x.shape[1])
    keep[-1, -1] = 1e-9
    w = np.zeros(x.shape[1])
    inside = np.ones(len(x), bool)
    for _ in range(30):
        part = x[inside] * cost[inside, None]
        w = np.linalg.solve(part.T @ x[inside] + keep, part.T @ sign[inside])
        before, inside = inside, sign * (x @ w) < 1
        if not inside.any() or np.array_equal(before, inside):
            break
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights of a logistic regression on few columns, the intercept last, with smoothed targets."""
    x = np.column_stack([x, np.ones(len(x))])
    target = np.where(y, (y.sum() + 1) / (y.sum() + 2), 1 / ((~y).sum() + 2))
    w = np.zeros(x.shape[1])
    keep = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = sigmoid(x @ w)
        curve = x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + keep
        step = np.linalg.solve(curve, x.T @ (p - target) + keep @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    """Folded table over subsequences, intercept, and the weights that turn margins into scores."""

    table: np.ndarray
    bias: float
    weights: np.ndarray

    def features(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Per text: largest margin of its words, log of how many are positive, log of all words.

        A text without words gets the intercept as its margin.
        """
        s = symbols(data, offsets)
        worst = np.full(s.n_texts, 0.0)
        bad = np.zeros(s.n_texts)
        if len(s.edges):
            found = word_scores(s, self.table)
            first = np.flatnonzero(np.insert(s.owner[1:] != s.owner[:-1], 0, True))
            worst[s.owner[first]] = np.maximum.reduceat(found, first)
            bad = np.bincount(s.owner, found + self.bias > 0, s.n_texts)
        n_words = np.bincount(s.owner, minlength=s.n_texts)
        return np.column_stack([np.clip(worst + self.bias, -3, 1.5), np.log1p(bad), np.log1p(n_words)])

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return sigmoid(self.features(data, offsets) @ self.weights[:-1] + self.weights[-1])


def _texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return buffer(pa.array(texts, pa.large_string()))


def fit(texts: list[str], toxic: np.ndarray, rounds: int = 5) -> Model | None:
    """A model from whole texts and their labels; None without both classes.

    A toxic document is bad in some sentences only. A sentence that a clean document holds too
    is clean; of the others, words that clean sentences hardly use and whose parts stand out
    mark the bad ones at first. Each round takes those words as examples, the worst words of
    clean sentences as counterexamples, picks landmarks among both, trains anew and marks with
    the new margins. A quarter of the documents is left out of that and fits the sigmoid.
    """
    if len(set(toxic.tolist())) < 2:
        return None
    rest = np.zeros(len(texts), bool)
    for label in (False, True):
        own = np.flatnonzero(toxic == label)
        rest[own[3::4]] = len(own) >= 8
    train = np.flatnonzero(~rest)
    parts = {i: [tuple(words) for words in sentences(texts[i])] for i in train}
    clean = {words for i in train if not toxic[i] for words in parts[i]}
    lines = sorted({words for i in train if toxic[i] for words in parts[i]} - clean)
    hints = _hints((clean, lines))
    common = Counter(w for words in clean for w in words)
    judged = {w: _hinted(w, hints) for w in {*common, *(w for words in lines for w in words)}}
    background = [w for w, _ in sorted(common.items(), key=lambda x: (-x[1], x[0]))[:1500]]
    background += [w for w, _ in sorted(common.items(), key=lambda x: (hash_of(x[0]), x[0]))[:3000]]
    usual = max(1, int(RARE * len(clean)))
    bound = max(6.0, 0.15 * max(hints.values(), default=0.0))
    table, bias = np.zeros(CODES, np.float32), 0.0
    tough: list[bytes] = []
    for _ in range(rounds):
        bad: list[bytes] = []
        for words in lines:
            bad += [w for w in words if judged[w] > bound and common.get(w, 0) <= usual]
        if not bad:
            break
        bound = 0.0
        tough += [w for w in sorted(common, key=lambda w: (-judged[w], w))[:600] if w not in tough]
        good = sorted({*background, *tough} - set(bad))
        weights = 1 + 4 * np.isin(np.array(good, object), np.array(tough, object))
        ranked = [w for w, _ in sorted(Counter(bad).items(), key=lambda x: (-x[1], x[0]))]
        chosen = sorted(set(ranked[: LANDMARKS // 2]) | set(sorted(ranked, key=hash_of)[: LANDMARKS // 4]))
        chosen += [w for w in (*tough[::-1], *background) if w not in chosen][: LANDMARKS - len(chosen)]
        dense = _dense(chosen)
        values, axes = np.linalg.eigh(kernel(chosen, dense) + 1e-6 * np.eye(len(chosen)))
        half = axes / np.sqrt(np.maximum(values, 1e-6)) @ axes.T
        x = kernel(bad + good, dense) @ half
        w, bias = _machine(x, np.arange(len(x)) < len(bad), np.append(np.ones(len(bad)), weights))
        table = (half @ w @ dense).astype(np.float32)
        every = sorted(judged)
        s = symbols(*_texts([w.decode("utf-8", "replace") for w in every]))
        found = np.full(len(every), 0.0)
        np.maximum.at(found, s.owner, word_scores(s, table))
        judged = dict(zip(every, (found + bias).tolist()))
    model = Model(table, bias, np.zeros(4))
    held = np.flatnonzero(rest) if len(set(toxic[rest].tolist())) == 2 else train
    model.weights = _logistic(model.features(*_texts([texts[i] for i in held])), toxic[held])
    return model


def hash_of(word: bytes) -> int:
    return int.from_bytes(word[:8].ljust(8, b"\0"), "little") * 0x9E3779B97F4A7C15 % 2**64 >> 11


def held_out() -> F.Column:
    """Rows whose labels are never learnt from, fixed by the contract."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0


def _examples(documents: DataFrame, labels: DataFrame) -> DataFrame:
    marks = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg((F.avg("toxic") >= 0.5).alias("label"))
        .filter(~held_out())
    )
    order = (F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxic")), F.col("doc_id"))
    picked = marks.filter("label").orderBy(*order).limit(SAMPLE_TOXIC)
    picked = picked.unionByName(marks.filter("not label").orderBy(*order).limit(SAMPLE_CLEAN))
    texts = documents.select("doc_id", "text").filter(F.length("text") <= SAMPLE_CHARS)
    # A fixed number of ids, so they fit on every executor, and one text of bounded size for each.
    return one_text_each(texts.join(F.broadcast(picked), "doc_id"), "label").select("text", "label")


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: whether its label is held out, score and prediction.

    A null or empty text scores as a text without words; a null id is not held out. Repeated
    rows give a row each; other columns are ignored. Without labels of both classes every
    score is 0.
    """
    rows = sorted(((r.text, bool(r.label)) for r in _examples(documents, labels).collect()))
    model = fit([t for t, _ in rows], np.array([b for _, b in rows], bool))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            data, offsets = buffer(piece.column("text"))
            found = model.scores(data, offsets) if model else np.zeros(piece.num_rows)
            columns = [piece.column("doc_id"), piece.column("held_out"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    marked = documents.select("doc_id", "text", F.coalesce(held_out(), F.lit(False)).alias("held_out"))
    return marked.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")
