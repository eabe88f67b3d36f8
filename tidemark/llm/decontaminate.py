"""Benchmark decontamination by spaced seeds, DataFrame functions only.

Words are compared by hash. A fixed mask reads some positions of a short window and skips the
others, so that a substituted word at a skipped position leaves the seed intact. Seeds of all
texts meet those of the benchmark in a join; around every meeting the aligned words are
compared, and a run of ``WINDOW`` words with at most ``SUBSTITUTIONS`` differences is a leak.

The two masks are complete for these bounds: wherever two words of thirteen are replaced, one
mask fits in somewhere without touching them (a test tries all cases).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.scratch import Scratch

WINDOW = 13
SUBSTITUTIONS = 2
MASKS = ((0, 1, 2, 3, 5, 8), (0, 3, 4, 6, 7, 8))
SPAN = 9
# Words of a benchmark whose seeds are sent to every executor; larger ones are joined by shuffle.
BROADCAST_WORDS = 250_000
# Digests of leaking texts, of 64 characters each, that are sent to every executor.
BROADCAST_TEXTS = 200_000

_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-cased words, in order; null and empty texts have none."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _NO_WORD), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _masks(short: list[int]) -> list[tuple[int, ...]]:
    """The fixed masks, and for items shorter than a mask one that reads all their words."""
    return [*MASKS, *(tuple(range(n)) for n in short)]


def seeds(texts: DataFrame, short: list[int]) -> DataFrame:
    """A row per seed: the columns of ``texts``, the window's first word ``at``, and ``seed``."""
    spans = [SPAN, *short]
    shortest = min(spans)
    n = F.size("words")
    out = texts.withColumn("at", F.explode(F.when(n >= shortest, F.sequence(F.lit(0), n - shortest))))
    codes = []
    for k, mask in enumerate(_masks(short)):
        code = F.xxhash64(F.lit(k), *(F.col("words")[F.col("at") + o] for o in mask))
        fits = F.col("at") + (mask[-1] + 1) <= n
        codes.append(code if mask[-1] + 1 == shortest else F.when(fits, code))
    return out.withColumn("seed", F.explode(F.array(*codes))).filter(F.col("seed").isNotNull())


def _around(met: DataFrame) -> DataFrame:
    """Places where seeds met, each with the few words around it (``near``, from ``near_at`` on) instead of its text's."""
    start = F.greatest(F.col("at") - (WINDOW - SPAN), F.lit(0))
    near = F.slice("words", start + 1, F.lit(2 * WINDOW - SPAN))
    return met.select("doc_id", "digest", "at", "item", "item_at", F.size("words").alias("n_doc"), start.alias("near_at"), near.alias("near"))


def leaks(documents: DataFrame, benchmark: DataFrame, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """A row per text and benchmark item that it leaks: ``doc_id, digest, item_id``, where the
    best run starts in both (in words), its differing words, and how many seeds led to a run.

    ``digest`` is the SHA-256 of the text, so rows with null or repeated ids can be told apart.
    Items of fewer than ``WINDOW`` words count only when all their words stand unchanged; items
    and texts without words match nothing. Rows that repeat on either side give one row. Other
    columns are ignored.
    """
    items = benchmark.select("item_id", word_hashes(F.col("text")).alias("words")).filter(F.size("words") > 0).distinct()
    sizes = items.select(F.size("words").alias("n")).groupBy(F.least("n", F.lit(SPAN)).alias("n")).agg(F.sum("n").alias("total")).collect()
    short = sorted(r.n for r in sizes if r.n < SPAN)
    items = items.select("item_id", F.col("words").alias("item_words"), F.xxhash64("item_id", "words").alias("item"))
    keys = seeds(items.select("item", F.col("item_words").alias("words")), short).select("item", F.col("at").alias("item_at"), "seed")
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")
    # One digest a row, before its words are looked at one by one.
    docs = documents.select("doc_id", digest, word_hashes(F.col("text")).alias("words"))
    if sum(r.total for r in sizes) <= broadcast_words:
        # A bounded number of seeds: texts stay where they are.
        met = seeds(docs, short).join(F.broadcast(keys), "seed")
        hits = _around(met).join(F.broadcast(items), "item")
    else:
        met = seeds(docs.select("digest", "words"), short).select("digest", "at", "seed").join(keys, "seed")
        # A seed names its mask, so both masks of one place count, as they do above.
        met = met.select("digest", "at", "item", "item_at", "seed").distinct().join(docs, "digest")
        hits = _around(met).join(items, "item")
    n_item, n_doc = F.size("item_words"), F.col("n_doc")
    low = F.greatest(F.col("item_at") - (WINDOW - SPAN), F.lit(0), F.col("item_at") - F.col("at"))
    high = F.least(F.col("item_at") + WINDOW, n_item, F.col("item_at") + n_doc - F.col("at"))
    shift = F.col("at") - F.col("item_at")
    around = hits.select(
        "doc_id", "digest", "item_id", low.alias("low"), shift.alias("shift"), n_item.alias("n_item"),
        F.slice("item_words", low + 1, high - low).alias("x"),
        F.slice("near", low + shift - F.col("near_at") + 1, high - low).alias("y"),
    )
    differ = F.zip_with("x", "y", lambda a, b: (a != b).cast("int"))
    length = F.least("n_item", F.lit(WINDOW))
    runs = F.when(
        F.size("differ") >= length,
        F.transform(
            F.sequence(F.lit(0), F.size("differ") - length),
            lambda s: F.struct(F.aggregate(F.slice("differ", s + 1, length), F.lit(0), lambda a, b: a + b).alias("n"), (F.col("low") + s).alias("start")),
        ),
    )
    allowed = F.when(F.col("n_item") >= WINDOW, F.lit(SUBSTITUTIONS)).otherwise(F.lit(0))
    best = around.withColumn("differ", differ).withColumn("best", F.array_min(runs)).filter(F.col("best.n") <= allowed)
    return (
        best.select("doc_id", "digest", "item_id", "best", "shift")
        .groupBy("doc_id", "digest", "item_id")
        .agg(F.min(F.struct("best.n", "best.start", "shift")).alias("first"), F.count("*").alias("n_seeds"))
        .select(
            "doc_id", "digest", "item_id",
            F.col("first.start").cast("long").alias("item_word"),
            (F.col("first.start") + F.col("first.shift")).cast("long").alias("doc_word"),
            F.col("first.n").cast("long").alias("n_differ"), "n_seeds",
        )
    )


def decontaminated(documents: DataFrame, benchmark: DataFrame, broadcast_texts: int = BROADCAST_TEXTS) -> DataFrame:
    """The documents, all columns and repeated rows kept, whose text leaks no benchmark item.

    The digests of leaking texts are written once. Up to ``broadcast_texts`` of them go to every
    task, so that the documents stay where they are; more are joined by shuffle.
    """
    found = leaks(documents.select("doc_id", "text"), benchmark).select(F.col("digest").alias("leaked")).distinct()
    found = Scratch(documents.sparkSession, "leaks").put("leaked", found)
    if found.count() <= broadcast_texts:
        found = F.broadcast(found)
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return documents.join(found, digest == F.col("leaked"), "left_anti")
