"""Benchmark passages in documents, found by spaced seeds and confirmed word by word.

A mask such as 101111 hashes some words of a window of six and ignores the others, so that a
changed word breaks only the windows in which it counts. Masks' hashes of benchmark and documents
are joined; each hit fixes an item and a shift against it, where words are compared.

All steps are DataFrame operations. Documents' hashes are never shuffled while the benchmark's
distinct hashes are few enough to be sent to all executors, which is checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalwatch.llm.common import picked, settle, without

#: Together these meet every window of 20 words in which 16 or more are as in the item, wherever
#: the others lie; tests/llm/test_spaced_seeds.py tries all cases.
MASKS = ("101111", "110111")
WINDOW = 20
#: Shorter items are one window; from so many words on, one more word may differ. The masks meet
#: all these cases too.
MAY_DIFFER = (9, 13, 16, WINDOW)
#: Most distinct hashes of the benchmark that are broadcast (8 bytes each); more are joined by a
#: shuffle of the documents' hashes.
BROADCAST_HASHES = 4_000_000
#: Words of a document's blocks at least.
LEAST_BLOCK = 64


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null is empty."""
    found = F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+")
    return F.filter(found, lambda w: w != "")


def needed(n: Column) -> Column:
    """How many words of a window of ``n`` must be equal: of 20, 16."""
    out = n
    for length in MAY_DIFFER:
        out = out - F.when(n >= length, 1).otherwise(0)
    return out


def _hashes(table: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """``h`` of every window and mask of ``words``, and its place ``at``, from 0."""
    span = max(map(len, masks))
    placed = table.where(F.size("words") >= span).select(
        "*", F.explode(F.sequence(F.lit(1), F.size("words") - span + 1)).alias("at"))
    each = [F.xxhash64(F.lit(k), *[F.element_at("words", F.col("at") + j)
                                   for j, bit in enumerate(mask) if bit == "1"])
            for k, mask in enumerate(masks)]
    return placed.select("*", F.explode(F.array(*each)).alias("h")) \
        .withColumn("at", F.col("at") - 1)


def overlaps(documents: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS,
             window: int = WINDOW) -> DataFrame:
    """Return ``doc_id, item_id, n_equal, n_words, n_best``: the pairs that overlap.

    A document overlaps an item if, at some shift, a window of 20 words of the item (all of a shorter
    item) has 16 or more equal words in the document (of 16 to 19 words all but 3, from 13 all but 2, from
    9 all but 1, from 6 all). ``n_best`` is the most equal words of such a window, ``n_equal`` the most equal words
    of the whole item at one shift, ``n_words`` the item's length.

    Items of fewer than six words overlap nothing: so short a text is no evidence. Null and empty
    texts overlap nothing. Repeated rows count once, and ties cannot arise: all pairs are returned.
    Other columns are ignored; rows without a doc_id or item_id are left out. If either table is
    empty, so is the result. Texts are read whole, however long.
    """
    texts = picked(documents, doc_id="long", text="string")
    items = settle(
        picked(benchmark, item_id="long", text="string").distinct()
        .select("item_id", words(F.col("text")).alias("item")), "seed-items")
    seeds = settle(_hashes(items.withColumnRenamed("item", "words"), masks)
                   .select("h", "item_id", "at").distinct(), "seed-hashes")
    known = seeds.select("h").distinct()
    if seeds.count() <= BROADCAST_HASHES:
        known = F.broadcast(known)
    places = _hashes(texts.select("doc_id", words(F.col("text")).alias("words")), masks) \
        .select("doc_id", "at", "h")
    shifts = settle(
        places.join(known, "h", "left_semi")
        .join(seeds.withColumnRenamed("at", "item_at"), "h")
        .select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift"))
        .distinct(), "seed-shifts")

    # a shift meets no more of a document than a block of the least power of two words (and as many
    # behind it) that holds the item; so a document's shifts are spread over tasks, and its words
    # are split once
    block_words = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.size("item"), F.lit(LEAST_BLOCK))))) \
        .cast("int")
    placed = shifts.join(items, "item_id").withColumn("block_words", block_words) \
        .withColumn("block", F.expr("greatest(0, shift) div block_words"))
    sizes = placed.select("doc_id", "block_words").distinct()
    blocks = texts.join(sizes.groupBy("doc_id").agg(F.collect_set("block_words").alias("sizes")), "doc_id") \
        .select("doc_id", "sizes", words(F.col("text")).alias("all")) \
        .select("doc_id", F.size("all").alias("n_all"), "all", F.explode("sizes").alias("block_words")) \
        .select("doc_id", "n_all", "block_words", F.posexplode(F.transform(
            F.expr("sequence(0, greatest(0, n_all - 1) div block_words)"),
            lambda k: F.slice("all", k * F.col("block_words") + 1, 2 * F.col("block_words"))))
            .alias("block", "words"))
    pairs = placed.join(blocks.withColumn("block", F.col("block").cast("long")),
                        ["doc_id", "block_words", "block"])
    first = F.greatest(F.lit(0), -F.col("shift"))
    behind = F.least(F.size("item"), F.col("n_all") - F.col("shift"))
    start = F.greatest(F.lit(0), F.col("shift")) - F.col("block") * F.col("block_words")
    width = F.least(F.lit(window), F.size("item"))
    lined_up = pairs.withColumn("first", first).withColumn("n", behind - first) \
        .withColumn("width", width).where("n >= width")
    equal = F.zip_with(F.slice("item", F.col("first") + 1, F.col("n")),
                       F.slice("words", start.cast("int") + 1, F.col("n")),
                       lambda x, y: F.when(x == y, 1).otherwise(0))

    def total(flags: Column) -> Column:
        return F.aggregate(flags, F.lit(0), lambda x, y: x + y)

    def best(flags: Column) -> Column:
        """The equal words of a window that moves along, at most."""
        def moved(state: Column, k: Column) -> Column:
            inside = state["inside"] + F.get(flags, k) - F.coalesce(
                F.get(flags, k - F.col("width")), F.lit(0))
            return F.struct(inside.alias("inside"), F.when(
                k + 1 >= F.col("width"), F.greatest(state["most"], inside)).otherwise(0).alias("most"))

        return F.aggregate(F.sequence(F.lit(0), F.col("n") - 1),
                           F.struct(F.lit(0).alias("inside"), F.lit(0).alias("most")), moved,
                           lambda state: state["most"])

    # the words are compared once: a function's argument is not worked out anew at each use
    measured = F.transform(F.array(equal), lambda flags: F.struct(
        total(flags).alias("n_equal"), best(flags).alias("n_best")))
    return (
        lined_up.select("doc_id", "item_id", F.size("item").alias("n_words"), "width",
                        F.inline(measured))
        .where(F.col("n_best") >= needed(F.col("width")))
        .groupBy("doc_id", "item_id")
        .agg(F.max("n_equal").cast("long").alias("n_equal"),
             F.max("n_words").cast("long").alias("n_words"),
             F.max("n_best").cast("long").alias("n_best"))
    )


def without_overlaps(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that overlap no item, with all their columns; those without a doc_id stay."""
    return without(documents, overlaps(documents, benchmark))
