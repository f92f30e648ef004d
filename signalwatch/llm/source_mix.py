"""Sources mixed to target weights, as exact quotas of blocks for each output shard.

A source is a line of words, its documents one after the other in a random order; it is cut into
blocks of equally many words. A target in words is a quota of blocks, with whole repeats of the
source where it is more than that. Quotas are dealt to shards by a splitting tree: at each node, the
blocks of the left half are drawn without replacement from those of the node, source by source, by
the multivariate hypergeometric distribution, and the right half gets the others. So each shard has
its exact size, each source its exact quota, and a shard's contents are distributed as in one great
shuffle of all blocks, though no block has been moved. A shard's blocks of a source are a run of
places in a pseudo-random permutation, so shards' blocks are disjoint; within a shard they are
shuffled.

All steps are DataFrame operations. Texts are read once, to count their words, and not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalwatch.llm.common import picked, settle

#: Weights of sources, in order of their names, again from the start when they run out.
WEIGHTS = (1, 2, 3)
#: How often a source may be read at most.
MOST_REPEATS = 3
#: Words of a block, and blocks that a source has at least (if it has as many words), so that quotas
#: can come near the targets of small sources too.
BLOCK_WORDS, LEAST_BLOCKS = 2048, 1000
#: Blocks of an output shard.
SHARD_BLOCKS = 4096
#: Documents of a source that are put in order together, and such bins that are added up together.
BIN_DOCUMENTS, BINS_TOGETHER = 64, 128
#: Rounds of the permutation.
ROUNDS = 40
#: Levels of the splitting tree that are one job.
LEVELS_TOGETHER = 3
_SPACE = "[\\x20\\x09-\\x0D]+"


def n_words(text: Column) -> Column:
    """Words, separated by ASCII white space."""
    parts = F.split(F.coalesce(text, F.lit("")), _SPACE)
    n = F.size(parts)
    return (n - F.when(F.element_at(parts, 1) == "", 1).otherwise(0)
            - F.when((n > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
            most_repeats: int = MOST_REPEATS) -> DataFrame:
    """Add ``source_no, target`` to ``sizes`` (``source``, ``source_size``; one row for each source).

    Sources, in order of code points and null last, share the sum of all sizes by weight. No target is
    above ``most_repeats`` times its source's size; what is above goes to the others by weight, until
    none is. That is one level for all: a target is the level times the weight, or the source's bound
    where that is less. With sources by rising bound for a unit of weight, the level is known from sums.
    """
    ordered = Window.orderBy(F.col("source").isNull(), "source")
    nth = F.row_number().over(ordered) - 1
    each = F.array(*map(F.lit, weights))
    bounded = sizes.withColumn("source_no", nth.cast("long")) \
        .withColumn("weight", F.element_at(each, (F.col("source_no") % len(weights) + 1).cast("int"))) \
        .withColumn("bound", most_repeats * F.col("source_size"))
    rising = Window.orderBy(F.col("bound") / F.col("weight"), "source_no")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    at_bound = F.coalesce(F.sum("bound").over(before), F.lit(0))
    others = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = (F.sum("source_size").over(everything) - at_bound) / others
    # the level if all sources before this one stop at their bounds; it holds for the first one that
    # need not stop as well, and later ones have lower levels
    fits = F.when(F.col("level") * F.col("weight") <= F.col("bound"), F.col("level"))
    return bounded.withColumn("level", level).withColumn("fits", fits) \
        .withColumn("level", F.max("fits").over(everything)) \
        .withColumn("target", F.least(F.col("level") * F.col("weight"), F.col("bound").cast("double"))) \
        .select("source", "source_no", "source_size", "target")


def _uniform(*parts: Column | int) -> Column:
    """A number from 0 to below 1 that follows from ``parts``."""
    key = F.xxhash64(*[F.lit(p) if isinstance(p, int) else p for p in parts])
    return F.shiftrightunsigned(key, 11) / F.lit(float(1 << 53))


def hypergeometric(n: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``n`` blocks, ``marked`` of them of one source, are so among ``drawn`` ones.

    Probabilities are taken as parts of the mode's, outwards from it as far as they are above 1e-17;
    the result is where their sum from below passes ``u`` of the whole. ``n``, ``marked`` and
    ``drawn`` are long columns, ``u`` a number from 0 to below 1.
    """
    low = F.greatest(F.lit(0).cast("long"), drawn + marked - n)
    high = F.least(marked, drawn)
    mode = F.least(high, F.greatest(low, F.floor(
        (drawn + 1).cast("double") * (marked + 1) / (n + 2))))
    # more than nine standard deviations
    far = (9 * F.sqrt(high.cast("double")) + 40).cast("long")
    top, bottom = F.least(high, mode + far), F.greatest(low, mode - far)
    none = F.array().cast("array<bigint>")

    def ratio(k: Column) -> Column:  # the probability of k over that of k - 1
        return (marked - k + 1).cast("double") * (drawn - k + 1) / (k * (n - marked - drawn + k))

    def state(**parts: Column) -> Column:
        return F.struct(*[part.alias(name) for name, part in parts.items()])

    def summed(ks: Column, factor) -> Column:
        """The last of the running products from 1, and the sum of them without the 1."""
        return F.aggregate(ks, state(p=F.lit(1.0), sum=F.lit(0.0)), lambda s, k: state(
            p=s["p"] * factor(k), sum=s["sum"] + s["p"] * factor(k)))

    above = summed(F.when(top > mode, F.sequence(mode + 1, top)).otherwise(none), ratio)
    below = summed(F.when(mode > bottom, F.sequence(mode, bottom + 1, F.lit(-1).cast("long")))
                   .otherwise(none), lambda k: 1 / ratio(k))
    start = state(p=below["p"], sum=below["p"], at=bottom,
                  goal=u * (1 + above["sum"] + below["sum"]))
    found = F.aggregate(
        F.when(top > bottom, F.sequence(bottom + 1, top)).otherwise(none), start,
        lambda s, k: state(p=s["p"] * ratio(k), sum=s["sum"] + s["p"] * ratio(k),
                           at=F.when(s["sum"] <= s["goal"], k).otherwise(s["at"]), goal=s["goal"]),
        lambda s: s["at"])
    return F.when(low >= high, low).otherwise(found)


def _halves(nodes: DataFrame, blocks: int, shards: int, seed: int) -> DataFrame:
    """Each node of several shards as two; ``quotas`` (``no, first, n``) are shared out.

    The first ``k`` shards have ``blocks * k div shards`` blocks.
    """
    wanted = F.expr(f"{blocks}L * (shard + half) div {shards} - {blocks}L * shard div {shards}")
    total = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, q: a + q["n"])
    # source by source: blocks left to draw, blocks they are drawn from, what was drawn
    start = F.struct(F.col("wanted").alias("draws"), F.col("total").alias("pool"),
                     F.array().cast("array<bigint>").alias("taken"))

    def draw(state: Column, q: Column) -> Column:
        taken = hypergeometric(state["pool"], q["n"], state["draws"],
                               _uniform(seed, F.col("shard"), F.col("n_shards"), q["no"]))
        return F.struct((state["draws"] - taken).alias("draws"),
                        (state["pool"] - q["n"]).alias("pool"),
                        F.concat(state["taken"], F.array(taken)).alias("taken"))

    def side(first, n) -> Column:
        both = F.zip_with("quotas", "taken", lambda q, t: F.struct(
            q["no"].alias("no"), first(q, t).alias("first"), n(q, t).alias("n")))
        return F.filter(both, lambda q: q["n"] > 0)

    halved = nodes.where("n_shards > 1").withColumn("half", F.expr("n_shards div 2")) \
        .withColumn("wanted", wanted) \
        .withColumn("total", total) \
        .withColumn("taken", F.aggregate("quotas", start, draw, lambda s: s["taken"]))
    left = F.struct(F.col("shard").alias("shard"), F.col("half").alias("n_shards"),
                    side(lambda q, t: q["first"], lambda q, t: t).alias("quotas"))
    right = F.struct((F.col("shard") + F.col("half")).alias("shard"),
                     (F.col("n_shards") - F.col("half")).alias("n_shards"),
                     side(lambda q, t: q["first"] + t, lambda q, t: q["n"] - t).alias("quotas"))
    return halved.select(F.inline(F.array(left, right))).union(nodes.where("n_shards = 1"))


def split_quotas(quotas: DataFrame, shard_blocks: int = SHARD_BLOCKS, seed: int = 0) -> DataFrame:
    """Return ``shard, source_no, first, n``: places ``first`` to ``first + n - 1`` of a source's
    ``quota`` (``quotas``: ``source_no, quota``) go to the shard. Shards differ by one block at most.

    A node of the tree is a row that lists its sources; sources are as few as their names in a
    configuration, and deep nodes hold just those that they have blocks of.
    """
    root = quotas.where("quota > 0").agg(
        F.sum("quota").alias("blocks"),
        F.sort_array(F.collect_list(F.struct(
            F.col("source_no").alias("no"), F.lit(0).cast("long").alias("first"),
            F.col("quota").alias("n")))).alias("quotas"))
    root = settle(root.withColumn("shards", F.ceil(F.col("blocks") / shard_blocks)), "mix-root")
    row = root.select("blocks", "shards").first()
    blocks, shards = row["blocks"] or 0, row["shards"] or 0
    nodes = root.where("blocks > 0").select(
        F.lit(0).cast("long").alias("shard"), F.col("shards").alias("n_shards"), "quotas")
    for level in range(max(shards - 1, 0).bit_length()):
        nodes = _halves(nodes, blocks, shards, seed)
        if level % LEVELS_TOGETHER == LEVELS_TOGETHER - 1:
            nodes = settle(nodes, f"mix-tree-{level}")
    return nodes.select("shard", F.explode("quotas").alias("q")) \
        .select("shard", F.col("q.no").alias("source_no"), F.col("q.first").alias("first"),
                F.col("q.n").alias("n"))


def permuted(at: Column, n: Column, key: Column) -> Column:
    """Where a random permutation of 0 to ``n - 1`` puts ``at``; ``key`` chooses the permutation.

    Each round pairs every number with another, ``shift - x``, and swaps some pairs as a hash of the
    pair decides ("swap or not"); a round is its own inverse, so the whole is one to one for any ``n``.
    """
    def round_(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(key, r), n) + n - x, n)
        swap = F.pmod(F.xxhash64(key, r, F.greatest(x, other)), F.lit(2)) == 1
        return F.when(swap, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), at, round_)


def lined_up(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS,
             most_repeats: int = MOST_REPEATS, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """The documents and sources, written.

    Documents: ``doc_id, size, source_no, first``; ``first`` is the number of a source's words before
    the document, in random order. Sources: ``source, source_no, source_size, target, block_words,
    n_blocks, quota``.
    """
    sized = settle(picked(documents, doc_id="long", text="string", source="string")
                   .select("doc_id", "source", n_words(F.col("text")).alias("size")), "mix-sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"),
                                         F.count("*").alias("n_documents"))
    least = F.greatest(F.lit(1), F.floor(F.col("source_size") / LEAST_BLOCKS))
    sources = targets(totals.select("source", "source_size"), weights, most_repeats) \
        .join(totals.select(F.col("source").alias("name"), "n_documents"),
              F.col("source").eqNullSafe(F.col("name"))).drop("name") \
        .withColumn("block_words", F.least(F.lit(BLOCK_WORDS), least)) \
        .withColumn("n_blocks", F.ceil(F.col("source_size") / F.col("block_words"))) \
        .withColumn("quota", F.when(F.col("source_size") > 0, F.least(
            most_repeats * F.col("n_blocks"),
            F.round(F.col("target") * F.col("n_blocks") / F.col("source_size")).cast("long")))
            .otherwise(0)) \
        .withColumn("n_bins", F.ceil(F.col("n_documents") / BIN_DOCUMENTS))
    sources = settle(sources, "mix-sources")
    # words before a document: those of earlier bins of its source, and of earlier ones in its bin;
    # bins are added up in two steps, so that no task has all bins of a source
    binned = sized.join(sources.select(F.col("source").alias("name"), "source_no", "n_bins"),
                        F.col("source").eqNullSafe(F.col("name"))) \
        .withColumn("h", F.xxhash64(F.lit(seed), "doc_id")) \
        .select("doc_id", "size", "source_no", "h", F.pmod("h", "n_bins").alias("bin"))
    bins = binned.groupBy("source_no", "bin").agg(F.sum("size").alias("n")) \
        .withColumn("group", F.expr(f"bin div {BINS_TOGETHER}"))
    groups = bins.groupBy("source_no", "group").agg(F.sum("n").alias("n"))
    before_group = groups.select("source_no", "group", (F.sum("n").over(
        Window.partitionBy("source_no").orderBy("group")) - F.col("n")).alias("before_group"))
    in_group = F.sum("n").over(Window.partitionBy("source_no", "group").orderBy("bin")) - F.col("n")
    before = bins.withColumn("in_group", in_group).join(before_group, ["source_no", "group"]) \
        .select("source_no", "bin", (F.col("before_group") + F.col("in_group")).alias("before"))
    running = Window.partitionBy("source_no", "bin").orderBy("h", "doc_id", "size") \
        .rowsBetween(Window.unboundedPreceding, 0)
    placed = binned.withColumn("behind", F.sum("size").over(running)) \
        .join(before, ["source_no", "bin"]) \
        .select("doc_id", "size", "source_no",
                (F.col("before") + F.col("behind") - F.col("size")).alias("first"))
    return settle(placed, "mix-documents"), sources


def mix(placed: DataFrame, sources: DataFrame, shard_blocks: int = SHARD_BLOCKS,
        seed: int = 0) -> DataFrame:
    """Return the mix of ``lined_up`` documents: ``shard, place, source_no, doc_id, first, start,
    n_words, epoch``.

    Each row is a span of a document, ``n_words`` words from its word ``start`` on (from 0); ``place``
    numbers a shard's spans from 0. Blocks are shuffled within a shard and keep their documents
    in order. ``epoch`` tells repeats apart; ``first`` with ``source_no`` tells documents apart. A last
    block of a source may be shorter than the others.
    """
    shape = sources.select("source_no", "n_blocks", "block_words")
    drawn = split_quotas(sources.select("source_no", "quota"), shard_blocks, seed) \
        .withColumn("nth", F.explode(F.expr("sequence(first, first + n - 1)"))) \
        .join(shape, "source_no")
    epoch = F.expr("nth div n_blocks")
    drawn = drawn.select(
        "shard", "source_no", epoch.alias("epoch"),
        permuted(F.col("nth") % F.col("n_blocks"), F.col("n_blocks"),
                 F.xxhash64(F.lit(seed), "source_no", epoch)).alias("block"))
    spread = placed.where("size > 0").join(shape, "source_no") \
        .withColumn("block", F.explode(F.expr(
            "sequence(first div block_words, (first + size - 1) div block_words)"))) \
        .withColumn("start", F.greatest(F.lit(0), F.expr("block * block_words - first"))) \
        .withColumn("end", F.least("size", F.expr("(block + 1) * block_words - first"))) \
        .select("source_no", "block", "doc_id", "first", "start",
                (F.col("end") - F.col("start")).alias("n_words"))
    shuffled = Window.partitionBy("shard").orderBy(
        F.xxhash64(F.lit(seed), "shard", "source_no", "epoch", "block"), "source_no", "epoch", "block",
        "first")
    return drawn.join(spread, ["source_no", "block"]).select(
        "shard", (F.row_number().over(shuffled) - 1).alias("place"), "source_no", "doc_id", "first",
        "start", "n_words", "epoch")


def taken(documents: DataFrame) -> DataFrame:
    """Return ``doc_id, size, source_size, target, taken`` for each document: how many of its words
    the mix takes, repeats counted.

    Null and empty texts have size 0, and none is taken; a null source is one of its own, the last. Rows
    that repeat a doc_id are documents of their own. Sources without words have target 0. Other
    columns are ignored; rows without a doc_id are left out. An empty table gives an empty result.
    Texts are read whole, however long. Reruns agree, however the table is partitioned.
    """
    placed, sources = lined_up(documents)
    spans = settle(mix(placed, sources), "mix-spans")
    words = spans.groupBy("source_no", "first").agg(F.sum("n_words").alias("taken"))
    # documents without words share their place with others, and are in no span
    read = placed.where("size > 0").join(words, ["source_no", "first"], "left") \
        .select("doc_id", "size", "source_no", F.coalesce("taken", F.lit(0)).alias("taken"))
    empty = placed.where("size = 0").select("doc_id", "size", "source_no", F.lit(0).alias("taken"))
    return read.union(empty) \
        .join(sources.select("source_no", "source_size", "target"), "source_no") \
        .select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))
