"""What filters take from a corpus alone, together, and in every order.

A document's verdicts are a mask of five bits. Four follow from its text; the fifth, whether an
earlier document has the same text, comes from compressed (radix) tries. Each task first puts its
texts in a local trie, so that of any number of copies one text a task goes on. These texts are
partitioned by ranges of prefixes; a prefix whose texts are too many for one task is made longer until
they are not, however many texts begin alike. Each partition's trie then holds whole texts, with the
smallest id at the node where a text ends. Ids go back to the local texts, never to a text's copies,
and masks are reduced to counts. Orders of filters are worked out on these counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from zlib import crc32

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalwatch.llm.common import picked, settle

#: The filters' letters; filter number i is bit 2 ** i of a mask.
FILTERS = "ABCDE"
#: Bytes of texts that begin alike and may be in one task, if that is not over twice an average partition.
PREFIX_BYTES = 16 << 20
#: Code points of the first prefix; each further one is LONGER times as long.
FIRST_PREFIX, LONGER = 8, 4
#: Bytes of texts in a task's local trie; beyond it, a new one is begun.
LOCAL_BYTES = 64 << 20
#: Bytes of too common prefixes that are broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 8 << 20
_ROWS, _BYTES = 20_000, 8 << 20  # of a frame that a task passes on

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_SPECIAL = b"#$%&*|"


def mask_of(text: str) -> int:
    """The bits of A to D: which filters that look at a text alone it fails."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # at ASCII white space
    few = len(words) < 100
    same = 100 * len(set(words)) < 80 * len(words)
    loud = 100 * (len(raw) - len(raw.translate(None, _UPPER))) > 10 * len(text)
    special = len(raw.translate(None, _SPECIAL)) < len(raw)
    return few | same << 1 | loud << 2 | special << 3


def _agree(a: str, at: int, b: str) -> int:
    """How many characters ``a`` from ``at`` on and ``b`` have in common at their start."""
    low, high = 0, min(len(a) - at, len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[at + low:at + middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """A compressed trie of whole texts. A node is [label, children by first character, number of the
    text that ends here or -1]; ``least`` holds each text's smallest id."""

    def __init__(self) -> None:
        self._root: list = ["", {}, -1]
        self.least: list[int] = []
        self.held = 0  # characters of distinct texts

    def add(self, text: str, doc_id: int) -> int:
        """Insert a text and return its number, from 0."""
        node, at = self._root, 0
        while at < len(text):
            child = node[1].get(text[at])
            if child is None:
                child = [text[at:], {}, -1]
                node[1][text[at]] = child
                node, at = child, len(text)
                break
            if not text.startswith(child[0], at):  # the ways part inside the label
                n = _agree(text, at, child[0])
                upper = [child[0][:n], {child[0][n]: child}, -1]
                child[0] = child[0][n:]
                node[1][text[at]] = upper
                child = upper
            node, at = child, at + len(child[0])
        if node[2] < 0:
            node[2] = len(self.least)
            self.least.append(doc_id)
            self.held += len(text)
        elif doc_id < self.least[node[2]]:
            self.least[node[2]] = doc_id
        return node[2]

    def texts(self) -> Iterator[tuple[int, str]]:
        """All texts with their numbers, by a walk through the trie."""
        path: list[str] = []
        todo: list[tuple[int, list]] = [(0, self._root)]
        while todo:
            depth, node = todo.pop()
            path[depth:] = [node[0]]
            if node[2] >= 0:
                yield node[2], "".join(path)
            todo += [(depth + 1, child) for child in node[1].values()]


_LOCAL = ("doc_id long, part string, mask int, task int, local long, head string, n_bytes long, "
          "mark long, text string")


def _locally(local_bytes: int):
    """For each document a row without text: its verdicts on the text and the text's number in this
    task. For each of the task's distinct texts a row with it and the smallest id there."""
    names = [x.split()[0] for x in _LOCAL.split(", ")]

    def texts(trie: Trie, masks: list[int], task: int, begun: int) -> Iterator[pd.DataFrame]:
        rows, size = [], 0
        for number, text in trie.texts():
            raw = text.encode("utf-8", "surrogatepass")
            rows.append((trie.least[number], None, masks[number], task, begun + number,
                         text[:FIRST_PREFIX], len(raw), crc32(raw), text))
            size += len(raw)
            if size >= _BYTES or len(rows) >= _ROWS:
                yield pd.DataFrame(rows, columns=names)
                rows, size = [], 0
        yield pd.DataFrame(rows, columns=names)

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        trie, masks, begun = Trie(), [], 0
        for batch in batches:
            rows = []
            for doc_id, text, part in zip(batch["doc_id"], batch["text"], batch["part"]):
                number = trie.add(text, doc_id)
                if number == len(masks):
                    masks.append(mask_of(text))
                rows.append((doc_id, part, masks[number], task, begun + number,
                             None, None, None, None))
                if trie.held >= local_bytes:
                    yield from texts(trie, masks, task, begun)
                    begun += len(masks)
                    trie, masks = Trie(), []
            yield pd.DataFrame(rows, columns=names).astype({"n_bytes": "Int64", "mark": "Int64"})
        yield from texts(trie, masks, task, begun)

    return judged


def _with_prefixes(texts: DataFrame, prefix_bytes: int) -> DataFrame:
    """``texts`` with ``prefix``: the shortest of 8, 32, 128, ... characters (or the whole text) that
    begins texts of not more than ``prefix_bytes``, or just one text."""
    length = FIRST_PREFIX
    out = texts.withColumn("prefix", F.col("head"))
    left = out
    while True:
        # copies of one text, by its mark, cannot be told apart by a longer prefix
        common = settle(
            left.groupBy("prefix").agg(F.sum("n_bytes").alias("size"),
                                       (F.min("mark") < F.max("mark")).alias("differ"))
            .where((F.col("size") > prefix_bytes) & F.col("differ"))
            .select(F.col("prefix").alias("common")), f"audit-prefixes-{length}")
        size = common.agg(F.sum(F.octet_length("common") + 16)).first()[0]
        if size is None:
            return out
        if size <= BROADCAST_BYTES:
            common = F.broadcast(common)
        length *= LONGER
        longer = F.substring("text", 1, length)
        left = out.join(common, F.col("prefix") == F.col("common"), "left_semi") \
            .withColumn("prefix", longer)
        out = out.join(common, F.col("prefix") == F.col("common"), "left") \
            .withColumn("prefix", F.when(F.col("common").isNotNull(), longer)
                        .otherwise(F.col("prefix"))).drop("common")


def _least_ids(prefix_bytes: int):
    """The smallest id of each local text's text in the whole table, from a trie of each run of
    prefixes; rows come in order of prefix."""
    def finished(trie: Trie, found: list[tuple[int, int, int]]) -> pd.DataFrame:
        out = pd.DataFrame(found, columns=["task", "local", "number"])
        return out.assign(least=[trie.least[n] for n in out["number"]])[["task", "local", "least"]]

    def looked_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie, found, last = Trie(), [], None
        for batch in batches:
            for task, local, doc_id, prefix, text in batch[
                    ["task", "local", "doc_id", "prefix", "text"]].itertuples(index=False, name=None):
                if prefix != last and trie.held >= prefix_bytes:  # texts of other prefixes differ
                    yield finished(trie, found)
                    trie, found = Trie(), []
                last = prefix
                found.append((task, local, trie.add(text, doc_id)))
        yield finished(trie, found)

    return looked_up


def masks(documents: DataFrame, prefix_bytes: int = PREFIX_BYTES,
          local_bytes: int = LOCAL_BYTES) -> DataFrame:
    """Return ``doc_id, part, mask``: for each document which of the five filters it fails.

    A: under 100 words; B: fewer distinct words than 80 %; C: more than 10 % of characters are A-Z; D:
    holds one of ``#$%&*|``; E: the text of a document with a smaller doc_id is identical. Words are
    separated by ASCII white space and compared exactly. ``part`` is the language.

    Null texts are empty, so all null and empty texts are identical; a null language is the empty string. Rows
    that repeat a doc_id are documents of their own, none of them earlier than the others. Other
    columns are ignored; rows without a doc_id are left out. An empty table gives an empty result.
    Texts are read and compared whole, however long.
    """
    spark = documents.sparkSession
    texts = picked(documents, doc_id="long", text="string", lang="string").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("lang", F.lit("")).alias("part"))
    local = settle(texts.mapInPandas(_locally(local_bytes), _LOCAL), "audit-local")
    distinct = local.where(F.col("text").isNotNull()) \
        .select("doc_id", "task", "local", "head", "n_bytes", "mark", "text")
    n_bytes = distinct.agg(F.sum("n_bytes")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // prefix_bytes))
    prefix_bytes = min(prefix_bytes, 2 * n_bytes // parts + 1)
    least = (
        _with_prefixes(distinct, prefix_bytes).select("task", "local", "doc_id", "prefix", "text")
        .repartitionByRange(parts, "prefix").sortWithinPartitions("prefix")
        .mapInPandas(_least_ids(prefix_bytes), "task int, local long, least long")
    )
    return local.where(F.col("text").isNull()).join(least, ["task", "local"]).select(
        "doc_id", "part",
        (F.col("mask") + F.when(F.col("doc_id") > F.col("least"), 16).otherwise(0)).alias("mask"))


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Return one row for each part, order of the filters and step, zeros included: ``part,
    filter_order, step`` and the counts ``kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley``; ``masks`` says what the filters are.

    ``kept`` documents are left after the step, ``removed`` ones go in it, ``redundant`` ones fail its filter and
    were removed before, ``unique_fails`` fail its filter alone. ``good_lost`` and ``toxic_lost`` are removed
    ones labelled quality 1 and toxic 1. ``shapley`` adds up what a filter removes over all orders.

    A document with several rows of labels has a label if one of them says so; null labels and labels
    of other documents say nothing. All further cases are as in ``masks``; an empty table has no parts.
    """
    known = picked(labels, doc_id="long", quality="int", toxic="int").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))

    def number(flag: Column) -> Column:
        return F.sum(F.when(flag, 1).otherwise(0)).cast("long")

    counts = masks(documents).join(known, "doc_id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"), number(F.col("good")).alias("n_good"),
        number(F.col("toxic")).alias("n_toxic"))
    orders = ["".join(p) for p in permutations(FILTERS)]
    failed = F.concat_ws("", *[F.when(F.col("mask").bitwiseAND(1 << bit) > 0, letter)
                               for bit, letter in enumerate(FILTERS)])
    steps = counts.withColumn("failed", failed) \
        .withColumn("filter_order", F.explode(F.array(*map(F.lit, orders)))) \
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))) \
        .withColumn("fails", F.expr("instr(failed, substring(filter_order, step, 1)) > 0")) \
        .withColumn("gone", F.expr("length(translate(substring(filter_order, 1, step - 1), failed, ''))"
                                   " < step - 1"))
    removed = F.col("fails") & ~F.col("gone")
    n_fails = F.greatest(F.length("failed"), F.lit(1))

    def total(flag: Column, what: str = "n") -> Column:
        return F.sum(F.when(flag, F.col(what)).otherwise(0)).cast("long")

    return steps.groupBy("part", "filter_order", "step").agg(
        total(~F.col("fails") & ~F.col("gone")).alias("kept"),
        total(removed).alias("removed"),
        total(F.col("fails") & F.col("gone")).alias("redundant"),
        total(F.col("fails") & (F.length("failed") == 1)).alias("unique_fails"),
        total(removed, "n_good").alias("good_lost"),
        total(removed, "n_toxic").alias("toxic_lost"),
        # each of the filters that a document fails is the first of them in as many orders
        F.sum(F.when(F.col("fails"), F.col("n") * F.floor(F.lit(len(orders)) / n_fails)).otherwise(0))
        .cast("long").alias("shapley"))
