"""The best documents for each of a set of items, by term weights, with early stopping.

Documents are indexed where they lie: a task cuts its part of the table into shards, and a shard's
index has for each term of an item an impact list, the documents by falling contribution. Items are
answered by the Best Position Algorithm: every round reads on in all lists of an item, looks each
new document up in the other lists (direct access), and marks its positions there as seen. A list's
best position is the end of its unbroken run of seen positions, mostly further than the last one
read; no unseen document can score above the sum of contributions at the best positions. Reading ends
when that sum is strictly below the score of the last place, so that ties are never lost.

Numbers of documents and words, and of documents by term, are added up over the whole table first.
The tasks' best rows are ranked once more by Spark. No text and no index is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalwatch.llm.common import picked, run_hashes, settle

#: Places in the ranking of an item.
BEST = 20
#: Distinct terms of items that are looked for together; more items are further blocks.
TERMS_TOGETHER = 1_000_000
#: Postings of a shard, and its documents times the terms of the longest item: bounds of memory.
SHARD_POSTINGS = 1_000_000
SHARD_CELLS = 16_000_000
#: Bytes of text that are worked on together; a longer text is alone.
_TOGETHER = 1_000_000
#: Positions read in each list in the first round; each further round reads twice as many.
_FIRST_READ = 64

# Terms are runs of ASCII letters and digits and of everything that is not ASCII.
_INSIDE = np.zeros(256, bool)
_INSIDE[128:] = True
_INSIDE[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True


def _term_hashes(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of rows ``first`` to ``behind``: a hash of each term, and the row it is in, from 0."""
    texts = column.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        behind = max(first + 1, int(np.searchsorted(ends, ends[first] + _TOGETHER, "right")) - 1)
        raw = data[ends[first]:ends[behind]]
        edges = ends[first:behind + 1] - ends[first]
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = _INSIDE[raw]
        cut = np.zeros(len(raw) + 1, bool)  # a term ends where its text does
        cut[edges] = True
        start = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
        end = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
        hashes = run_hashes(raw, start, end, fold=True) if len(start) else np.empty(0, np.uint64)
        yield first, behind, hashes, np.searchsorted(edges, start, "right") - 1
        first = behind


def _item_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, _, hashes, row in _term_hashes(batch.column("text")):
            ids = batch.column("item_id").to_numpy(zero_copy_only=False)[first:][row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(hashes.view(np.int64))], ["item_id", "h"])


class _Items:
    """A block of items: their distinct terms in order of hash, and each item's terms."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values(["item_id", "h"])
        self.known = np.unique(rows["h"].to_numpy().view(np.uint64))
        term = np.searchsorted(self.known, rows["h"].to_numpy().view(np.uint64))
        self.ids, first = np.unique(rows["item_id"].to_numpy(), return_index=True)
        self.terms = np.split(term, first[1:])
        self.times = np.split(rows["times"].to_numpy(np.int64), first[1:])

    def postings(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray,
                                                           np.ndarray]]:
        """For runs of rows: the first one, the rows' numbers of terms, and of each row and known term
        the row (from 0), the term and how often it occurs."""
        n_known = len(self.known)
        for first, behind, hashes, row in _term_hashes(column):
            lengths = np.bincount(row, minlength=behind - first)
            term = np.searchsorted(self.known, hashes)
            found = self.known[np.minimum(term, n_known - 1)] == hashes
            key, tf = np.unique(row[found] * n_known + term[found], return_counts=True)
            yield first, lengths, key // n_known, key % n_known, tf


def _counts(items):
    """A task's number of documents by term; of all that have terms as term -1, of words as -2."""
    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = items.value
        holding = np.zeros(len(block.known), np.int64)
        n_documents = n_words = 0
        for batch in batches:
            for _, lengths, _, term, _ in block.postings(batch.column("text")):
                holding += np.bincount(term, minlength=len(holding))
                n_documents += int(np.count_nonzero(lengths))
                n_words += int(lengths.sum())
        held = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(held, [-1, -2])),
             pa.array(np.append(holding[held], [n_documents, n_words]))], ["term", "n"])

    return counted


def weight(n_documents: int, holding: int) -> int:
    """The weight of a term that ``holding`` of the documents hold."""
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * holding + 1)))


class _Shard:
    """Impact lists of some documents: for each term the documents by falling contribution."""

    def __init__(self, n_terms: int, doc_ids: np.ndarray, doc: np.ndarray, term: np.ndarray,
                 impact: np.ndarray):
        order = np.lexsort((-impact, term))
        self.doc_ids, self.doc, self.impact = doc_ids, doc[order], impact[order]
        self.first = np.searchsorted(term[order], np.arange(n_terms + 1))

    def best(self, terms: np.ndarray, times: np.ndarray, k: int, scores: np.ndarray,
             ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best of this shard and of the given rows, for an item's terms.

        Every round reads the next positions of each list behind its best position.
        """
        first, n = self.first[terms], self.first[terms + 1] - self.first[terms]
        first, n, times = first[n > 0], n[n > 0], times[n > 0]
        if not len(first):
            return scores, ids
        slot = np.cumsum(n) - n  # where a list's positions start among those of all lists
        flat = np.arange(n.sum()) + np.repeat(first - slot, n)
        place = np.full((len(first), len(self.doc_ids)), -1, np.int32)
        place[np.repeat(np.arange(len(first)), n), self.doc[flat]] = flat - np.repeat(first, n)
        seen = np.zeros(len(flat), bool)
        scored = np.zeros(len(self.doc_ids), bool)
        best = np.zeros(len(first), np.int64)  # positions seen without a gap
        read = _FIRST_READ
        while True:
            behind = np.minimum(best + read, n)
            many = behind - best
            at = np.arange(many.sum()) + np.repeat(first + best - (np.cumsum(many) - many), many)
            new = np.unique(self.doc[at])
            new = new[~scored[new]]
            scored[new] = True
            # direct accesses: all positions of the new documents, in all lists
            there = place[:, new]
            which, column = np.nonzero(there >= 0)
            position = there[which, column]
            seen[slot[which] + position] = True
            each = np.zeros(there.shape, np.int64)
            each[which, column] = self.impact[first[which] + position] * times[which]
            total = each.sum(axis=0)
            least = scores[k - 1] if len(scores) >= k else 1
            scores = np.concatenate([scores, total[total >= least]])
            ids = np.concatenate([ids, self.doc_ids[new[total >= least]]])
            order = np.lexsort((ids, -scores))[:k]
            scores, ids = scores[order], ids[order]
            gaps = np.append(np.flatnonzero(~seen), len(seen))
            best = np.minimum(gaps[np.searchsorted(gaps, slot + best)] - slot, n)
            open_ = best < n
            bound = (self.impact[first + best - 1] * times)[open_].sum()
            if bound < (scores[k - 1] if len(scores) >= k else 1):
                return scores, ids
            read *= 2


def _searched(items, weights, n_documents: int, n_words: int, k: int, shard_postings: int):
    """A task's ``k`` best documents of each item."""
    def searched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weight_of = items.value, weights.value
        longest = max(map(len, block.terms))
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(block.ids)
        waiting: list[tuple] = []
        held = n_docs = 0

        def finish() -> None:
            ids, doc, term, impact = map(np.concatenate, zip(*waiting))
            shard = _Shard(len(block.known), ids, doc, term, impact)
            for i, (terms, times) in enumerate(zip(block.terms, block.times)):
                found[i] = shard.best(terms, times, k, *found[i])

        for batch in batches:
            doc_ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for first, lengths, row, term, tf in block.postings(batch.column("text")):
                m = 100 - 25 + (25 * lengths * n_documents) // max(n_words, 1)
                impact = weight_of[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[row]))
                term, tf, row, impact = (x[impact > 0] for x in (term, tf, row, impact))
                held_rows, doc = np.unique(row, return_inverse=True)
                waiting.append((doc_ids[first + held_rows], doc + n_docs, term, impact))
                held, n_docs = held + len(row), n_docs + len(held_rows)
                if held >= shard_postings or n_docs * longest >= SHARD_CELLS:
                    finish()
                    waiting, held, n_docs = [], 0, 0
        if waiting:
            finish()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(block.ids, [len(s) for s, _ in found])),
             pa.array(np.concatenate([i for _, i in found])),
             pa.array(np.concatenate([s for s, _ in found]))], ["item_id", "doc_id", "score"])

    return searched


def search(documents: DataFrame, items: DataFrame, k: int = BEST,
           terms_together: int = TERMS_TOGETHER, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """Return ``item_id, rank, doc_id, score``: each item's ``k`` documents of the highest score above 0.

    Terms are runs of ASCII letters (A-Z as a-z), digits and characters outside ASCII. A document's
    score is the sum over an item's terms, repeats included, of ``weight`` times a fraction that grows
    with the term's occurrences and falls with the document's length. Equal scores rank by doc_id.

    Null and empty texts have no term: such documents count nowhere, such items have no rows. Rows
    that repeat a doc_id are documents of their own, with a rank each. Equal rows of items count once;
    the texts of other rows with one item_id are taken together. Other columns are ignored; rows
    without a doc_id or item_id are left out. If either table is empty, so is the result. Texts are read
    whole, however long. Terms are compared by a 64-bit hash: that any of n different terms is taken for
    one of q terms of items has a chance of n * q / 2 ** 64.
    """
    spark = documents.sparkSession
    texts = picked(documents, doc_id="long", text="string")
    terms = settle(
        picked(items, item_id="long", text="string").distinct()
        .mapInArrow(_item_terms, "item_id long, h long")
        .groupBy("item_id", "h").agg(F.count("*").alias("times")), "search-terms")
    blocks = -(-terms.count() // terms_together)
    parts = []
    for number in range(blocks):
        # a block is bounded by terms_together, but for chance and single longer items
        block = _Items(terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number).toPandas())
        if not len(block.ids):
            continue
        sent = spark.sparkContext.broadcast(block)
        counts = {r["term"]: r["n"] for r in
                  texts.mapInArrow(_counts(sent), "term long, n long")
                  .groupBy("term").agg(F.sum("n").alias("n")).collect()}
        n_documents, n_words = counts.get(-1, 0), counts.get(-2, 0)
        weights = spark.sparkContext.broadcast(np.array(
            [weight(n_documents, counts.get(t, 0)) for t in range(len(block.known))], np.int64))
        parts.append(settle(
            texts.mapInArrow(_searched(sent, weights, n_documents, n_words, k, shard_postings),
                             "item_id long, doc_id long, score long"), f"search-{number}"))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = parts[0]
    for part in parts[1:]:
        best = best.union(part)
    order = (F.desc("score"), F.asc("doc_id"))
    # first in parts of an item's rows, so that no task gets those of all tasks
    some = Window.partitionBy("item_id", F.pmod(F.xxhash64("doc_id"), F.lit(64))).orderBy(*order)
    best = best.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
    ranked = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    return best.withColumn("rank", ranked).where(F.col("rank") <= k) \
        .select("item_id", "rank", "doc_id", "score")
