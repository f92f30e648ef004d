"""Documents packed into as few sequences of a fixed length as can be.

A document longer than a sequence is cut into full pieces and one shorter first piece. What is
left to decide is a bin packing of piece lengths, and lengths are small integers: the whole
instance is a count for each length, however many documents there are. The driver sees these
counts only, decides which *patterns* (lists of lengths that share a sequence) are used how often,
and executors give each piece its pattern, copy and place by its rank among pieces of its length.

Dominance reduction after Martello and Toth: for a piece, a small set that holds it dominates all
other sets that hold it if any of those could be exchanged piece by piece for pieces of the small
set. Such sets are fixed for good; best fit, longest first, packs the remainder.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zlib
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalwatch.llm.common import picked, settle
from signalwatch.llm.tokens import default_tokenizer, encoder

LENGTH = 1024
Patterns = list[tuple[tuple[int, ...], int]]  # lengths that share a sequence, how many times


def reduce_by_dominance(counts: Counter, size: int) -> tuple[Patterns, Counter]:
    """Fix sets of at most three pieces that dominate; return them and the pieces left."""
    left = Counter({w: n for w, n in counts.items() if n})
    fixed: Patterns = []
    for w in sorted(left, reverse=True):
        while left[w]:
            found = _dominating(w, left, size)
            if found is None:
                break
            taken = Counter(found)
            # with all but ``times`` taken the same set still dominates: the kinds left only shrink
            # when one of its own lengths runs out
            times = min(left[x] // k for x, k in taken.items())
            for x, k in taken.items():
                left[x] -= k * times
            left += Counter()  # lengths that ran out go
            fixed.append((found, times))
    return fixed, left


def _dominating(w: int, left: Counter, size: int) -> tuple[int, ...] | None:
    """A set with ``w`` that dominates all others that hold ``w``, of at most three pieces."""
    rest = left - Counter([w])
    room = size - w
    kinds = sorted(rest)
    if not kinds or kinds[0] > room:
        return (w,)

    def largest(limit: int, without: int | None = None) -> int | None:
        return next((x for x in reversed(kinds)
                     if x <= limit and rest[x] > (x == without)), None)

    small = []
    for x in kinds:
        small += [x] * min(3 - len(small), rest[x])
        if len(small) == 3:
            break
    one = largest(room)
    if one == room or len(small) < 2 or small[0] + small[1] > room:
        return (w, one)
    if len(small) < 3 or sum(small) > room:
        # at most two more fit: (one, two) dominates if no other pair has a larger second piece
        two = largest(room - one, one)
        if two is not None:
            pair = next((y for y in reversed(kinds)
                         if 2 * y <= room and (largest(room - y, y) or 0) >= y), None)
            if pair is None or pair <= two:
                return (w, one, two)
    return None


def best_fit(counts: Counter, size: int) -> Patterns:
    """Best fit, longest first, for all pieces of a length at once: sequences of the same content
    are one group, and pieces go to the group with the least room that takes them."""
    groups: dict[tuple[int, ...], int] = {}
    by_room: dict[int, list[tuple[int, ...]]] = {}

    def add(pattern: tuple[int, ...], times: int) -> None:
        if pattern not in groups:
            by_room.setdefault(size - sum(pattern), []).append(pattern)
        groups[pattern] = groups.get(pattern, 0) + times

    for w in sorted((w for w, n in counts.items() if n), reverse=True):
        todo = counts[w]
        while todo:
            room = min((r for r, ps in by_room.items() if r >= w and ps), default=None)
            if room is None:
                each = size // w
                if todo >= each:
                    add((w,) * each, todo // each)
                if todo % each:
                    add((w,) * (todo % each), 1)
                break
            pattern = by_room[room][-1]
            times = min(todo, groups[pattern])
            groups[pattern] -= times
            if not groups[pattern]:
                by_room[room].pop()
                del groups[pattern]
            todo -= times
            add(pattern + (w,), times)
    return [(p, n) for p, n in groups.items() if n]


def plan(counts: Counter, size: int = LENGTH) -> Patterns:
    """Patterns that hold each piece once. ``counts``: pieces by length, each 1 to ``size``."""
    fixed, left = reduce_by_dominance(counts, size)
    return fixed + best_fit(left, size)


def _places(patterns: Patterns) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: the first rank of each run of places, and the run's pattern data."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: Counter = Counter()
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for w in pattern:
            runs.setdefault(w, []).append((ranks[w], sequence, offset, times))
            ranks[w] += times
            offset += w
        sequence += times
    return {w: tuple(np.array(c, np.int64) for c in zip(*rows)) for w, rows in runs.items()}


def _cut(tokenizer: str, size: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer)
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.doc_id, encode.encode_all(batch.text)):
                ids = ids.astype("<u4")
                edges = [0, *range(len(ids) % size or size, len(ids) + 1, size)]
                rows += [(doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                         for k, (a, b) in enumerate(zip(edges, edges[1:]))]
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return cut


def pack(documents: DataFrame, size: int = LENGTH, tokenizer: str | None = None) -> DataFrame:
    """Return ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for each piece.

    Null and empty texts have just the end id. Rows that repeat a doc_id are documents of their
    own and all are packed. Other columns are ignored; rows without a doc_id are left out. An
    empty table gives an empty result. Texts are read whole, however long.
    """
    spark = documents.sparkSession
    pieces = settle(
        picked(documents, doc_id="long", text="string")
        .mapInPandas(_cut(tokenizer or default_tokenizer(), size),
                     "doc_id long, piece int, start long, length long, ids_crc32 long")
        # the place a row has in the written table; the place a rank is counted from
        .withColumn("task", F.spark_partition_id())
        .withColumn("row", F.monotonically_increasing_id()), "pack-pieces")
    # rank = pieces of the same length in earlier tasks + earlier ones in the task
    counted = settle(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "pack-counts")
    by_length = Window.partitionBy("length").orderBy("task")
    before = counted.select(
        "length", "task", (F.sum("n").over(by_length) - F.col("n")).alias("before"))
    in_task = Window.partitionBy("length", "task").orderBy("row")
    ranked = (
        pieces.withColumn("nth", F.row_number().over(in_task) - 1)
        .join(before, ["length", "task"])
        .withColumn("rank", F.col("before") + F.col("nth"))
    )
    totals = Counter({r["length"]: r["n"] for r in
                      counted.groupBy("length").agg(F.sum("n").alias("n")).collect()})
    places = spark.sparkContext.broadcast(_places(plan(totals, size)))

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence = np.empty(len(batch), np.int64)
            offset = np.empty(len(batch), np.int64)
            rank = batch["rank"].to_numpy()
            for w, rows in batch.groupby("length").indices.items():
                first, number, place, _ = places.value[w]
                run = np.searchsorted(first, rank[rows], side="right") - 1
                sequence[rows] = number[run] + rank[rows] - first[run]
                offset[rows] = place[run]
            yield batch[["doc_id", "piece", "start", "length", "ids_crc32"]].assign(
                sequence_id=sequence, offset=offset)

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInPandas(
        placed, "doc_id long, piece int, start long, length long, ids_crc32 long,"
                " sequence_id long, offset long")
