"""What several operators share: stored steps, hashing, connected components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalwatch.storage import fresh_path, settle

__all__ = ["BASE", "as_rows", "components", "fresh_path", "mixed", "picked", "read_table", "run_hashes",
           "settle", "without", "word_hashes", "word_spans"]


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def picked(table: DataFrame, **columns: str) -> DataFrame:
    """Just the columns an operator reads, cast; other columns cannot clash with its own.

    ``columns`` maps a column's name to its type. Rows whose first column (the key) is null
    name no document and are left out.
    """
    chosen = table.select(*[F.col(f"`{name}`").cast(kind).alias(name)
                            for name, kind in columns.items()])
    return chosen.where(F.col(next(iter(columns))).isNotNull())


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each input bit reaches all output bits."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def without(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose doc_id is not in ``ids`` (``doc_id``), with all their columns, whatever
    these are called. Documents without a doc_id stay."""
    gone = ids.select(F.col("doc_id").alias("gone")).distinct()
    return as_rows(documents).join(gone, F.col("row.doc_id").cast("long") == F.col("gone"),
                                   "left_anti").select("row.*")


def as_rows(table: DataFrame) -> DataFrame:
    """All columns as one, ``row``, so that their names cannot clash with others."""
    return table.select(F.struct(*[F.col(f"`{c}`") for c in table.columns]).alias("row"))


#: Multiplier of hashes; odd, so it has an inverse modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A random number for each byte, and the same with A-Z as a-z.
_EXACT = np.random.default_rng(20240601).integers(0, 2**63, 256, np.uint64)
_FOLDED = _EXACT[np.frombuffer(bytes(range(256)).lower(), np.uint8)]
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, long enough for a text of ``n`` bytes."""
    if _powers and len(_powers[0]) >= n:
        return _powers
    n = max(n, 1 << 16)
    tables = []
    for base in (BASE, pow(BASE, -1, 2**64)):
        table = np.full(n, base, np.uint64)
        table[0] = 1
        tables.append(np.cumprod(table))
    if n <= 1 << 21:  # one very long text should not hold memory afterwards
        _powers[:] = tables
    return tables


def word_spans(raw: np.ndarray, fold: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of a text's UTF-8 bytes start and end, and a 64-bit hash of each.

    Words are runs of anything but ASCII white space; ``fold`` takes A-Z as a-z. All words are
    hashed at once, by differences of a running sum of byte numbers times powers.
    """
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~_SPACE[raw]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return start, end, np.empty(0, np.uint64)
    return start, end, run_hashes(raw, start, end, fold)


def run_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray,
               fold: bool = False) -> np.ndarray:
    """A 64-bit hash of each run of bytes ``raw[start:end]``; ``fold`` takes A-Z as a-z."""
    powers, inverse = _power_tables(len(raw) + 1)
    running = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((_FOLDED if fold else _EXACT)[raw] * powers[:len(raw)], out=running[1:])
    return mixed((running[end] - running[start]) * inverse[start] + (end - start).astype(np.uint64))


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word of a text, A-Z as a-z."""
    return word_spans(np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8),
                      fold=True)[2]


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``node, component`` for every node of ``links`` (``a, b``, both long): the component is
    the smallest node that can be reached.

    Every round hangs each node's neighbours on its smallest neighbour, first the larger ones,
    then the smaller ones. Counts of nodes never leave the executors; each round is written to the
    shared folder, and the rounds grow with the logarithm of a component's size. All steps are
    sums or minima by key, so a node with many links is added up map-side.
    """
    def written(df: DataFrame, step: str) -> DataFrame:
        return settle(df, f"{name}-{step}")

    def both(df: DataFrame) -> DataFrame:
        return df.select("a", "b").union(df.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(df: DataFrame, small: bool) -> DataFrame:
        """Link each neighbour of ``a`` that is larger (or, in the other step, not) to the least."""
        near = df.where("a > b") if small else both(df)
        least = near.groupBy("a").agg(F.min("b").alias("least")) \
            .select("a", F.least("a", "least").alias("least"))
        hung = near.join(least, "a")
        if small:
            out = hung.select(F.col("b").alias("x"), F.col("least").alias("y")) \
                .union(least.select(F.col("a").alias("x"), F.col("least").alias("y")))
        else:
            out = hung.where("b > a").select(F.col("b").alias("x"), F.col("least").alias("y"))
        return out.where("x <> y").select(F.greatest("x", "y").alias("a"),
                                          F.least("x", "y").alias("b")).distinct()

    def mark(df: DataFrame) -> tuple:
        row = df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                                 F.least("a", "b").alias("b")).distinct(), "0")
    before = mark(edges)
    step = 0
    while before[0]:
        step += 1
        edges = written(star(star(edges, small=False), small=True), str(step))
        now = mark(edges)
        if now == before:
            break
        before = now
    hung = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return hung.union(roots)
