"""Near-duplicates by min-max hashing, confirmed on the documents' full shingle sets.

Each random permutation gives two signature values, the least and the greatest hash, so that a
signature of 2k values takes k hash evaluations. Bands of signature values name buckets; documents
that share a bucket are candidates.

How the work stays bounded where many documents share a bucket:

* Exact copies (equal shingle sets) are one class, found by one aggregation. Only the smallest
  doc_id of a class goes on.
* In each bucket, all members are compared with the bucket's two leaders only: as many pairs as
  members. Confirmed links are joined to components.
* Buckets whose members still lie in several components are taken up again, all buckets of a leader
  together: members outside the largest component are compared with those of other components, block
  by block, first by signatures, then by full sets where those come near the threshold. Links within
  a component cannot change it and are not looked for.

Texts meet their partners in sorted streams, one leader's set at a time: no group is held whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalwatch.llm.common import BASE, components, mixed, picked, settle, word_hashes

BANDS = 40
PERMUTATIONS_PER_BAND = 2
#: Documents of one block when members of a leader's buckets are compared.
BLOCK = 500
#: How far below the threshold a signature's estimate may lie: nearly seven deviations at 160 values.
SLACK = 0.22


def shingle_hashes(text: str | None, width: int = 2) -> np.ndarray:
    """The sorted distinct hashes of a text's word shingles.

    A text of fewer words than ``width`` is one shingle; a text without words has none.
    """
    hashes = word_hashes(text)
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    out = np.full(len(hashes) - width + 1, width, np.uint64)
    for k in range(width):
        out = mixed(out * np.uint64(BASE) + hashes[k:len(hashes) - width + 1 + k])
    return np.unique(out)


def similar(x: np.ndarray, y: np.ndarray, percent: int = 80) -> bool:
    """100 * intersection >= percent * union, of two sorted sets; an empty set is like nothing."""
    if not len(x) or not len(y) or 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    if len(x) > len(y):
        x, y = y, x
    place = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[place] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _factors(bands: int, per_band: int) -> np.ndarray:
    return np.random.default_rng(7).integers(0, 2**63, bands * per_band, np.uint64) \
        * np.uint64(2) + np.uint64(1)


def signature(hashes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The least and the greatest hash of a set under each permutation, in two columns."""
    # an odd factor turns well mixed hashes into another order: one permutation
    low = np.full(len(factors), 2**64 - 1, np.uint64)
    high = np.zeros(len(factors), np.uint64)
    for begin in range(0, len(hashes), 4096):
        turned = factors[:, None] * hashes[None, begin:begin + 4096]
        np.minimum(low, turned.min(1), out=low)
        np.maximum(high, turned.max(1), out=high)
    return np.stack([mixed(low), mixed(high)], 1)


def band_keys(values: np.ndarray, bands: int) -> np.ndarray:
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for column in values.reshape(bands, -1).T:
        keys = mixed(keys * np.uint64(BASE) + column)
    return keys


def _signer(bands: int, per_band: int, width: int):
    factors = _factors(bands, per_band)

    def signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.doc_id, batch.text):
                hashes = shingle_hashes(text, width)
                if not len(hashes):
                    rows.append((doc_id, 0, b"", []))
                    continue
                rows.append((doc_id, len(hashes), xxhash.xxh3_128_digest(hashes.tobytes()),
                             band_keys(signature(hashes, factors), bands).view(np.int64)))
            yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "digest", "keys"])

    return signed


def _confirm(width: int, percent: int):
    def confirmed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, of_held = None, None
        for batch in batches:
            links = []
            for lead, salt, doc_id, text in zip(batch.lead, batch.salt, batch.doc_id, batch.text):
                if doc_id == lead:
                    held, of_held = shingle_hashes(text, width), (lead, salt)
                elif of_held == (lead, salt) and similar(held, shingle_hashes(text, width), percent):
                    links.append((lead, doc_id))
            yield pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    return confirmed


def confirmed_links(pairs: DataFrame, texts: DataFrame, width: int = 2,
                    percent: int = 80) -> DataFrame:
    """The rows of ``pairs`` (``a, b``) whose texts are similar.

    Each text is shuffled once to the pairs that name it. Pairs of one ``a`` are split by salt
    and streamed behind the text of ``a``.
    """
    dealt = pairs.select(F.col("a").alias("lead"), F.col("b").alias("doc_id"),
                         F.pmod(F.xxhash64("b"), F.lit(64)).alias("salt"))
    wanted = dealt.union(dealt.select("lead", F.col("lead").alias("doc_id"), "salt").distinct())
    return (
        wanted.join(texts.hint("merge"), "doc_id")  # one plan, however few the pairs
        .repartition("lead", "salt")
        .sortWithinPartitions("lead", "salt", F.col("doc_id") != F.col("lead"))
        .select("lead", "salt", "doc_id", "text")
        .mapInPandas(_confirm(width, percent), "a long, b long")
    )


def _links_between(width: int, percent: int, factors: np.ndarray):
    least = percent / 100 - SLACK

    def links(group: pd.DataFrame) -> pd.DataFrame:
        sets = [shingle_hashes(t, width) for t in group.text]
        signs = np.stack([signature(s, factors).astype(np.uint8).ravel() for s in sets])
        sizes, ids = np.array([len(s) for s in sets]), group.doc_id.to_numpy()
        labels, stray = group.label.to_numpy(), group.stray.to_numpy()
        out = []
        for x in np.flatnonzero(stray):
            fit = np.flatnonzero(~stray & (labels != labels[x]) & (
                100 * np.minimum(sizes[x], sizes) >= percent * np.maximum(sizes[x], sizes)))
            for y in fit[(signs[fit] == signs[x]).mean(1) >= least]:
                if similar(sets[x], sets[y], percent):
                    out.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return links


def near_duplicates(documents: DataFrame, percent: int = 80, width: int = 2,
                    bands: int = BANDS, per_band: int = PERMUTATIONS_PER_BAND) -> DataFrame:
    """Return ``doc_id, n_shingles, component_id, kept, class_id, n_links`` for each document.

    ``component_id`` is the smallest doc_id that can be reached by links, ``kept`` marks it,
    ``class_id`` the smallest doc_id with an equal shingle set, ``n_links`` counts the confirmed
    links of the class that were needed to join components. Two sets of a Jaccard similarity of 0.8
    meet in no band with probability ``(1 - 0.8 ** 4) ** 40``, and a signature's estimate is too low
    for a comparison with less than 1e-10: together < 1e-9.

    Null and empty texts, and texts of white space only, have 0 shingles, are linked with nothing
    and kept. Equal rows count once; a doc_id with several texts has a row for each of their classes.
    Other columns are ignored; rows without a doc_id are left out. An empty table gives an empty
    result. Texts are read whole, however long.
    """
    texts = picked(documents, doc_id="long", text="string")
    signed = settle(
        texts.mapInPandas(_signer(bands, per_band, width),
                          "doc_id long, n_shingles long, digest binary, keys array<long>"),
        "dedup-signed")
    empty = signed.where("n_shingles = 0").select("doc_id").distinct()
    classes = signed.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("class_id"))
    members = settle(
        signed.where("n_shingles > 0").select("doc_id", "n_shingles", "digest")
        .join(classes, "digest").select("doc_id", "n_shingles", "class_id").distinct(),
        "dedup-classes")
    heads = members.where("doc_id = class_id").select("doc_id")
    stood = signed.join(heads, "doc_id", "left_semi")
    buckets = stood.select("doc_id", F.explode("keys").alias("key"))
    order = F.xxhash64("doc_id")
    led = settle(
        buckets.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"),
                                   F.min_by("doc_id", order).alias("second"))
        .where("n > 1"), "dedup-buckets")
    shared = settle(buckets.join(led, "key"), "dedup-shared")

    def pair(x: str, y: str) -> list:
        return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]

    first = settle(
        shared.select(*pair("doc_id", "first")).union(shared.select(*pair("doc_id", "second")))
        .where("a <> b").distinct(), "dedup-pairs")
    links = settle(confirmed_links(first, texts, width, percent).distinct(), "dedup-links")
    labels = components(links)

    # buckets that still hold several components; all buckets of one leader are one group
    placed = settle(
        shared.where("n > 2").select("key", F.col("second").alias("lead"), "doc_id").join(
            labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("key", "lead", "doc_id", F.coalesce("component", "doc_id").alias("label")),
        "dedup-placed")
    unsettled = placed.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")) \
        .where("x <> y").select("key")
    active = settle(placed.join(unsettled, "key", "left_semi")
                    .select("lead", "doc_id", "label").distinct(), "dedup-active")
    groups = active.groupBy("lead", "label").agg(F.count("*").alias("size")) \
        .groupBy("lead").agg(F.max_by("label", F.struct("size", "label")).alias("main"),
                             F.sum("size").alias("size"))
    # every stray meets every block of its group; both sides of a meeting are bounded blocks
    n_blocks = F.ceil(F.col("size") / BLOCK).cast("long")
    dealt = active.where("doc_id <> lead").join(groups, "lead").select(
        "lead", "doc_id", "label", (F.col("label") != F.col("main")).alias("stray"),
        F.pmod(F.xxhash64("doc_id"), n_blocks).alias("mine"),
        F.sequence(F.lit(0).cast("long"), n_blocks - 1).alias("blocks"))
    stray_blocks = dealt.where("stray").select("lead", F.col("mine").alias("x")).distinct()
    rest = dealt.select("lead", "doc_id", "label", F.col("mine").alias("y"),
                        F.explode("blocks").alias("x"), F.lit(False).alias("stray")) \
        .join(stray_blocks, ["lead", "x"], "left_semi")
    strays = dealt.where("stray").select("lead", "doc_id", "label", F.explode("blocks").alias("y"),
                                         F.col("mine").alias("x"), "stray")
    more = settle(
        rest.unionByName(strays).join(texts.hint("merge"), "doc_id")
        .groupBy("lead", "x", "y")
        .applyInPandas(_links_between(width, percent, _factors(bands, per_band)), "a long, b long")
        .distinct(), "dedup-more")
    every = links.union(more)
    whole = components(labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
                       .union(more), "components-all")
    degree = every.select(F.explode(F.array("a", "b")).alias("class_id")) \
        .groupBy("class_id").agg(F.count("*").alias("n_links"))
    found = (
        members.join(whole.select(F.col("node").alias("class_id"), "component"), "class_id", "left")
        .join(degree, "class_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "class_id").alias("component_id"),
                "class_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    )
    nothing = empty.join(members.select("doc_id"), "doc_id", "left_anti").select(
        "doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"),
        F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return found.union(nothing).select(
        "doc_id", "n_shingles", "component_id",
        (F.col("doc_id") == F.col("component_id")).alias("kept"), "class_id", "n_links")
