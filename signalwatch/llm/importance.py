"""Importance resampling: documents drawn by how much likelier target text is to contain their
n-grams than raw text.

Words and pairs of neighbouring words are hashed to buckets. A generative model is a count for
each bucket: the raw model of all documents, the target model of all documents labelled as good; of
texts, only those that a bit filter takes for labelled ones are shuffled. A
document's weight is the ratio of its likelihoods, the sum over its n-grams of the log ratio of their
buckets. The Gumbel-top-k trick draws without replacement in proportion to the weights: the k largest
of log weight + Gumbel noise, where the noise is a hash of doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalwatch.llm.common import BASE, mixed, picked, settle, word_hashes

BUCKETS = 1 << 14
#: Bits of the filter of labelled ids, a multiple of 64; fewer let more unlabelled texts be shuffled
#: and change no result.
FILTER_BITS = 1 << 26
#: Added to each bucket's count.
SMOOTHING = 1.0
SEED = 17
#: While finding the k-th largest key, a range of keys of at most so many rows is sorted.
SORTED_ROWS = 50_000


def buckets_of(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of each word and each pair of neighbours; none for a text without words."""
    words = word_hashes(text)
    pairs = mixed(words[:-1] * np.uint64(BASE) + words[1:])
    return (np.concatenate([words, pairs]) % np.uint64(buckets)).astype(np.int64)


def _count(buckets: int):
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.text:
                total += np.bincount(buckets_of(text, buckets), minlength=buckets)
        here = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": here, "n": total[here]})

    return counted


def bucket_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs in the column ``text``, added up by task."""
    found = texts.select("text").mapInPandas(_count(buckets), "bucket long, n long") \
        .groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # a row for each bucket
    counts = np.zeros(buckets, np.int64)
    counts[found.bucket] = found.n
    return counts


def labelled(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``texts`` (``doc_id, text``) whose doc_id is one of ``ids`` (``doc_id``, each once).

    A filter of ``FILTER_BITS`` bits, broadcast as a row for each 64 of them, keeps most other rows
    from the shuffle.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumns({"place": F.floor(slot / 64),
                               "bit": F.expr("shiftleft(1L, cast(pmod(xxhash64(doc_id), 64L) as int))")})

    bits = placed(ids).groupBy("place").agg(F.bit_or("bit").alias("bits"))
    near = placed(texts).join(F.broadcast(bits), "place") \
        .where(F.col("bits").bitwiseAND(F.col("bit")) != 0).select("doc_id", "text")
    return near.join(ids.hint("merge"), "doc_id")  # one plan, however few the labels


def _weigh(ratio: np.ndarray):
    def weighed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [buckets_of(t, len(ratio)) for t in batch.text]
            yield pd.DataFrame({
                "doc_id": batch.doc_id, "n_features": [len(f) for f in found],
                "log_weight": [float(ratio[f].sum()) for f in found]})

    return weighed


def log_ratios(documents: DataFrame, labels: DataFrame, buckets: int = BUCKETS) \
        -> tuple[np.ndarray, float]:
    """The log ratio of each bucket, target over raw, and the share of good ones among labels."""
    known = picked(labels, doc_id="long", quality="int").where("quality IN (0, 1)") \
        .groupBy("doc_id").agg(F.max("quality").alias("quality"))
    share = known.agg(F.avg("quality")).first()[0]
    texts = picked(documents, doc_id="long", text="string")
    good = settle(known.where("quality = 1").select("doc_id"), "importance-good")
    target = bucket_counts(labelled(texts, good), buckets)
    if not target.any():
        return np.zeros(buckets), 1.0 if share is None else share
    raw = bucket_counts(texts, buckets) + SMOOTHING
    target = target + SMOOTHING
    return np.log(target / target.sum()) - np.log(raw / raw.sum()), share


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Noise of the standard Gumbel distribution; the same for the same doc_id."""
    steps = 1 << 52
    uniform = (F.pmod(F.xxhash64(doc_id, F.lit(seed)), F.lit(steps)) + 0.5) / steps
    return -F.log(-F.log(uniform))


def kth_largest(keys: DataFrame, k: int) -> float | None:
    """The k-th largest of the column ``key`` of a stored table, by counting in ever narrower
    ranges; only a bounded range is sorted. None if there are fewer rows."""
    if k < 1:
        return None
    low, high, n = keys.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if n < k:
        return None
    above = 0  # rows over ``high``
    while low < high:
        inside = keys.where(F.col("key").between(low, high))
        if n <= SORTED_ROWS:
            return inside.orderBy(F.desc("key")).limit(k - above).agg(F.min("key")).first()[0]
        width = (high - low) / 1024
        if low + width == low:
            break
        slot = F.least(F.floor((F.col("key") - low) / width), F.lit(1023))
        slots = inside.groupBy(slot.alias("slot")).agg(
            F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")) \
            .orderBy(F.desc("slot")).collect()  # at most 1024 rows
        for row in slots:
            if above + row["n"] >= k:
                low, high, n = row["low"], row["high"], row["n"]
                break
            above += row["n"]
    return low


def resample(documents: DataFrame, labels: DataFrame, share: float | None = None,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Return ``doc_id, n_features, log_weight, key, kept`` for each document.

    ``share`` of all rows, rounded, are kept; where not given, as many as labels call good. Null and
    empty texts have no n-grams and log weight 0. Without good labels all weights are 0 and the
    draw is uniform; without any labels and ``share`` all are kept. Rows of equal key (repeated
    rows) are kept or not together, so that ties at the border may add to k. Other columns are
    ignored; rows without a doc_id are left out. An empty table gives an empty result. Texts are
    read whole, however long.
    """
    ratio, good = log_ratios(documents, labels, buckets)
    weighed = settle(
        picked(documents, doc_id="long", text="string")
        .mapInPandas(_weigh(ratio), "doc_id long, n_features long, log_weight double")
        .withColumn("key", F.col("log_weight") + gumbel(F.col("doc_id"), seed)), "importance")
    k = round((good if share is None else share) * weighed.count())
    least = kth_largest(weighed.select("key"), k)
    kept = F.lit(False) if least is None else F.col("key") >= F.lit(least)
    return weighed.withColumn("kept", kept)
