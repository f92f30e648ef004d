from collections import Counter
from math import log

import numpy as np
from llm.tables import awkward, documents, rows, sentence

from signalwatch.llm import importance as op


def labels(spark, quality):
    return spark.createDataFrame(list(quality.items()), "doc_id long, quality int")


def texts_and_labels():
    texts = {k: sentence(k, 60) if k % 4 else sentence(k, 60).upper()[::-1] for k in range(200)}
    return texts, {k: int(k % 4 != 0) for k in range(80)}


def test_weights_against_a_plain_count(spark):
    texts, known = texts_and_labels()
    raw, target = Counter(), Counter()
    for k, t in texts.items():
        raw.update(op.buckets_of(t).tolist())
        if known.get(k):
            target.update(op.buckets_of(t).tolist())
    n_raw, n_target = sum(raw.values()) + op.BUCKETS, sum(target.values()) + op.BUCKETS
    found = op.resample(documents(spark, texts), labels(spark, known))
    for r in found.collect():
        here = op.buckets_of(texts[r.doc_id]).tolist()
        weight = sum(log((target[b] + 1) / n_target) - log((raw[b] + 1) / n_raw) for b in here)
        assert abs(r.log_weight - weight) < 1e-6 and r.n_features == len(here) == 119


def test_target_counts_all_good_documents(spark):
    every = spark.range(21_000).selectExpr(
        "id AS doc_id", "IF(id % 3 = 0, 'alpha beta', CONCAT('w', id % 50)) AS text", "1 AS quality")
    ratio, share = op.log_ratios(every, every)  # all are good: both models are the same
    assert share == 1 and np.abs(ratio).max() < 1e-12


def test_filter_of_ids_changes_no_result(spark, monkeypatch):
    texts, known = texts_and_labels()
    expected = op.log_ratios(documents(spark, texts), labels(spark, known))[0]
    monkeypatch.setattr(op, "FILTER_BITS", 64)
    assert (op.log_ratios(documents(spark, texts), labels(spark, known))[0] == expected).all()


def test_top_k_of_weights_and_noise(spark):
    texts, known = texts_and_labels()
    found = op.resample(documents(spark, texts), labels(spark, known)).toPandas()
    k = round(200 * 0.75)
    assert found.kept.sum() == k
    assert set(found[found.kept].doc_id) == set(found.nlargest(k, "key").doc_id)
    assert found[found.doc_id % 4 == 0].kept.sum() <= 2  # text unlike the target
    again = op.resample(documents(spark, texts).repartition(5), labels(spark, known)).toPandas()
    assert set(again[again.kept].doc_id) == set(found[found.kept].doc_id)


def test_noise_is_gumbel(spark):
    noise = np.array([r[0] for r in spark.range(20_000).select(op.gumbel("id")).collect()])
    assert abs(noise.mean() - 0.5772) < 0.03 and abs(noise.var() - np.pi**2 / 6) < 0.06


def test_kth_largest(spark, monkeypatch):
    monkeypatch.setattr(op, "SORTED_ROWS", 5)
    values = [float(x) for x in np.random.default_rng(2).normal(size=300)] + [1.5] * 40
    table = spark.createDataFrame([(v,) for v in values], "key double")
    for k in (1, 2, 17, 40, 100, 340):
        assert op.kth_largest(table, k) == sorted(values, reverse=True)[k - 1]
    assert op.kth_largest(table, 341) is None and op.kth_largest(table, 0) is None


def test_awkward_rows(spark):
    found = op.resample(documents(spark, awkward()), labels(spark, {5: 1, 9: 0}), share=0.5)
    by_id = {r.doc_id: r for r in found.collect()}
    assert found.count() == len(awkward()) - 1 and None not in by_id
    assert by_id[1].n_features == by_id[2].n_features == by_id[3].n_features == 0
    assert by_id[4].n_features == 1 and by_id[7].n_features == 2 * 60_000 - 1
    assert all(r.kept for r in op.resample(documents(spark, awkward()), labels(spark, {})).collect())
    assert op.resample(documents(spark, {1: "x"}).where("doc_id > 1"), labels(spark, {})).count() == 0
    assert rows(op.resample(documents(spark, {1: "x", 2: "y"}), labels(spark, {}), share=0), "kept") \
        == [(False,), (False,)]
