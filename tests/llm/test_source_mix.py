import math
import random
from collections import Counter
from fractions import Fraction

import pytest
from llm.tables import awkward, rows, sentence
from pyspark.sql import functions as F

from signalwatch.llm import source_mix as op


def water_filled(sizes, weights, most):
    """Share by weight; while one is above its bound, stop it there and reshare."""
    total, stopped = Fraction(sum(sizes)), {}
    while True:
        others = [k for k in range(len(sizes)) if k not in stopped]
        rest = total - sum(stopped.values())
        shares = {k: rest * weights[k % len(weights)] / sum(weights[j % len(weights)] for j in others)
                  for k in others}
        over = {k: Fraction(most * sizes[k]) for k, v in shares.items() if v > most * sizes[k]}
        if not over:
            return [float(v) for _, v in sorted((stopped | shares).items())]
        stopped |= over


@pytest.mark.parametrize("seed", range(6))
def test_targets_are_those_of_resharing(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice((0, 1, 5, 40, 1000, 10**6, 10**9)) for _ in range(rng.randrange(1, 12))]
    names = [f"s{k:02}" for k in range(len(sizes) - 1)] + [None]
    table = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")
    found = op.targets(table.repartition(3)).orderBy("source_no").collect()
    assert [r["source"] for r in found] == names
    assert [r["target"] for r in found] == pytest.approx(water_filled(sizes, (1, 2, 3), 3))


def test_draws_are_hypergeometric(spark):
    cases = [(n, m, d) for n in (1, 2, 7, 30) for m in range(0, n + 1, 3) for d in range(0, n + 1, 2)] \
        + [(5000, 1200, 2500)]
    grid = [k / 97 for k in range(97)]
    table = spark.createDataFrame([(*c, u) for c in cases for u in grid],
                                  "n long, m long, d long, u double")
    found = table.select("n", "m", "d", "u", op.hypergeometric(
        F.col("n"), F.col("m"), F.col("d"), F.col("u")).alias("k")).collect()
    for n, m, d in cases:
        passed, below = {}, Fraction(0)
        for k in range(max(0, d + m - n), min(m, d) + 1):
            passed[k] = (below, below + Fraction(math.comb(m, k) * math.comb(n - m, d - k),
                                                 math.comb(n, d)))
            below = passed[k][1]
        for r in found:
            if (r["n"], r["m"], r["d"]) == (n, m, d):
                low, high = passed[r["k"]]
                assert low - Fraction(1, 10**9) <= r["u"] <= high + Fraction(1, 10**9)


def test_permutations_are_one_to_one(spark):
    for n in [*range(1, 30), 1000]:
        found = [r["x"] for r in spark.range(n).select(
            op.permuted(F.col("id"), F.lit(n), F.lit(7)).alias("x")).collect()]
        assert sorted(found) == list(range(n))
    assert found != list(range(n)) and sum(a == b for a, b in enumerate(found)) < 10


@pytest.mark.parametrize("shard_blocks", [1, 7, 64, 10**6])
def test_shards_share_quotas_exactly(spark, shard_blocks):
    quotas = {0: 100, 1: 3, 2: 0, 3: 41, 4: 1}
    table = spark.createDataFrame(list(quotas.items()), "source_no long, quota long")
    found = op.split_quotas(table, shard_blocks, seed=5).collect()
    sizes = Counter()
    places = Counter()
    for r in found:
        sizes[r["shard"]] += r["n"]
        places.update((r["source_no"], k) for k in range(r["first"], r["first"] + r["n"]))
    assert max(places.values()) == 1
    assert set(places) == {(s, k) for s, n in quotas.items() for k in range(n)}
    assert len(sizes) == -(-145 // shard_blocks) and max(sizes.values()) - min(sizes.values()) <= 1


def corpus(spark, texts):
    names = ["b", "a", None, "é", "c"]
    return spark.createDataFrame(
        [(i, t, None if t == "" else names[(i or 0) % 5 if (i or 0) % 3 else 0], "x", "x", "x")
         for i, t in texts],
        "doc_id long, text string, source string, first string, block string, size string")


def test_every_word_is_taken_as_often_as_the_others_of_its_source(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_WORDS", 16)
    texts = awkward() + [(k, sentence(k, k % 40)) for k in range(50, 350)]
    placed, sources = op.lined_up(corpus(spark, texts))
    spans = op.mix(placed, sources, shard_blocks=50).collect()
    about = {r["source_no"]: r for r in sources.collect()}
    docs = {(r["source_no"], r["first"]): r for r in placed.where("size > 0").collect()}
    assert len(docs) == sum(len((t or "").encode().split()) > 0 for i, t in texts if i is not None)
    taken, once = Counter(), Counter()
    for s in spans:
        doc = docs[s["source_no"], s["first"]]
        assert s["doc_id"] == doc["doc_id"] and 0 <= s["start"] < s["start"] + s["n_words"] <= doc["size"]
        words = range(s["first"] + s["start"], s["first"] + s["start"] + s["n_words"])
        taken.update((s["source_no"], w) for w in words)
        once.update((s["source_no"], s["epoch"], w) for w in words)
    assert max(once.values()) == 1
    for no, r in about.items():
        times = {taken[no, w] for w in range(r["source_size"])}
        assert not times or max(times) <= 3 and max(times) - min(times) <= 1
        n_words = sum(n for (s, _), n in taken.items() if s == no)
        assert abs(n_words - r["target"]) <= 1.5 * r["block_words"] + 1
    places = {}
    for s in spans:
        places.setdefault(s["shard"], []).append(s["place"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values()) and len(places) > 3
    # shuffled: a shard does not hold one source after the other
    first = sorted((s["place"], s["source_no"]) for s in spans if s["shard"] == 0)
    assert sum(a[1] != b[1] for a, b in zip(first, first[1:])) > 15


def test_documents_and_reruns(spark, setting):
    texts = awkward() + [(k, sentence(k, k % 40)) for k in range(50, 350)]
    columns = ("doc_id", "size", "source_size", "target", "taken")
    found = rows(op.taken(corpus(spark, texts).repartition(7)), *columns)
    setting(spark__sql__shuffle__partitions="9")
    assert found == rows(op.taken(corpus(spark, texts).repartition(2)), *columns)
    sizes = sorted((i, len((t or "").encode().split())) for i, t in texts if i is not None)
    assert [(i, n) for i, n, *_ in found] == sizes
    assert all(0 <= t <= 3 * n for _, n, _, _, t in found)
    words = sum(n for _, n in sizes)
    assert sum(t for *_, t in found) == pytest.approx(words, rel=0.01)


def test_words_are_those_between_ascii_white_space(spark):
    texts = ["", None, " ", "a", " a", "a ", "\ta\x0b b\x0c\r\n", "a\x85b", "a　b c", " \n"]
    table = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r["n"] for r in table.select(op.n_words(F.col("text")).alias("n")).collect()] \
        == [len((t or "").encode().split()) for t in texts]


def test_nothing_to_mix(spark):
    assert op.taken(corpus(spark, [(1, "x")]).where("doc_id > 1")).count() == 0
    assert rows(op.taken(corpus(spark, [(1, None), (2, "")])), "doc_id", "target", "taken") \
        == [(1, 0.0, 0), (2, 0.0, 0)]
