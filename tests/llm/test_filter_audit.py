import random
import re
from itertools import permutations

import pytest
from llm.tables import awkward, documents, rows, sentence

from signalwatch.llm import filter_audit as op


def brute_masks(texts):
    known = [(i, t or "") for i, t in texts if i is not None]
    least = {}
    for i, t in known:
        least[t] = min(i, least.get(t, i))
    out = []
    for i, t in known:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        bits = (len(words) < 100, 100 * len(set(words)) < 80 * len(words),
                100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search(r"[#$%&*|]", t)),
                i > least[t])
        out.append((i, sum(b << k for k, b in enumerate(bits))))
    return sorted(out)


def corpus():
    rng = random.Random(4)
    head = sentence(1, 80) + " "  # longer than several prefixes
    texts = awkward() + [(20 + k, head + sentence(k % 9, 30)) for k in range(60)]
    texts += [(100 + k, sentence(2, 150)) for k in range(80)]  # copies
    texts += [(200 + k, rng.choice(["AB c", "a # b", "x" * k, "Ab" + "é" * k, "a\x85b c", "a b"]))
              for k in range(60)]
    texts += [(300 + k, " ".join(f"w{n}" for n in range(90 + k))) for k in range(20)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("settings", [{}, {"prefix_bytes": 300}, {"local_bytes": 500},
                                      {"prefix_bytes": 1, "local_bytes": 1}])
def test_masks_are_those_of_brute_force(spark, settings):
    texts = corpus()
    found = op.masks(documents(spark, texts).repartition(5), **settings)
    assert rows(found, "doc_id", "mask") == brute_masks(texts)


def test_tries_hold_whole_texts():
    rng = random.Random(6)
    texts = ["".join(rng.choice("ab é") for _ in range(rng.randrange(12))) for _ in range(3000)]
    trie, least, numbers = op.Trie(), {}, {}
    for t in texts:
        i = rng.randrange(10**6)
        least[t] = min(i, least.get(t, i))
        assert numbers.setdefault(t, trie.add(t, i)) == trie.add(t, i)
    assert {t: trie.least[n] for n, t in trie.texts()} == least
    assert {t: n for n, t in trie.texts()} == numbers and trie.held == sum(map(len, least))


def test_counts_are_those_of_filtering_in_every_order(spark):
    texts = corpus()
    docs = documents(spark, texts).selectExpr(
        "*", "CASE doc_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN '' END AS language").drop("lang") \
        .withColumnRenamed("language", "lang")
    marked = [(i, i % 2, i % 5 == 0) for i, _ in texts if i is not None and i % 7] + [(100, None, None)]
    labels = spark.createDataFrame([(i, q, None if t is None else int(t)) for i, q, t in marked],
                                   "doc_id long, quality int, toxic int")
    good = {i for i, q, _ in marked if q == 1}
    toxic = {i for i, _, t in marked if t}
    fails = {}
    for i, mask in brute_masks(texts):
        fails.setdefault("a" if i % 3 == 0 else "", []).append(
            (i, {x for k, x in enumerate(op.FILTERS) if mask >> k & 1}))
    expected = []
    for part, known in fails.items():
        first = {x: 0 for x in op.FILTERS}
        for order in permutations(op.FILTERS):
            left = known
            for step, x in enumerate(order, 1):
                gone = [i for i, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                first[x] += len(gone)
                expected.append([part, "".join(order), step, len(left), len(gone),
                                 sum(x in f for _, f in known) - len(gone),
                                 sum(f == {x} for _, f in known), len([i for i in gone if i in good]),
                                 len([i for i in gone if i in toxic])])
        for row in expected:
            if row[0] == part:
                row.append(first[row[1][row[2] - 1]])
    found = op.audit(docs, labels)
    assert rows(found, "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                "good_lost", "toxic_lost", "shapley") == sorted(map(tuple, expected))


def test_no_documents(spark):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    docs = documents(spark, {1: "x"})
    assert op.audit(docs.where("doc_id > 1"), labels).count() == 0
    assert op.audit(docs, labels.where("doc_id > 1")).count() == 600
