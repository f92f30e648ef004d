import math
import random
import re
from collections import Counter

import numpy as np
from llm.tables import awkward, documents, rows, sentence

from signalwatch.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(texts, items, k):
    docs = [(i, Counter(terms(t))) for i, t in texts if i is not None and terms(t)]
    n_docs, n_words = len(docs), sum(sum(c.values()) for _, c in docs)
    holding = Counter(w for _, c in docs for w in c)
    wanted = {}
    for i, t in set(items):
        if i is not None:
            wanted.setdefault(i, Counter()).update(terms(t))
    out = []
    for item, words in wanted.items():
        scores = []
        for doc_id, c in docs:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_words
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[w] + 1)))
                        * ((1000000000 * c[w]) // (1000 * c[w] + 12 * m))
                        for w, times in words.items() if c[w])
            scores.append((-score, doc_id))
        out += [(item, rank, doc_id, -s) for rank, (s, doc_id) in enumerate(sorted(scores)[:k], 1)
                if s]
    return sorted(out)


def as_items(spark, pairs):
    return spark.createDataFrame([(i, t, "x", "x") for i, t in pairs],
                                 "item_id long, text string, doc_id string, score string")


def test_ranks_as_by_scoring_everything(spark):
    copies = [(100 + k, sentence(3, 30)) for k in range(60)]  # ties of more documents than places
    texts = awkward() + copies + [(k, sentence(k, k % 70 + 1) + " Ünï-ÄÖ" * (k % 3))
                                  for k in range(200, 700)]
    random.Random(1).shuffle(texts)
    items = [(1, sentence(3, 30)), (2, sentence(250, 12) + " " + sentence(250, 12)), (3, None),
             (4, ""), (5, "nowhere"), (6, "KAren, ünï; äö"), (7, sentence(9, 400)), (1, sentence(3, 30)),
             (8, "neren"), (8, "tidal karen"), (None, "karen"), (9, sentence(5, 3))]
    docs = documents(spark, texts).repartition(3)
    expected = brute(texts, items, 20)
    for settings in ({}, {"shard_postings": 300}, {"terms_together": 10}):
        found = lexical_search.search(docs, as_items(spark, items), **settings)
        assert rows(found, "item_id", "rank", "doc_id", "score") == expected
    assert rows(lexical_search.search(docs, as_items(spark, items), k=3),
                "item_id", "rank", "doc_id", "score") == brute(texts, items, 3)


def test_empty_tables(spark):
    docs, items = documents(spark, {1: "karen"}), as_items(spark, [(1, "karen")])
    for a, b in ((docs.where("doc_id > 1"), items), (docs, items.where("item_id > 1")),
                 (documents(spark, {1: None, 2: ""}), items)):
        found = lexical_search.search(a, b)
        assert found.count() == 0
        assert [t for _, t in found.dtypes] == ["bigint", "int", "bigint", "bigint"]


def test_reading_ends_early_and_best_positions_pass_what_was_read():
    rng = np.random.default_rng(5)
    n_docs, n_terms = 20_000, 6
    doc = np.concatenate([rng.permutation(n_docs)[:12_000] for _ in range(n_terms)])
    term = np.repeat(np.arange(n_terms), 12_000)
    impact = rng.integers(1, 10, len(doc)) ** 6
    shard = lexical_search._Shard(n_terms, np.arange(n_docs) * 3, doc, term, impact)
    looked_at = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray) and key.ndim == 1 and type(self) is Watched:
                looked_at.append(len(key))
            return np.asarray(super().__getitem__(key))

    total = np.zeros(n_docs, np.int64)
    np.add.at(total, doc, impact)
    shard.doc = shard.doc.view(Watched)
    none = np.empty(0, np.int64)
    scores, ids = shard.best(np.arange(n_terms), np.ones(n_terms, np.int64), 5, none, none)
    order = np.lexsort((np.arange(n_docs), -total))[:5]
    assert scores.tolist() == total[order].tolist() and ids.tolist() == (order * 3).tolist()
    assert sum(looked_at[1:]) < len(doc)  # the first look is the table of positions
