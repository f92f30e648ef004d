import math
import random

import numpy as np
from llm.tables import CLASHING, awkward, documents, rows, sentence

from signalwatch.llm import minmax_dedup as op
from signalwatch.llm.common import components, word_hashes


def shingles(text, width=2):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + width]) for k in range(len(words) - width + 1)}


def brute(texts, width=2):
    """component by doc_id, from all pairs."""
    sets = {i: shingles(t, width) for i, t in texts.items()}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    x, y = top(i), top(j)
                    up[max(x, y)] = min(x, y)
    return {i: top(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def edited(text, seed, times):
    rng = random.Random(seed)
    words = text.split()
    for _ in range(times):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_all_links_of_near_copies_copies_and_chains(spark):
    texts = {k: sentence(k, 80) for k in range(30)}
    for k in range(100, 190):  # a group of near copies, many of which are not linked directly
        texts[k] = edited(sentence(0, 120), k, k % 12)
    for k in range(200, 260):
        texts[k] = sentence(5, 80).upper() if k % 2 else sentence(5, 80)
    chain = sentence(9, 150)
    for k in range(300, 330):
        chain = edited(chain, k, 4)
        texts[k] = chain
    found = op.near_duplicates(documents(spark, texts))
    component, size = brute(texts)
    assert rows(found, "doc_id", "component_id", "n_shingles", "kept") == sorted(
        (i, component[i], size[i], component[i] == i) for i in texts)


def test_five_words(spark):
    texts = {k: edited(sentence(0, 100), k, k % 4) for k in range(40)}
    component, size = brute(texts, 5)
    found = op.near_duplicates(documents(spark, texts), width=5)
    assert rows(found, "doc_id", "component_id", "n_shingles") == sorted(
        (i, component[i], size[i]) for i in texts)


def test_awkward_rows(spark):
    found = rows(op.near_duplicates(documents(spark, awkward())),
                 "doc_id", "n_shingles", "component_id", "kept")
    component, size = brute({i: t for i, t in awkward() if i is not None})
    assert found == sorted((i, size[i], component[i], component[i] == i) for i in component)


def test_empty_table(spark):
    found = op.near_duplicates(documents(spark, {0: "x"}).where("doc_id > 0"))
    assert found.count() == 0 and "kept" in found.columns and len(CLASHING) > 5


def test_border_is_exact():
    x, y = np.arange(1, 10, dtype=np.uint64), np.arange(2, 11, dtype=np.uint64)
    assert op.similar(x, y)  # 8 of 10
    assert not op.similar(x, np.arange(3, 11, dtype=np.uint64))  # 7 of 10
    assert not op.similar(x[:0], x[:0])


def test_words_split_at_ascii_white_space_only():
    assert len(word_hashes("a\x0bb\xa0c\x85d e")) == 3
    assert word_hashes("Ab")[0] == word_hashes("aB")[0] != word_hashes("É")[0] != word_hashes("é")[0]
    texts = [sentence(k, 3000) for k in range(20)]
    words = {w for t in texts for w in t.split()}
    assert len(set(word_hashes(" ".join(words)).tolist())) == len(words)


def test_min_max_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 400, np.uint64)
    factors = op._factors(40, 2)
    for common in (200, 300, 380):
        other = np.concatenate([base[:common], rng.integers(0, 2**63, 400 - common, np.uint64)])
        same = (op.signature(base, factors) == op.signature(other, factors)).mean()
        assert abs(same - common / (800 - common)) < 0.12


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] \
        + [(k, k + 1) for k in range(1000, 1060)]
    up = {}

    def top(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in links:
        if a != b:
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert rows(found, "node", "component") == sorted((i, top(i)) for i in up)


def test_chance_of_a_lost_link():
    n, least = 2 * op.BANDS * op.PERMUTATIONS_PER_BAND, 0.8 - op.SLACK
    too_low = sum(math.comb(n, k) * 0.8 ** k * 0.2 ** (n - k) for k in range(n + 1) if k / n < least)
    assert too_low + (1 - 0.8 ** 4) ** op.BANDS < 1e-9
