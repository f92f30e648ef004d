import itertools
import re
from collections import Counter

import numpy as np
from llm.tables import awkward, documents, rows, sentence

from signalwatch.llm import crf_quality as op

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    windows = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    often = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated,
            len(covered))


def labels(spark, quality):
    return spark.createDataFrame(list(quality.items()), "doc_id long, quality int")


def test_base_counts(spark):
    texts = awkward() + [(20, "a b c d e a b c d e f"), (21, "x\nx\n\n \nx \nx"), (22, "é#*  é|\x85<>"),
                         (23, " a\n a\na\n"), (24, "😀😀 b\xa0c $")]
    found = op.quality(documents(spark, texts), labels(spark, {}))
    assert rows(found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                "n_repeat_words") == sorted((i, *counts(t)) for i, t in texts if i is not None)
    for r in found.collect():
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_viterbi_finds_the_best_of_all_paths():
    rng = np.random.default_rng(1)
    for n in range(0, 9):
        for _ in range(20):
            crf = op.Crf(rng.normal(size=(2, len(op.FEATURES))), rng.normal(size=(2, 2)))
            x = rng.normal(size=(n, len(op.FEATURES)))

            def score(path):
                return sum(x[k] @ crf.state[s] for k, s in enumerate(path)) \
                    + sum(crf.move[a, b] for a, b in zip(path, path[1:]))

            best = max(itertools.product((0, 1), repeat=n), key=score)
            assert tuple(crf.decode(x)) == best


def page(seed, junk):
    lines = [sentence(seed * 50 + k, 12).capitalize() + "." for k in range(8)]
    if junk:
        lines[2:] = [" | ".join(sentence(seed * 50 + k, 9).upper().split()) for k in range(8)]
    return "\n".join(lines)


def test_learned_from_labels_and_decided_by_content_share(spark):
    texts = {k: page(k, k % 3 == 0) for k in range(120)}
    texts[500] = "\n".join([page(700, False), page(701, False), page(702, True).split("\n")[4]])
    known = labels(spark, {k: int(k % 3 != 0) for k in range(60)})
    found = {r.doc_id: r for r in op.quality(documents(spark, texts), known).collect()}
    assert all(found[k].kept == (k % 3 != 0) for k in range(60, 120))
    assert found[500].kept and found[500].n_content_lines < found[500].n_lines
    again = {r.doc_id: r for r in op.quality(documents(spark, texts).repartition(7), known).collect()}
    assert again == found


def test_ends_of_long_documents_are_learned_from():
    def lines(seed, n, junk):
        made = [sentence(seed + k, 12) for k in range(n)]
        return [" | ".join(t.upper().split()) if junk else t.capitalize() + "." for t in made]

    # documents differ only behind line 200
    both = [op.measured("\n".join(lines(0, 200, False) + lines(1000, 600, junk)))[1]
            for junk in (False, True)]
    crf = op.fit(both * 3, [True, False] * 3)
    good, bad = (crf.decode(rows)[200:].mean() for rows in both)
    assert good > 0.95 and bad < 0.05


def test_without_labels_all_is_content(spark):
    found = op.quality(documents(spark, {1: page(1, True), 2: page(2, False)}), labels(spark, {}))
    assert rows(found, "doc_id", "kept", "content_share") == [(1, True, 1.0), (2, True, 1.0)]
    assert op.quality(documents(spark, {1: "x"}).where("doc_id > 1"), labels(spark, {})).count() == 0
