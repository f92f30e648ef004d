import itertools
import time

from llm.tables import awkward, documents, rows, sentence

from signalwatch.llm import spaced_seeds as op


def items(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in texts],
                                 "item_id long, text string, doc_id string")


def test_masks_meet_every_window_that_counts():
    for n in range(6, op.WINDOW + 1):
        may_differ = sum(n >= k for k in op.MAY_DIFFER)
        for off in itertools.combinations(range(n), may_differ):
            assert any(all(bit == "0" or at + j not in off for j, bit in enumerate(mask))
                       for mask in op.MASKS for at in range(n - len(mask) + 1)), (n, off)


def words(text):
    out, word = [], ""
    for c in (text or "").lower() + " ":
        if c.isalnum():
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def brute(docs, benchmark):
    out = set()
    for (i, d), (j, b) in itertools.product(set(docs), set(benchmark)):
        if i is None or j is None:
            continue
        x, y = words(d), words(b)
        if len(y) < 6:
            continue
        width = min(op.WINDOW, len(y))
        need = width - sum(width >= k for k in op.MAY_DIFFER)
        best = 0
        for shift in range(-len(y), len(x)):
            first, behind = max(0, -shift), min(len(y), len(x) - shift)
            same = [x[shift + k] == y[k] for k in range(first, behind)]
            if len(same) >= width:
                best = max([best] + [sum(same[k:k + width]) for k in range(len(same) - width + 1)])
        if best >= need:
            out.add((i, j, best))
    return sorted(out)


def swapped(text, every):
    return " ".join("other" if k % every == every - 1 else w for k, w in enumerate(text.split()))


def test_against_brute_force(spark):
    passages = [(k, sentence(100 + k, n)) for k, n in enumerate((5, 6, 9, 13, 16, 19, 20, 35, 60))]
    docs = [(0, sentence(1))]
    for k, (_, p) in enumerate(passages):
        docs += [(10 + k, sentence(2) + " " + p.upper() + ". " + sentence(3)),
                 (30 + k, f"{sentence(4)}, {swapped(p, 6)} {sentence(5)}"),
                 (50 + k, swapped(p, 4)), (70 + k, p[len(p) // 3:])]
    found = op.overlaps(documents(spark, docs), items(spark, passages))
    assert rows(found, "doc_id", "item_id", "n_best") == brute(docs, passages)


def test_awkward_rows(spark):
    benchmark = [(1, None), (2, ""), (None, sentence(1)), (3, sentence(1)), (3, sentence(1)),
                 (4, sentence(2, 30))]
    found = op.overlaps(documents(spark, awkward()), items(spark, benchmark))
    assert [r[:2] for r in rows(found, "doc_id", "item_id")] \
        == [r[:2] for r in brute(awkward(), benchmark) if r[0] != 7] + [(7, 4)]
    left = op.without_overlaps(documents(spark, awkward()), items(spark, benchmark))
    assert left.columns == documents(spark, awkward()).columns
    assert left.count() == len(awkward()) - 4


def test_empty_tables(spark):
    some = documents(spark, awkward())
    assert op.overlaps(some, items(spark, [(1, "x")]).where("item_id > 1")).count() == 0
    assert op.overlaps(some.where("doc_id > 99"), items(spark, [(1, sentence(1))])).count() == 0


def test_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(op, "BROADCAST_HASHES", 0)
    found = op.overlaps(documents(spark, {1: sentence(1)}), items(spark, [(5, sentence(1))]))
    assert rows(found, "doc_id", "item_id", "n_equal", "n_words") == [(1, 5, 40, 40)]


def test_long_texts_of_repeated_words(spark):
    # every shift of such a text is a hit; each meets only a block of it
    texts = {1: "karen mosti " * 6000, 2: "karen mosti " * 40 + sentence(7, 9000) + " mosti karen" * 5}
    passages = [(1, "karen mosti " * 12), (2, "mosti karen " * 50), (3, sentence(7, 9000))]
    begun = time.time()
    found = op.overlaps(documents(spark, texts), items(spark, passages))
    assert rows(found, "doc_id", "item_id", "n_best", "n_equal") == [
        (1, 1, 20, 24), (1, 2, 20, 100), (2, 1, 20, 24), (2, 2, 20, 80), (2, 3, 20, 9000)]
    assert time.time() - begun < 60
