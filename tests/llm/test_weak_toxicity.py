import random
import zlib

import numpy as np
from llm.tables import WORDS, awkward, documents, sentence

from signalwatch.llm import weak_toxicity as op

BAD = ["gronk", "blerf", "snarg", "plonk", "frizz", "dworp"]


def labels(spark, toxic):
    return spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")


def corpus(n=900):
    rng = random.Random(4)
    texts, toxic = {}, {}
    for k in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.randrange(30, 120))]
        toxic[k] = int(k % 7 == 0)
        if k % 7 == 0 and k % 2:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(BAD)
        elif k % 7 == 0:  # another family: many words that begin alike
            for _ in range(5):
                words[rng.randrange(len(words))] = "zzorl" + rng.choice(WORDS)
        texts[k] = " ".join(words)
    return texts, toxic


def test_held_out_accuracy(spark):
    texts, toxic = corpus()
    found = op.toxicity(documents(spark, texts), labels(spark, toxic)).collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {k for k in texts if zlib.crc32(str(k).encode()) % 3 == 1}
    assert np.mean([r.predicted == toxic[r.doc_id] for r in held]) > 0.97
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in found)


def test_labels_of_held_out_rows_change_nothing(spark):
    texts, toxic = corpus()
    turned = {k: 1 - t if zlib.crc32(str(k).encode()) % 3 == 1 else t for k, t in toxic.items()}
    one, other = (op.train(documents(spark, texts), labels(spark, t)) for t in (toxic, turned))
    assert one.weights == other.weights and one.bias == other.bias


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(5)
    truth = rng.random(6000) < 0.3
    accuracy = [0.9, 0.8, 0.75, 0.85, 0.7]
    votes = np.stack([np.where(rng.random(6000) < a, truth, ~truth) * 2 - 1 for a in accuracy], 1)
    votes[rng.random(votes.shape) < 0.2] = 0
    votes = np.column_stack([votes, votes[:, 4]]).astype(np.int8)  # a copy of the worst voter
    model = op.fit_label_model(votes)
    assert abs(model.prior - 0.3) < 0.05
    for j, a in enumerate(accuracy[:4]):
        assert abs(model.emission[j, 1, 2] / model.emission[j, 1, ::2].sum() - a) < 0.06
    assert model.correlation[4, 5] > 0.8 and model.share[5] < 0.6 < model.share[0]
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.9


def test_awkward_rows(spark):
    texts, toxic = corpus(300)
    model = op.train(documents(spark, texts), labels(spark, toxic))
    found = op.toxicity(documents(spark, awkward()), labels(spark, toxic), model=model)
    scores = {r.doc_id: r.score for r in found.collect()}
    assert found.count() == len(awkward()) - 1
    assert scores[1] == scores[2] == scores[3] == model.score("")
    assert model.score(sentence(1)) == scores[5] == scores[6]
    assert op.toxicity(documents(spark, awkward()).where("doc_id > 99"), labels(spark, toxic),
                       model=model).count() == 0


def test_without_toxic_labels(spark):
    for known in ({}, {5: 0, 6: 0}):
        found = op.toxicity(documents(spark, awkward()), labels(spark, known)).collect()
        assert all(r.score < 0.01 and r.predicted == 0 for r in found)
