"""Toxicity by weak supervision: many voters, a generative model of them, a linear classifier.

Voters are lexicons and patterns found in labelled documents: whole words and word beginnings that
stand in toxic documents far more often than in others, dealt into groups. A voter votes for toxic
or not, or abstains. The generative label model is fitted to votes alone, by expectation
maximisation: how often each voter gives each vote under either label (its accuracy), and how far
voters agree beyond what the label explains (their correlation; such votes count for less). Its
posterior labels train a sparse logistic regression, which scores all documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalwatch.llm.common import picked, settle

#: Labelled documents that are learned from, the first by hash of doc_id.
FIT_DOCUMENTS = 20_000
#: Documents of the sample that a term must stand in, and its least evidence: how far its shares of the
#: two labels' documents are apart, in about standard errors. Below, it stands in both alike.
LEAST_SUPPORT, LEAST_EVIDENCE = 6, 3.0
#: Lengths of word beginnings that are terms, written with a trailing *.
BEGINNINGS = (4, 5)
#: A term is dense in a text if it stands there twice, and at least once in so many words.
DENSE = 125
#: Evidence that a term of a voter has at least, as a share of the strongest term's: weaker ones are too
#: often words that just happen to stand in copies of toxic documents.
VOTER_EVIDENCE = 0.125
LEXICON_VOTERS = 8
PATTERN_VOTERS = 4
THRESHOLD = 0.7
_WORD = re.compile(r"[^\W\d_]+")


def terms_of(text: str | None, stems: set[str] | None = None) -> set[str]:
    """The lower-cased words of a text and their beginnings; each a second time, with a trailing !,
    where it is dense in the text. ``stems``: the only beginnings of interest."""
    words = _WORD.findall((text or "").lower())
    counts = Counter(words)
    begun: Counter = Counter()
    for n in BEGINNINGS:
        for word, times in counts.items():
            if len(word) > n and (stems is None or word[:n] in stems):
                begun[word[:n] + "*"] += times
    found = counts.keys() | begun.keys()
    least = max(2, len(words) / DENSE)
    found.update([t + "!" for t, k in counts.items() if k >= least])
    found.update([t + "!" for t, k in begun.items() if k >= least])
    return found


def _tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(batch.text, batch.toxic):
            counts[toxic].update(terms_of(text))
        if len(counts[0]) + len(counts[1]) > 1_000_000:
            for toxic in (0, 1):
                yield pd.DataFrame({"term": list(counts[toxic]), "n": list(counts[toxic].values()),
                                    "toxic": toxic})
                counts[toxic].clear()
    for toxic in (0, 1):
        yield pd.DataFrame({"term": pd.Series(list(counts[toxic]), dtype=object),
                            "n": list(counts[toxic].values()), "toxic": toxic}
                           ).astype({"n": "int64", "toxic": "int64"})


def _places(sent):
    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary: dict[str, int] = sent.value
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch.doc_id, "terms": [
                np.sort(np.fromiter((vocabulary[t] for t in vocabulary.keys() & terms_of(text)),
                                    np.int32)).tobytes() for text in batch.text]})

    return placed


@dataclass
class LabelModel:
    """P(vote | label) of each voter, how much its votes count, and P(toxic)."""

    emission: np.ndarray  # voters x labels x votes (-1, 0 and 1, as 0, 1 and 2)
    share: np.ndarray
    prior: float
    correlation: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        odds = np.log(self.prior / (1 - self.prior)) * np.ones(len(votes))
        for j, share in enumerate(self.share):
            by_vote = np.log(self.emission[j, 1]) - np.log(self.emission[j, 0])
            odds += share * by_vote[votes[:, j] + 1]
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def fit_label_model(votes: np.ndarray, rounds: int = 50) -> LabelModel:
    """Expectation maximisation from the majority vote; votes are -1, 0 (abstains) or 1."""
    n, m = votes.shape
    model = LabelModel(np.full((m, 2, 3), 1 / 3), np.ones(m), 0.5)
    p = np.clip(0.5 + 0.5 * np.sign(votes.sum(1)), 0.05, 0.95)

    def maximise() -> None:
        model.prior = float(np.clip(p.mean(), 1e-4, 1 - 1e-4))
        for j in range(m):
            for label, weight in ((0, 1 - p), (1, p)):
                seen = np.bincount(votes[:, j] + 1, weights=weight, minlength=3) + 0.5
                model.emission[j, label] = seen / seen.sum()

    for step in range(rounds):
        maximise()
        if step in (0, rounds // 2):
            # what voters share beyond the label, from residuals given the label; first of all, so
            # that voters who copy each other do not agree on a label of their own
            residual = np.zeros((n, m))
            for j in range(m):
                values = np.array([-1, 0, 1])
                mean = model.emission[j] @ values
                spread = np.sqrt(np.maximum(model.emission[j] @ values**2 - mean**2, 1e-6))
                residual[:, j] = (1 - p) * (votes[:, j] - mean[0]) / spread[0] \
                    + p * (votes[:, j] - mean[1]) / spread[1]
            size = np.maximum(np.sqrt((residual**2).mean(0)), 1e-9)
            model.correlation = residual.T @ residual / n / size[:, None] / size
            np.fill_diagonal(model.correlation, 0)
            model.share = 1 / (1 + np.clip(model.correlation, 0, 1).sum(1))
        p = model.posterior(votes)
    return model


def fit_classifier(rows: list[np.ndarray], n_terms: int, p: np.ndarray, penalty: float = 2e-5,
                   steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on which terms a document has, by accelerated proximal steps; the
    penalty on absolute weights leaves terms without evidence at 0."""
    length = np.array([len(r) for r in rows])
    column = np.concatenate(rows).astype(np.int64) if length.sum() else np.empty(0, np.int64)
    row = np.repeat(np.arange(len(rows)), length)
    # both labels weigh the same
    weight = p / max(p.sum(), 1e-9) / 2 + (1 - p) / max((1 - p).sum(), 1e-9) / 2
    goal = (p / max(p.sum(), 1e-9) / 2) / weight
    # terms in many documents take smaller steps
    curve = 0.25 * np.bincount(column, weights=weight[row] * np.sqrt(length[row]),
                               minlength=n_terms) + 1e-4
    w, look, bias, t = np.zeros(n_terms), np.zeros(n_terms), 0.0, 1.0
    for _ in range(steps):
        score = np.bincount(row, weights=look[column], minlength=len(rows)) + bias
        miss = weight * (1 / (1 + np.exp(-np.clip(score, -30, 30))) - goal)
        step = look - np.bincount(column, weights=miss[row], minlength=n_terms) / curve
        new = np.sign(step) * np.maximum(np.abs(step) - penalty / curve, 0)
        bias -= 2 * miss.sum()
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look, w, t = new + (t - 1) / after * (new - w), new, after
    return w, float(bias)


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    bias: float
    voters: list[dict]
    labels: LabelModel | None

    def __post_init__(self) -> None:
        self.stems = {t.rstrip("*!") for t in self.weights if "*" in t}

    def score(self, text: str | None) -> float:
        found = self.weights.keys() & terms_of(text, self.stems)
        odds = self.bias + sum(self.weights[t] for t in sorted(found))
        return float(1 / (1 + np.exp(-np.clip(odds, -30, 30))))


def held_out(doc_id) -> F.Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1


def train(documents: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learn from at most ``FIT_DOCUMENTS`` labelled documents that are not held out."""
    some = picked(labels, doc_id="long", toxic="int").where("toxic IN (0, 1)") \
        .where(~held_out("doc_id")).distinct().orderBy(F.xxhash64("doc_id"), "doc_id") \
        .limit(FIT_DOCUMENTS)
    texts = picked(documents, doc_id="long", text="string")
    fitting = settle(texts.join(F.broadcast(some), "doc_id").select("doc_id", "text", "toxic"),
                     "toxicity-fit")
    sizes = dict(fitting.groupBy("toxic").count().collect())
    if len(sizes) < 2:
        return ToxicityModel({}, -30.0 if 1 not in sizes else 0.0, [], None)
    counted = fitting.mapInPandas(_tally, "term string, n long, toxic long") \
        .groupBy("term").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("in1"),
                             F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("in0"))
    lift = F.log((F.col("in1") + 0.5) / (sizes[1] + 1)) - F.log((F.col("in0") + 0.5) / (sizes[0] + 1))
    terms = counted.where(F.col("in1") + F.col("in0") >= LEAST_SUPPORT) \
        .withColumn("lift", lift) \
        .withColumn("evidence", F.abs("lift") * F.sqrt(F.col("in1") + F.col("in0"))) \
        .where(F.col("evidence") >= LEAST_EVIDENCE) \
        .orderBy(F.desc("evidence"), "term").toPandas()
    vocabulary = {t: k for k, t in enumerate(terms.term)}
    sent = documents.sparkSession.sparkContext.broadcast(vocabulary)
    found = fitting.select("doc_id", "text").mapInPandas(_places(sent),
                                                         "doc_id long, terms binary").toPandas()
    found["terms"] = found.terms.map(bytes)
    found = found.sort_values(["doc_id", "terms"])
    rows = [np.frombuffer(t, np.int32) for t in found.terms]

    # words and beginnings that hardly ever stand in documents that are not toxic
    sure = terms[(terms.in1 >= LEAST_SUPPORT) & (terms.lift > 0)
                 & (terms.in0 * sizes[1] * 20 <= terms.in1 * sizes[0])]
    sure = sure[sure.evidence >= VOTER_EVIDENCE * sure.evidence.max()]
    begun = sure.term.str.contains("*", regex=False).to_numpy(bool)
    words, starts = sure.term[~begun].tolist(), sure.term[begun].tolist()
    voters = [{"kind": "lexicon", "terms": words[k::LEXICON_VOTERS], "vote": 1}
              for k in range(LEXICON_VOTERS)]
    voters += [{"kind": "pattern", "terms": starts[k::PATTERN_VOTERS], "vote": 1}
               for k in range(PATTERN_VOTERS)]
    voters += [{"kind": "no word", "terms": words, "vote": -1},
               {"kind": "no pattern", "terms": starts, "vote": -1}]
    voters = [v for v in voters if v["terms"]]
    if not voters:
        return ToxicityModel({}, float(np.log(sizes[1] / sizes[0])), [], None)
    votes = np.zeros((len(rows), len(voters)), np.int8)
    for j, voter in enumerate(voters):
        inside = np.zeros(len(vocabulary) + 1, bool)
        inside[[vocabulary[t] for t in voter["terms"]]] = True
        hit = np.array([inside[r].any() for r in rows])
        votes[:, j] = np.where(hit, 1, 0) if voter["vote"] == 1 else np.where(hit, 0, -1)
    model = fit_label_model(votes)
    w, bias = fit_classifier(rows, len(vocabulary), model.posterior(votes))
    kept = np.flatnonzero(np.abs(w) > 1e-6)
    return ToxicityModel({terms.term[k]: float(w[k]) for k in kept}, bias, voters, model)


def _score(model: ToxicityModel):
    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch.doc_id,
                                "score": [model.score(t) for t in batch.text]})

    return scored


def toxicity(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
             model: ToxicityModel | None = None) -> DataFrame:
    """Return ``doc_id, held_out, score, predicted`` for each document.

    Only texts are scored; a null text is an empty one, and an empty one has the score of no terms.
    Without toxic labels all scores are near 0; with toxic labels only they are 0.5; without a term that
    tells the labels apart (so that there is no voter) all have the share of toxic labels. Repeated rows
    give repeated results. Other columns are ignored; rows without a doc_id are left out. An empty table
    gives an empty result. Texts are read whole, however long.

    At most ``FIT_DOCUMENTS`` labelled documents are learned from, and all terms that stand in
    ``LEAST_SUPPORT`` of them and not alike in both labels' documents.
    """
    model = model or train(documents, labels)
    return picked(documents, doc_id="long", text="string") \
        .mapInPandas(_score(model), "doc_id long, score double") \
        .select("doc_id", held_out("doc_id").alias("held_out"), "score",
                F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
