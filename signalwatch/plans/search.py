"""Random search of model parameters by successive halving over expanding folds.

Candidates are drawn from a space with a seed. All are tried on the first fold; the better half goes on
to the next, which trains on more rows, and so on: most of the work goes into candidates worth it.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalwatch import constants as C
from signalwatch.operators.least_squares import moments, r2, ridge
from signalwatch.operators.metrics import regression_metrics
from signalwatch.operators.splits import POSITION, fold_ranges, ts_folds

Candidate = dict[str, Any]
Space = Mapping[str, Callable[[random.Random], Any]]


def one_of(*values: Any) -> Callable[[random.Random], Any]:
    return lambda rng: rng.choice(values)


def between(low: float, high: float) -> Callable[[random.Random], float]:
    """Evenly spread on a logarithmic scale."""
    return lambda rng: math.exp(rng.uniform(math.log(low), math.log(high)))


def draw(space: Space, n: int, seed: int = 42) -> list[Candidate]:
    """``n`` candidates; the same for the same space and seed."""
    rng = random.Random(seed)
    return [{name: pick(rng) for name, pick in space.items()} for _ in range(n)]


@dataclass(frozen=True)
class Tried:
    """A candidate's number, its parameters and its scores on the folds it was tried on."""

    number: int
    parameters: Candidate
    scores: tuple[float, ...]

    @property
    def mean(self) -> float:
        return sum(self.scores) / len(self.scores)


def halving(candidates: Sequence[Candidate], folds: int,
            score: Callable[[Candidate, int], float], together: Callable = map) -> list[Tried]:
    """Try candidates on folds 0, 1, ...; after each, the better half by mean score goes on (rounded up;
    equal ones by number). Best first: tried on more folds, then the mean, then the number."""
    left = [Tried(k, c, ()) for k, c in enumerate(candidates)]
    done: list[Tried] = []
    for fold in range(folds):
        found = list(together(lambda t: score(t.parameters, fold), left))
        left = [Tried(t.number, t.parameters, (*t.scores, s)) for t, s in zip(left, found)]
        left.sort(key=lambda t: (-t.mean, t.number))
        if fold + 1 < folds:
            keep = -(-len(left) // 2)
            done, left = left[keep:] + done, left[:keep]
    return left + done


def search_linear(ordered: DataFrame, n_rows: int, candidates: Sequence[Candidate],
                  label: str = C.LABEL, folds: int = C.FOLDS) -> list[Tried]:
    """Ridge regressions with ``features`` (names) and ``strength``.

    One aggregation gives the moments of every fold's train and test part; any number of candidates is
    fitted and scored from these.
    """
    columns = sorted({name for c in candidates for name in c["features"]} | {label})
    parts = moments(ts_folds(ordered.select(POSITION, *columns), n_rows, folds), columns,
                    ["fold", "role"])

    def score(candidate: Candidate, fold: int) -> float:
        model = ridge(parts[fold, "train"], candidate["features"], label, candidate["strength"])
        return r2(model, parts[fold, "test"], label)

    return halving(candidates, folds, score)


def search_models(rows: DataFrame, n_rows: int, candidates: Sequence[Candidate],
                  model: Callable[..., Any], label: str = C.LABEL, folds: int = C.FOLDS,
                  parallel: int = 4) -> list[Tried]:
    """Any model that fits rows with a position, label and features, as ``model(**parameters)``.

    ``rows`` are read for every fit, so they should be stored. Fits of a fold run side by side.
    """
    position = F.col(POSITION)
    ranges = {f: (start, end) for f, start, end in fold_ranges(n_rows, folds)}

    def score(candidate: Candidate, fold: int) -> float:
        start, end = ranges[fold]
        fitted = model(**candidate).fit(rows.where(position < start))
        tested = fitted.transform(rows.where((position >= start) & (position < end)))
        return regression_metrics(tested, label, "prediction").first()["r2"]

    with ThreadPool(parallel) as pool:
        return halving(candidates, folds, score, lambda f, left: pool.map(
            inheritable_thread_target(rows.sparkSession)(f), left))


def table(spark, tried: Sequence[Tried]) -> DataFrame:
    """One row for each candidate: its number, how many folds it was tried on, the mean score, and
    whether it won."""
    rows = [(t.number, len(t.scores), t.mean, k == 0) for k, t in enumerate(tried)]
    return spark.createDataFrame(rows, "candidate int, n_folds int, r2 double, winner boolean")
