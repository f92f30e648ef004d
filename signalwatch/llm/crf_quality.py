"""Quality rules: each line of a text is content or boilerplate, told by a linear-chain CRF.

A line has a few numbers (``FEATURES``); the CRF adds what a line's neighbours say. It is fitted on
the driver by likelihood, on a bounded sample of labelled documents, and decoded by Viterbi over all
lines of every document. A document stays if enough of its words lie in content lines.

Lines carry no labels of their own, only their documents do. A logistic regression on single lines
first tells which lines of bad documents look like good ones and the other way round; the CRF then
learns from lines so labelled, with their neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalwatch.llm.common import mixed, picked, word_spans

#: At most so many labelled documents of each quality are fitted on, the first by hash of doc_id.
FIT_DOCUMENTS = 2000
#: All lines of a fitting document are learned from, in chains of at most so many.
FIT_CHAIN = 24
#: Least share of a document's words in content lines.
LEAST_CONTENT = 0.5
FEWEST_WORDS = 10
#: Most percent of words that may lie in repeated windows.
MOST_REPEATED = 20
REPEATED_WINDOW = 5
FEATURES = ("bias", "log_words", "short", "word_length", "symbols", "capitals", "digits",
            "sentence_end", "repeated_line", "repeated_words", "echoes")
_SYMBOLS = "#*$%&|<>"  # fixed values: the symbols a text's n_symbols counts


def _classes() -> np.ndarray:
    """A bit for each kind of character, for code points below 0x250; others have no kind."""
    kinds = np.zeros(0x250, np.uint8)
    for point in range(len(kinds)):
        c = chr(point)
        kinds[point] = ((c in _SYMBOLS) | c.isupper() << 1 | c.isdigit() << 2
                        | (c in ".!?:;\"'") << 3)
    return kinds


_KINDS = _classes()


@dataclass
class Base:
    """The counts of a text that rules are made of."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int

    @property
    def failed(self) -> bool:
        return self.n_words < FEWEST_WORDS or 100 * self.n_repeat_words > MOST_REPEATED * self.n_words


def measured(text: str | None) -> tuple[Base, np.ndarray, np.ndarray]:
    """The base counts, a row of ``FEATURES`` for each line with a word, and words by line."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    start, end, hashes = word_spans(raw)
    n = len(start)
    if not n:
        return Base(0, 0, int(sum(map(text.count, _SYMBOLS))), 0, 0), \
            np.empty((0, len(FEATURES))), np.empty(0, np.int64)
    # code points: bytes that do not continue one
    leads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    chars = leads[end] - leads[start]
    # words in windows that occur again
    repeated = np.zeros(n + 1, np.int64)
    if n > REPEATED_WINDOW:
        windows = np.zeros(n - REPEATED_WINDOW + 1, np.uint64)
        for k in range(REPEATED_WINDOW):
            windows = mixed(windows * np.uint64(0x9E3779B97F4A7C15) + hashes[k:len(windows) + k])
        _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
        again = np.flatnonzero(times[which] > 1)
        np.add.at(repeated, again, 1)
        np.add.at(repeated, again + REPEATED_WINDOW, -1)
    repeated = np.cumsum(repeated[:-1]) > 0

    breaks = np.flatnonzero(raw == 10)
    line_of = np.searchsorted(breaks, start)
    lines, first, count = np.unique(line_of, return_index=True, return_counts=True)
    edges = np.concatenate([[-1], breaks, [len(raw)]])
    held = raw.tobytes()
    seen: set[bytes] = set()
    equal = np.zeros(len(lines), bool)
    for k, (a, b) in enumerate(zip(edges[lines] + 1, edges[lines + 1])):
        line = held[a:b]
        equal[k] = line in seen
        seen.add(line)

    # kinds of characters, by line; only one- and two-byte characters have one
    points = np.where(raw < 0x80, raw, 0).astype(np.int64)
    two = np.flatnonzero((raw >= 0xC3) & (raw <= 0xC9))
    points[two] = ((raw[two].astype(np.int64) & 0x1F) << 6) | (raw[two + 1] & 0x3F)
    kinds = _KINDS[points]

    def by_line(of_byte: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(of_byte)])
        return total[edges[lines + 1]] - total[edges[lines] + 1]

    line_chars = np.add.reduceat(chars, first)
    echo = np.concatenate([[False], hashes[1:] == hashes[:-1]])
    echo[first] = False
    last = end[np.append(first[1:], n) - 1] - 1
    symbols = by_line(kinds & 1)
    rows = np.column_stack([
        np.ones(len(lines)),
        np.log1p(count) / 3,
        count < 4,
        np.minimum(line_chars / count, 20) / 10,
        symbols / line_chars,
        by_line((kinds >> 1) & 1) / line_chars,
        by_line((kinds >> 2) & 1) / line_chars,
        (kinds[last] >> 3) & 1,
        equal,
        np.add.reduceat(repeated.astype(np.int64), first) / count,
        np.add.reduceat(echo.astype(np.int64), first) / count,
    ]).astype(np.float64)
    # shares above a few percent say the same
    rows[:, 4:7] = np.minimum(rows[:, 4:7] * 4, 1)
    base = Base(n, int(chars.sum()), int((kinds & 1).sum()), int(equal.sum()), int(repeated.sum()))
    return base, rows, count


@dataclass
class Crf:
    """Two states (0 boilerplate, 1 content): weights of features by state, and of transitions."""

    state: np.ndarray
    move: np.ndarray

    def decode(self, rows: np.ndarray) -> np.ndarray:
        """The likeliest states of the lines of one text; on a tie, content."""
        scores = rows @ self.state.T
        gain = (scores[:, 1] - scores[:, 0]).tolist()
        (stay0, to1), (to0, stay1) = self.move.tolist()
        # the lead of the best path that ends in content over the best one that ends in boilerplate
        lead, from_content = 0.0, []
        for k, g in enumerate(gain):
            if k:
                into1, into0 = lead + stay1 >= to1, lead + to0 >= stay0
                from_content.append((into0, into1))
                lead = max(lead + stay1, to1) - max(lead + to0, stay0)
            lead += g
        out = np.empty(len(gain), np.int8)
        state = int(lead >= 0)
        for k in range(len(gain) - 1, -1, -1):
            out[k] = state
            if k:
                state = int(from_content[k - 1][state])
        return out


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 400, rate: float = 0.5) -> np.ndarray:
    w = np.zeros(x.shape[1])
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= rate * 4 * (x.T @ (weight * (p - y)) + 1e-4 * w)
    return w


def fit(texts: list[np.ndarray], good: list[bool], steps: int = 200, rate: float = 0.3) -> Crf:
    """Fit on the feature rows of texts and whether their documents are good."""
    texts, good = zip(*[(t, g) for t, g in zip(texts, good) if len(t)]) \
        if any(map(len, texts)) else ((), ())
    d = len(FEATURES)
    crf = Crf(np.zeros((2, d)), np.zeros((2, 2)))
    if not texts or all(good) or not any(good):
        crf.state[1, 0] = 1.0  # nothing to tell apart: all is content
        return crf
    rows = np.concatenate(texts)
    of_good = np.repeat(np.array(good), [len(t) for t in texts])
    w = _logistic(rows, of_good.astype(float))
    likely = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
    labels = np.where(of_good, likely > 0.1, likely > 0.9).astype(np.int64)

    chains = []
    at = 0
    for t in texts:
        chains += [slice(at + k, at + min(k + FIT_CHAIN, len(t))) for k in range(0, len(t), FIT_CHAIN)]
        at += len(t)
    n, longest = len(chains), FIT_CHAIN
    x = np.zeros((n, longest, d))
    y = np.zeros((n, longest), np.int64)
    real = np.zeros((n, longest), bool)
    for k, chain in enumerate(chains):
        size = chain.stop - chain.start
        x[k, :size], y[k, :size], real[k, :size] = rows[chain], labels[chain], True
    total = real.sum()
    seen_state = np.stack([x[real & (y == s)].sum(0) for s in (0, 1)])
    inner = real[:, 1:]
    seen_move = np.array([[((y[:, :-1] == a) & (y[:, 1:] == b) & inner).sum() for b in (0, 1)]
                          for a in (0, 1)], float)

    def smooth_max(v: np.ndarray, axis: int) -> np.ndarray:
        top = v.max(axis, keepdims=True)
        return np.log(np.exp(v - top).sum(axis)) + top.squeeze(axis)

    first_moment = [np.zeros((2, d)), np.zeros((2, 2))]
    second_moment = [np.zeros((2, d)), np.zeros((2, 2))]
    for step in range(1, steps + 1):
        scores = np.where(real[..., None], x @ crf.state.T, 0)
        forward = np.zeros((n, longest, 2))
        backward = np.zeros((n, longest, 2))
        forward[:, 0] = scores[:, 0]
        for k in range(1, longest):
            there = smooth_max(forward[:, k - 1, :, None] + crf.move, 1) + scores[:, k]
            forward[:, k] = np.where(real[:, k, None], there, forward[:, k - 1])
        for k in range(longest - 2, -1, -1):
            there = smooth_max(crf.move + (scores[:, k + 1] + backward[:, k + 1])[:, None, :], 2)
            backward[:, k] = np.where(real[:, k + 1, None], there, 0)
        whole = smooth_max(forward[:, -1], 1)
        p = np.exp(forward + backward - whole[:, None, None]) * real[..., None]
        pair = np.exp(forward[:, :-1, :, None] + crf.move
                      + (scores[:, 1:] + backward[:, 1:])[:, :, None, :]
                      - whole[:, None, None, None]) * inner[..., None, None]
        slopes = [(seen_state - np.einsum("nls,nld->sd", p, x)) / total - 1e-4 * crf.state,
                  (seen_move - pair.sum((0, 1))) / total - 1e-4 * crf.move]
        for value, slope, m, v in zip((crf.state, crf.move), slopes, first_moment, second_moment):
            m += 0.1 * (slope - m)
            v += 0.01 * (slope ** 2 - v)
            value += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8) \
                * (1 if step < steps // 2 else 0.3)
    return crf


def _rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"quality": batch.quality, "rows": [
            measured(t)[1].astype("<f4").tobytes() for t in batch.text]})


def train(documents: DataFrame, labels: DataFrame) -> Crf:
    """Fit on at most ``FIT_DOCUMENTS`` labelled documents of each quality."""
    known = picked(labels, doc_id="long", quality="int").where("quality IN (0, 1)").distinct()
    by_hash = F.xxhash64("doc_id")
    some = None
    for quality in (0, 1):
        part = known.where(F.col("quality") == quality).orderBy(by_hash, "doc_id") \
            .limit(FIT_DOCUMENTS)
        some = part if some is None else some.union(part)
    texts = picked(documents, doc_id="long", text="string")
    found = texts.join(F.broadcast(some), "doc_id").select("quality", "text", "doc_id") \
        .mapInPandas(_rows_of, "quality int, rows binary").collect()
    found.sort(key=lambda r: (r["quality"], bytes(r["rows"])))  # the same whatever order rows arrive
    return fit([np.frombuffer(r["rows"], "<f4").reshape(-1, len(FEATURES)).astype(float)
                for r in found], [r["quality"] == 1 for r in found])


def _judge(crf: Crf, least: float):
    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.doc_id, batch.text):
                base, rows, count = measured(text)
                states = crf.decode(rows)
                share = float(count[states == 1].sum() / base.n_words) if base.n_words else 0.0
                out.append((doc_id, base.n_words, base.word_chars, base.n_symbols, base.n_dup_lines,
                            base.n_repeat_words, base.failed, not base.failed and share >= least,
                            share, len(states), int(states.sum())))
            yield pd.DataFrame(out, columns=_OUT.replace(",", "").split()[::2])

    return judged


_OUT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
        " n_repeat_words long, base_failed boolean, kept boolean, content_share double,"
        " n_lines long, n_content_lines long")


def quality(documents: DataFrame, labels: DataFrame, least: float = LEAST_CONTENT,
            crf: Crf | None = None) -> DataFrame:
    """Return base counts, ``base_failed``, ``kept``, ``content_share`` and lines of each document.

    Null and empty texts have no words, so ``base_failed`` holds. Without labels of both kinds all
    lines are content. On a tie of two decodings the last undecided line is content. Repeated rows
    give repeated results. Other columns are ignored; rows without a doc_id are left out. An empty
    table gives an empty result. Texts are read whole, however long. Words and lines are compared by a
    64-bit hash: that any two of n different ones of a text are taken for equal has a chance of about
    n ** 2 / 2 ** 65.
    """
    crf = crf or train(documents, labels)
    return picked(documents, doc_id="long", text="string").mapInPandas(_judge(crf, least), _OUT)
