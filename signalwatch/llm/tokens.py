"""Token ids of whole texts, with the ids of pieces that occurred before remembered."""

from __future__ import annotations

import json
import os
import re
import sys
import types
from collections.abc import Iterable, Iterator
from itertools import chain, islice, repeat

import numpy as np

#: Appended to each document.
END_ID = 2
#: Pieces whose ids a process remembers; changes no result.
REMEMBERED = 600_000
#: Characters of text that are worked on together.
_TOGETHER = 400_000
#: Pieces that are encoded as one text.
_JOINED = 100
_LAST = object()

# White space as tokenizers' pre-tokenizer counts it. It never joins a character that is not white
# space to one that is and follows, so a text may be cut there without changing its ids.
_WHITE = "\t-\r \x85\xa0  -     　"
_WHITES = frozenset(c for c in map(chr, range(0x3001)) if re.match(f"[{_WHITE}]", c))
_WORDS = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
# Byte-level tokenizers also cut words, before they merge bytes: letters, digits and other characters
# never join, except for an apostrophe and what follows it. Runs of Latin or Cyrillic letters, of ASCII
# digits and of ASCII signs are therefore pieces of their own where an ASCII character of another kind
# (or the text's end, or white space) follows; any other rest of a word is one piece.
_LETTER = "A-Za-zÀ-ÖØ-öø-ſЀ-ҁҊ-ԯ"
_SIGN = "!-/:-@\\[-`{-~"
_PIECES = re.compile(
    f"[{_WHITE}]*(?:[{_LETTER}]+(?=[\x00-@\\[-`{{-\x7f{_WHITE}]|\\Z)"
    f"|[0-9]+(?=[\x00-/:-\x7f{_WHITE}]|\\Z)"
    f"|[{_SIGN}]*[{_SIGN.replace('!-/', '!-&(-/')}](?=[{_LETTER}0-9{_WHITE}]|\\Z)"
    f"|[^{_WHITE}]+)|[{_WHITE}]+")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Gives texts' ids as tokenizers does; special tokens are not added, but found in a text."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        described = json.loads(self._tokenizer.to_str())
        cut = described["pre_tokenizer"] or {}
        byte_level = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) \
            and described["normalizer"] is None
        self._pieces = _PIECES if byte_level else _WORDS
        self._n_bytes = None  # of each token, where characters of tokens stand for bytes
        if byte_level:
            vocabulary = self._tokenizer.get_vocab()
            self._n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
            self._n_bytes[list(vocabulary.values())] = list(map(len, vocabulary))
        self._special = [t["content"] for t in described["added_tokens"]]
        self._remembered = remembered
        self._known: dict[str, int] = {}
        self._ends = np.zeros(1 << 10, np.int64)  # where the ids of each known piece end
        self._ids = np.empty(1 << 12, np.uint32)

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one, and how many each has."""
        found = [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return (np.fromiter(chain.from_iterable(found), np.uint32),
                np.fromiter(map(len, found), np.int64, len(found)))

    def _encoded_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_encoded``, for pieces. Many are encoded as one text, which costs less than one by one,
        with a line break before those that do not start with white space; where a piece's ids end is
        known from the tokens' bytes."""
        if self._n_bytes is None or any(piece.isspace() for piece in pieces):
            return self._encoded(pieces)
        parts = [piece if piece[0] in _WHITES else "\n" + piece for piece in pieces]
        ids, _ = self._encoded(["".join(parts[k:k + _JOINED]) for k in range(0, len(parts), _JOINED)])
        ends = np.cumsum(np.fromiter((len(p.encode("utf-8", "surrogatepass")) for p in parts), np.int64,
                                     len(parts)))
        behind = np.searchsorted(np.cumsum(self._n_bytes[ids]), ends) + 1
        lengths = np.diff(behind, prepend=0)
        added = np.fromiter((len(p) > len(q) for p, q in zip(parts, pieces)), bool, len(parts))
        kept = np.ones(len(ids), bool)
        kept[(behind - lengths)[added]] = False
        return ids[kept], lengths - added

    def _append(self, pieces: list[str]) -> None:
        """Put the ids of new pieces behind those of the known ones."""
        ids, lengths = self._encoded_pieces(pieces)
        n = len(self._known)
        used = self._ends[n]
        self._ends = _with_room(self._ends, n + 1 + len(pieces))
        self._ids = _with_room(self._ids, used + len(ids))
        self._ends[n + 1:n + 1 + len(pieces)] = used + np.cumsum(lengths)
        self._ids[used:used + len(ids)] = ids

    def _together(self, texts: list[str]) -> list[np.ndarray]:
        pieces = [self._pieces.findall(text) for text in texts]
        count = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = list(chain.from_iterable(pieces))
        places = np.fromiter(map(self._known.get, flat, repeat(-1)), np.int64, len(flat))
        missing = np.flatnonzero(places < 0)
        if len(missing):
            unknown = [flat[k] for k in missing]
            new = list(dict.fromkeys(unknown))
            n = len(self._known)
            self._append(new)
            place = dict(zip(new, range(n, n + len(new))))
            places[missing] = [place[piece] for piece in unknown]
            # when as many are known as may be, the next new pieces take these places
            self._known.update(islice(place.items(), max(0, self._remembered - n)))
        start = self._ends[places]
        behind = np.concatenate([[0], np.cumsum(self._ends[places + 1] - start)])
        at = np.repeat(start - behind[:-1], np.diff(behind)) + np.arange(behind[-1])
        return np.split(self._ids[at], behind[np.cumsum(count)[:-1]])

    def _all_ids(self, texts: list[str]) -> Iterator[np.ndarray]:
        whole = [any(name in text for name in self._special) for text in texts]
        known = iter(self._together([t for t, w in zip(texts, whole) if not w] or [""]))
        for text, w in zip(texts, whole):
            yield self._encoded([text])[0] if w else next(known)

    def encode_all(self, texts: Iterable[str | None], end: bool = True) -> Iterator[np.ndarray]:
        """The ids of each text (null: empty), by default with the end id behind them."""
        tail = np.full(int(end), END_ID, np.uint32)
        waiting: list[str] = []
        size = 0
        for text in chain(texts, (_LAST,)):
            if text is not _LAST:
                waiting.append(text or "")
                size += len(waiting[-1])
            if waiting and (text is _LAST or size >= _TOGETHER):
                for ids in self._all_ids(waiting):
                    yield np.concatenate([ids, tail])
                waiting, size = [], 0


def _with_room(values: np.ndarray, n: int) -> np.ndarray:
    """An array of at least ``n`` places, twice as many if it has to grow."""
    if n <= len(values):
        return values
    grown = np.empty(max(n, 2 * len(values)), values.dtype)
    grown[:len(values)] = values
    return grown


def encoder(path: str) -> Encoder:
    """The encoder of this process: a worker that Spark reuses still knows its pieces.

    This module travels to executors by value, anew for each task, so what a process keeps lies
    beside it, under a name of its own.
    """
    kept = sys.modules.setdefault("_signalwatch_kept", types.ModuleType("_signalwatch_kept"))
    encoders = kept.__dict__.setdefault("encoders", {})
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]
