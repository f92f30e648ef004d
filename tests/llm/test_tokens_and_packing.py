import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm.tables import awkward, documents, rows, sentence
from tokenizers import Tokenizer

from signalwatch.llm import arrow_tokens, packing
from signalwatch.llm.tokens import Encoder, default_tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_tokenizer())


def plain(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("remembered", [0, 20, 10**6])
def test_ids_are_those_of_whole_texts(tokenizer, remembered):
    rng = random.Random(1)
    marks = " \n\t\x0b\x85\xa0　 \x1c​abZé1½'s,.!日́"
    texts = ["", None, "<|endoftext|> a", "x, <|endoftext|>", "a  <|endoftext|>\n\n'll", "<|endoftext|", "a  b\n\n c ", sentence(1, 500)] \
        + ["".join(rng.choice(marks) for _ in range(rng.randrange(40))) for _ in range(3000)]
    marks = "  \n'stre09.,!?-(\"\x00\x1f\x7f_^`{~AzÀ×÷øſƀЀҁ҂Ԯ٣²ªǅʰ"
    texts += ["".join(rng.choice(marks) for _ in range(rng.randrange(30))) for _ in range(6000)]
    assert plain(tokenizer, "<|endoftext|> a") == [50256, 257, 2]
    found = list(Encoder(default_tokenizer(), remembered).encode_all(texts))
    assert [f.tolist() for f in found] == [plain(tokenizer, t) for t in texts]


def test_files_hold_every_document(spark, tokenizer):
    texts = awkward() + [(k, sentence(k, k)) for k in range(100, 400)]
    random.Random(2).shuffle(texts)
    files = arrow_tokens.write_sequences(documents(spark, texts).repartition(6), length=64)
    found = arrow_tokens.read_documents(files)
    expected, start = [], 0
    for i, t in sorted((x for x in texts if x[0] is not None), key=lambda x: (x[0], x[1] or "")):
        ids = plain(tokenizer, t)
        expected.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    assert rows(found, "doc_id", "start", "n_tokens", "ids_crc32") == expected
    # any sequence by number, without reading others; masks tell what is real
    row = files.orderBy("task").first()
    sequences = arrow_tokens.SequenceFile(row.sequences_uri)
    assert len(sequences) == row.n_sequences == -(-row.n_ids // 64)
    ids, mask = sequences[len(sequences) - 1]
    assert ids.dtype == np.uint16 and len(ids) == 64 and mask.sum() == (row.n_ids - 1) % 64 + 1
    assert sequences.masked() == row.n_ids and not ids.flags.owndata


def test_no_documents(spark):
    none = documents(spark, {1: "x"}).where("doc_id > 1")
    assert arrow_tokens.read_documents(arrow_tokens.write_sequences(none)).count() == 0
    assert packing.pack(none).count() == 0


def test_pieces_fill_sequences_without_gaps(spark, tokenizer):
    texts = awkward() + [(k, sentence(k, k % 90)) for k in range(100, 500)]
    found = packing.pack(documents(spark, texts).repartition(5), size=128).toPandas()
    ids = [plain(tokenizer, t) for i, t in texts if i is not None]
    expected = []
    for i, x in zip((i for i, _ in texts if i is not None), ids):
        edges = [0, *range(len(x) % 128 or 128, len(x) + 1, 128)]
        expected += [(i, k, a, b - a, crc(x[a:b]))
                     for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(found[names].itertuples(index=False, name=None)) == sorted(expected)
    total = 0
    for _, pieces in found.sort_values("offset").groupby("sequence_id"):
        end = 0
        for p in pieces.itertuples():
            assert p.offset == end
            end += p.length
        assert end <= 128
        total += 1
    assert total <= -(-found.length.sum() // 128) * 1.01 + 1


def fewest(weights, size):
    """The least number of sequences, by trying all ways."""
    best = len(weights)

    def put(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(weights):
            best = len(rooms)
            return
        for j, room in enumerate(rooms):
            if room >= weights[k] and room not in rooms[:j]:
                put(k + 1, rooms[:j] + [room - weights[k]] + rooms[j + 1:])
        put(k + 1, rooms + [size - weights[k]])

    put(0, [])
    return best


def test_dominating_sets_are_part_of_a_best_packing():
    rng = random.Random(7)
    reduced = 0
    for _ in range(400):
        size = rng.choice((10, 13, 20))
        weights = sorted((rng.randrange(1, size + 1) for _ in range(rng.randrange(1, 10))),
                         reverse=True)
        fixed, left = packing.reduce_by_dominance(Counter(weights), size)
        rest = sorted(left.elements(), reverse=True)
        assert sum(n for _, n in fixed) + fewest(rest, size) == fewest(weights, size)
        assert Counter(w for p, n in fixed for w in p * n) + left == Counter(weights)
        assert all(sum(p) <= size for p, _ in fixed)
        reduced += len(weights) - len(rest)
    assert reduced > 800


def least_sequences(counts, size):
    """A lower bound: long pieces share no sequence, and leave just so much room for others."""
    best = 0
    for short in range(size // 2 + 1):
        alone = sum(n for w, n in counts.items() if w > size - short)
        long = {w: n for w, n in counts.items() if size // 2 < w <= size - short}
        rest = sum(w * n for w, n in counts.items() if short <= w <= size // 2)
        room = sum((size - w) * n for w, n in long.items())
        best = max(best, alone + sum(long.values()) + max(0, -(-(rest - room) // size)))
    return best


def test_plans_are_near_the_bound():
    rng = random.Random(8)
    for most in (1, 50, 10**7):
        counts = Counter({w: rng.randrange(most + 1) for w in range(1, 1025)})
        found = packing.plan(counts)
        held = Counter()
        for pattern, n in found:
            assert sum(pattern) <= 1024 and n > 0
            for w in pattern:
                held[w] += n
        assert held == +counts
        assert sum(n for _, n in found) <= least_sequences(counts, 1024) * 1.01 + 3
