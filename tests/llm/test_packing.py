"""Packing against the tokenizers library and a plain best fit."""

import collections
import random
import zlib
from bisect import bisect_left, insort

import numpy as np
import pytest
from tokenizers import Tokenizer

from starloom.llm import bpe, packing, registry
from starloom.llm.common import table

from .conftest import SMALL


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


def plain_pieces(text, library):
    ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
    first = len(ids) % 1024 or 1024
    edges = [0, *range(first, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
    return [(k, a, ids[a:b]) for k, (a, b) in enumerate(zip(edges, edges[1:]))]


def best_fit(lengths, capacity):
    """Number of sequences of best fit decreasing, one piece after the other."""
    gaps, n = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect_left(gaps, length)
        if at < len(gaps):
            gap = gaps.pop(at)
        else:
            gap, n = capacity, n + 1
        insort(gaps, gap - length)
    return n


def check(rows, docs, library):
    expected = collections.Counter(
        (d["doc_id"], k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for d in docs
        for k, start, ids in plain_pieces(d["text"], library)
    )
    found = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert collections.Counter(found) == expected
    by_sequence = collections.defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(by_sequence) == best_fit([r["length"] for r in rows], 1024)


def test_query_against_plain_python(spark, library):
    docs = table(spark, SMALL, "documents").collect()
    check(registry.QUERIES["op13_best_fit_packing"](spark, SMALL).collect(), docs, library)


def test_awkward_rows(awkward, nothing, library):
    check(packing.pack(awkward).collect(), awkward.collect(), library)
    assert packing.pack(nothing).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_supersteps_are_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([16, 100, 1024])
    top = rng.choice([capacity, capacity // 2, max(capacity // 9, 2)])
    lengths = [rng.randint(1, top) for _ in range(rng.randint(1, 3000))] + [top] * 700
    counts = collections.Counter(lengths)
    runs = packing.supersteps(counts, capacity)
    taken, fill = collections.Counter(), collections.defaultdict(list)
    for length, first, n, fit, sequence, offset in runs.tolist():
        assert first == taken[length]
        taken[length] += n
        for k in range(n):
            fill[sequence + k // fit].append((offset + k % fit * length, length))
    assert taken == counts
    for parts in fill.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    assert sorted(fill) == list(range(len(fill)))
    assert len(fill) == best_fit(lengths, capacity)


def test_runs_do_not_grow_with_the_documents():
    few = packing.supersteps({n: 1000 + 7 * n for n in range(1, 1025)}, 1024)
    many = packing.supersteps({n: 10**9 + 7 * n for n in range(1, 1025)}, 1024)
    assert len(many) < 3 * len(few) + 5000


def test_sequences_hold_the_ids(small, library):
    packed = packing.pack(small, keep_ids=True)
    rows = packed.collect()
    full = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    for r in rows:
        part = full[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
        assert part == r["ids"] and zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]


def test_both_encoders_agree(library):
    encoder = packing.encoder(bpe.default_vocabulary())
    assert encoder.fast is not None
    for text in ["a" * 9000, " " * 9000 + "x", "é" * 5000 + " <|endoftext|>  y", "<|endoftext|>x 12 \n\n z"]:
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids
