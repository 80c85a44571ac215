"""Spelling variants against plain Python."""

import collections
import random
import re
import zlib

import pytest

from starloom.llm import registry, variants
from starloom.llm.common import table

MEDIUM = "/root/testdata/sf0.01"


def plain_words(docs):
    upper = str.maketrans(variants.UPPER, variants.LOWER)
    counts = collections.Counter()
    for d in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", d["text"] or ""):
            run = run.translate(upper)
            h = zlib.crc32(f"{'' if d['doc_id'] is None else d['doc_id']}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain_pairs(words):
    """All pairs one edit apart; those that share a deletion or replacement of a letter."""
    places = collections.defaultdict(list)
    for w in words:
        for i in range(len(w)):
            places[w[:i] + w[i + 1 :]].append(w)
        places[w].append(w)
    return {
        (a, b) if (len(a), a) < (len(b), b) else (b, a)
        for group in places.values()
        for k, a in enumerate(group)
        for b in group[:k]
        if one_edit(a, b)
    }


def plain_result(words):
    near = collections.defaultdict(set)
    for a, b in plain_pairs(words):
        near[a].add(b)
        near[b].add(a)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), None if form[w] is None else words[form[w]])
    return out


def as_dict(df):
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_against_plain_python(spark):
    docs = table(spark, MEDIUM, "documents").collect()
    expected = plain_result(plain_words(docs))
    assert sum(v[0] is not None for v in expected.values()) > 5
    assert as_dict(registry.QUERIES["op12_spelling_variants"](spark, MEDIUM)) == expected


@pytest.mark.parametrize("letters, threshold", [("abc", 20), ("abé", 3), ("aab", 500)])
def test_pairs_in_dense_vocabularies(spark, letters, threshold):
    rng = random.Random(len(letters) + threshold)
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(6, 9))) for _ in range(700)})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    found = {(r["a"], r["b"]) for r in variants.near_pairs(df, threshold).collect()}
    assert found == plain_pairs(words)


def test_bound_holds_for_every_edit():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(6, 12))) for _ in range(300)]
    grams = {w[i : i + k] for w in words[:60] for k in (3, 4, 5) for i in range(len(w) - k + 1) if rng.random() < 0.5}
    split = variants.Decomposer(grams)
    for word in words:
        own = split.decompose(word)
        bound = split.affected(word, own)
        i, kind = rng.randrange(len(word)), rng.randrange(3)
        edited = word[:i] + rng.choice("abcde") * (kind > 0) + word[i + (kind < 2) :]
        other = collections.Counter(g for _, g in split.decompose(edited))
        shared = sum((collections.Counter(g for _, g in own) & other).values())
        assert shared >= len(own) - bound


def test_words_without_a_bound_are_joined_by_deletions(spark, monkeypatch):
    monkeypatch.setattr(variants.Decomposer, "affected", lambda self, word, grams: len(grams))
    words = ["abcdef", "abcdeg", "bcdefa", "zzzzzz", "zzzzzzz", "abcdefg"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    assert {(r["a"], r["b"]) for r in variants.near_pairs(df).collect()} == plain_pairs(words)


def test_dictionary_is_bounded(spark):
    rng = random.Random(1)
    words = {"".join(rng.choice("aaaaabc") for _ in range(8)) for _ in range(2000)}
    df = spark.createDataFrame([(w,) for w in words], "word string")
    assert 0 < len(variants.dictionary(df, 1, 300)) <= 300


def test_roots_follow_long_chains(spark):
    chain = [(f"w{i:03d}", f"w{i + 1:03d}") for i in range(40)] + [("w040", None), ("x", None)]
    found = variants.roots(spark.createDataFrame(chain, "word string, form string")).collect()
    assert {r["word"]: r["root"] for r in found} == {**{w: "w040" for w, _ in chain}, "x": "x"}


def test_awkward_rows(spark, awkward, nothing):
    rows = [(i, "Straßen strassen élèveß ÷×öüäÿ STRASSEN ", "straße " * 3) for i in range(6)]
    rows += [(None, "strassen strassem", None), (None, None, "x"), (3, "", "x"), (4, "Strassen " * 40_000, "x")]
    rows += rows[:2]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string")
    assert as_dict(variants.group(docs)) == plain_result(plain_words(docs.collect()))
    assert as_dict(variants.group(awkward)) == plain_result(plain_words(awkward.collect()))
    assert variants.group(nothing).count() == 0
