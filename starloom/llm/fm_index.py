"""Benchmark decontamination with one FM-index per shard of training text.

A shard is a run of whole documents of at most ``SHARD_WORDS`` words (a longer
document spreads over several shards that overlap by a phrase). Its words are numbered
by the shard's own vocabulary, a separator stands behind each document; the numbers are
sorted by suffix, the Burrows-Wheeler transform goes into a wavelet matrix, and every
``SAMPLE``-th suffix position is kept. The index knows nothing of the benchmark.

Benchmark items come in blocks of ``BLOCK_BYTES``, each a broadcast of bounded size that
executors keep on disk; the driver makes one after the other and a task holds one at a
time. A task indexes ``SHARDS_HELD`` shards, each once, and goes through the blocks: their words are
translated to the shard's, phrases with other words drop out, and all that are left are
searched backward at once; each step costs two ranks per phrase still alive.
Occurrences are located by walking to a sampled position, and overlapping ones of all
blocks merged into removal spans. One pass and one plan, however many blocks.

An item whose phrases would be of different length than ``window`` words (it has fewer)
is one phrase. NULL and empty texts have no words and are never contaminated; items
without words have no phrases; equal items are all reported. The windows of an item
whose id is NULL count as hits, but there is no id to report. Repeated documents are
searched each for itself; very long ones whole. Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import fresh, slices, text_or_empty

WINDOW = 13
SHARD_WORDS = 400_000
SHARDS_HELD = 4
SAMPLE = 16
BLOCK_BYTES = 8 << 20
# Words are ASCII digits and letters, and everything beyond ASCII.
LOWER = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)

HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("starts", T.ArrayType(T.LongType())),
        T.StructField("ends", T.ArrayType(T.LongType())),
    ]
)


def words_of(data: bytes) -> list[bytes]:
    return data.translate(LOWER).split()


# --- the index -------------------------------------------------------------------


def suffix_array(text: np.ndarray, alphabet: int) -> np.ndarray:
    """Positions in order of their suffixes, by prefix doubling.

    The first round packs as many symbols into a key as 62 bits hold; later ones
    sort only suffixes that still tie, so copies cost rounds over the copies alone.
    """
    n = len(text)
    bits = int(alphabet + 1).bit_length()
    reach = 1
    key = text.astype(np.int64) + 1
    while 2 * reach * bits <= 62:
        shifted = np.zeros(n, dtype=np.int64)
        shifted[: max(n - reach, 0)] = key[reach:]
        key = (key << (reach * bits)) | shifted
        reach *= 2
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.ones(n, dtype=bool)
    first[1:] = key[1:] != key[:-1]
    place = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = place
    tied = np.flatnonzero(~(first & np.append(first[1:], True)))
    while len(tied):
        at = order[tied]
        ahead = at + reach
        following = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[at] * (n + 1) + following
        sort = np.argsort(key, kind="stable")
        at, key = at[sort], key[sort]
        order[tied] = at
        first = np.ones(len(tied), dtype=bool)
        first[1:] = key[1:] != key[:-1]
        rank[at] = tied[np.maximum.accumulate(np.where(first, np.arange(len(tied)), 0))]
        tied = tied[~(first & np.append(first[1:], True))]
        reach *= 2
    return order


class WaveletMatrix:
    """Rank and access over a sequence, one bit per level."""

    def __init__(self, sequence: np.ndarray, alphabet: int):
        self.bits = max(1, int(alphabet).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in reversed(range(self.bits)):
            bit = (sequence >> level) & 1
            before = np.zeros(len(bit) + 1, dtype=np.int32)
            np.cumsum(bit, out=before[1:])
            self.ones.append(before)
            self.zeros.append(len(bit) - int(before[-1]))
            set_ = bit.astype(bool)
            sequence = np.concatenate([sequence[~set_], sequence[set_]])

    def ranks(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Occurrences of each symbol before ``low`` and before ``high``."""
        start = np.zeros_like(low)
        for depth, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = ((symbols >> (self.bits - 1 - depth)) & 1).astype(bool)
            start, low, high = (
                np.where(bit, zeros + ones[i], i - ones[i]) for i in (start, low, high)
            )
        return low - start, high - start

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and its occurrences before that place."""
        symbol, start = np.zeros_like(at), np.zeros_like(at)
        for ones, zeros in zip(self.ones, self.zeros):
            bit = (ones[at + 1] - ones[at]).astype(bool)
            start, at = (np.where(bit, zeros + ones[i], i - ones[i]) for i in (start, at))
            symbol = (symbol << 1) | bit
        return symbol, at - start


class FMIndex:
    def __init__(self, text: np.ndarray, alphabet: int, sample: int = SAMPLE):
        """``text``: symbols 0 to ``alphabet``; one end mark is added."""
        text = np.append(text.astype(np.int64) + 1, 0)
        order = suffix_array(text, alphabet + 1)
        transformed = text[order - 1]
        self.less = np.zeros(alphabet + 3, dtype=np.int64)
        np.cumsum(np.bincount(text, minlength=alphabet + 2), out=self.less[1:])
        self.matrix = WaveletMatrix(transformed, alphabet + 1)
        kept = order % sample == 0
        self.kept = kept
        self.kept_before = np.cumsum(kept) - kept
        self.positions = order[kept]
        self.size = len(text)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of suffixes that begin with each row of ``phrases``."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.size, dtype=np.int64)
        alive = np.arange(len(phrases))
        for column in reversed(range(phrases.shape[1])):
            symbols = phrases[alive, column].astype(np.int64) + 1
            down, up = self.matrix.ranks(symbols, low[alive], high[alive])
            low[alive], high[alive] = self.less[symbols] + down, self.less[symbols] + up
            alive = alive[low[alive] < high[alive]]
            if not len(alive):
                break
        dead = np.ones(len(phrases), dtype=bool)
        dead[alive] = False
        high[dead] = low[dead]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each suffix, by steps to a sampled one."""
        found = np.zeros(len(rows), dtype=np.int64)
        steps, left, at = 0, np.arange(len(rows)), rows.astype(np.int64)
        while len(left):
            done = self.kept[at]
            found[left[done]] = self.positions[self.kept_before[at[done]]] + steps
            left, at = left[~done], at[~done]
            symbol, before = self.matrix.symbol_and_rank(at)
            at = self.less[symbol] + before
            steps += 1
        return found


# --- the benchmark ---------------------------------------------------------------


@dataclass
class Phrases:
    """Windows of a block of items: distinct words, phrases by length as numbers of
    words, and per phrase the items that hold it, as ranges of one array."""

    words: list[bytes]
    lengths: dict[int, np.ndarray]
    owner_ends: dict[int, np.ndarray]
    owners: dict[int, np.ndarray]
    items: list[str | None]

    @classmethod
    def of(cls, items: list[tuple[str | None, str]], window: int = WINDOW) -> Phrases:
        numbers: dict[bytes, int] = {}
        seen: dict[tuple[int, ...], dict[int, None]] = {}
        names = [item for item, _ in items]
        for item, (_, text) in enumerate(items):
            ids = [numbers.setdefault(w, len(numbers)) for w in words_of((text or "").encode("utf-8"))]
            length = min(window, len(ids))
            for start in range(len(ids) - length + 1 if ids else 0):
                seen.setdefault(tuple(ids[start : start + length]), {})[item] = None
        lengths, ends, owners = {}, {}, {}
        for length in {len(p) for p in seen}:
            phrases = [p for p in seen if len(p) == length]
            lengths[length] = np.array(phrases, dtype=np.int64)
            ends[length] = np.cumsum([0, *(len(seen[p]) for p in phrases)])
            owners[length] = np.array([i for p in phrases for i in seen[p]], dtype=np.int64)
        return cls(list(numbers), lengths, ends, owners, names)


def item_blocks(items: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator:
    """The items in blocks of about ``block_bytes``, each a list of (id, text), read
    one after the other. There is one at least."""
    slim = items.select(
        F.col(f"`{item_col}`").cast("string").alias("item"), text_or_empty(text_col).alias("text")
    )
    total = slim.agg(F.sum(F.octet_length("text") + F.lit(16))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    for block in range(blocks):
        part = slim
        if blocks > 1:
            part = slim.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        yield [(r["item"], r["text"]) for r in part.collect()]


# --- search ----------------------------------------------------------------------


class Shard:
    """The index of a run of documents, and what has been found in them."""

    def __init__(self, texts: list[bytes], shard_words: int, overlap: int):
        self.numbers: dict[bytes, int] = {}
        number = self.numbers.setdefault
        per_doc = [[number(w, len(self.numbers) + 1) for w in words_of(t)] for t in texts]
        self.sizes = [len(ids) for ids in per_doc]
        text = np.zeros(sum(self.sizes) + len(self.sizes), dtype=np.int64)
        starts, at = [], 0
        for ids in per_doc:
            starts.append(at)
            text[at : at + len(ids)] = ids
            at += len(ids) + 1  # the separator behind each document
        self.starts = np.array(starts, dtype=np.int64)
        # More than one part only if a document alone is larger than a shard.
        self.parts = [
            (begin, FMIndex(text[begin : begin + shard_words + overlap], len(self.numbers)))
            for begin in range(0, len(text), shard_words)
            if text[begin : begin + shard_words + overlap].any()
        ]
        self.edges = np.zeros(len(text) + 1, dtype=np.int32)
        self.items: dict[int, set[str]] = {}
        self.hit: set[int] = set()

    def search(self, phrases: Phrases) -> None:
        known = np.array([self.numbers.get(w, 0) for w in phrases.words], dtype=np.int64)
        for length, numbered in phrases.lengths.items():
            wanted = known[numbered]
            alive = np.flatnonzero(wanted.all(axis=1))
            if not len(alive):
                continue
            for begin, index in self.parts:
                low, high = index.search(wanted[alive])
                count = high - low
                if not count.any():
                    continue
                phrase = np.repeat(alive, count)
                offset = np.arange(len(phrase)) - np.repeat(np.cumsum(count) - count, count)
                position = begin + index.locate(np.repeat(low, count) + offset)
                self._add(position, length, phrase, phrases)

    def _add(self, position: np.ndarray, length: int, phrase: np.ndarray, phrases: Phrases) -> None:
        np.add.at(self.edges, position, 1)
        np.add.at(self.edges, position + length, -1)
        doc = np.searchsorted(self.starts, position, side="right") - 1
        ends, owners = phrases.owner_ends[length], phrases.owners[length]
        for d, p in np.unique(np.stack([doc, phrase], 1), axis=0).tolist():
            self.hit.add(d)
            names = {phrases.items[i] for i in owners[ends[p] : ends[p + 1]]}
            self.items.setdefault(d, set()).update(n for n in names if n is not None)

    def rows(self) -> list[tuple]:
        """A ``HITS`` row per text. Spans count words, end exclusive."""
        covered = np.cumsum(self.edges) > 0
        rows = []
        for doc, (start, size) in enumerate(zip(self.starts.tolist(), self.sizes)):
            if doc not in self.hit:
                rows.append((size, 0, [], [], []))
                continue
            edge = np.diff(np.concatenate([[0], covered[start : start + size], [0]]).astype(np.int8))
            begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            found = sorted(self.items.get(doc, ()))
            rows.append((size, int((ends - begins).sum()), found, begins.tolist(), ends.tolist()))
        return rows


def document_hits(texts: list[bytes], blocks: list[Phrases], shard_words: int = SHARD_WORDS) -> list[tuple]:
    """A ``HITS`` row per text of one shard."""
    overlap = max((max(b.lengths, default=1) - 1 for b in blocks), default=0)
    shard = Shard(texts, shard_words, overlap)
    for phrases in blocks:
        shard.search(phrases)
    return shard.rows()


def _search(docs: DataFrame, text_col: str, name: str, shared: list, window: int, shard_words: int) -> DataFrame:
    columns, place = docs.columns, docs.columns.index(text_col)
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.string())] + [pa.list_(pa.int64())] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.RecordBatch, Shard]] = []

        def finished() -> Iterator[pa.RecordBatch]:
            for block in shared:
                phrases = block.value
                for _, shard in held:
                    shard.search(phrases)
                if len(shared) > 1:
                    del block._value  # read again from the executor's disk next time
            for part, shard in held:
                arrays = [pa.array(list(c), kind) for c, kind in zip(zip(*shard.rows()), kinds)]
                hits = pa.StructArray.from_arrays(arrays, HITS.names)
                yield pa.RecordBatch.from_arrays([*part.columns, hits], [*columns, name])
            held.clear()

        for batch in batches:
            data = [(t or "").encode("utf-8") for t in batch.column(place).to_pylist()]
            for start, end in slices([len(t) // 5 + 1 for t in data], shard_words):
                part = batch.slice(start, end - start)
                held.append((part, Shard(data[start:end], shard_words, window - 1)))
                # With one block there is nothing to hold shards for.
                if len(held) >= (SHARDS_HELD if len(shared) > 1 else 1):
                    yield from finished()
        if held:
            yield from finished()

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, HITS)]))


def find(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> tuple[DataFrame, str]:
    """``docs`` with a column of ``HITS``, and that column's name.

    Documents pass through in their tasks; nothing is shuffled or joined.
    """
    context = docs.sparkSession.sparkContext
    shared = [
        context.broadcast(Phrases.of(block, window))
        for block in item_blocks(items, item_col, item_text_col, block_bytes)
    ]
    (name,) = fresh(docs, "hits")
    return _search(docs, text_col, name, shared, window, shard_words), name


def contaminated(hits) -> F.Column:
    """A twentieth of the words or more are hit."""
    return (hits["n_hit"] > 0) & (20 * hits["n_hit"] >= hits["n_words"])
