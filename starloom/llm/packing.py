"""Best-fit packing of tokenised documents into sequences of bounded length.

1. Each whole text is encoded in its task and closed by the end token. A document longer
   than ``capacity`` is cut into pieces of that length, the first one shorter if the
   length does not divide. Nothing else is cut.
2. Pieces are range-sorted by length and numbered without a shuffle to one place, so
   each has a rank among the pieces of its length, whatever share of all has it.
3. Supersteps go from the longest length down. In each, all pieces of one length sweep
   to their successors, the smallest gaps that hold them; where several want a gap, the
   lower rank takes it, and a gap takes as many of them as fit. Then the gaps are
   updated, and what found none opens new sequences. Best fit never tells pieces of a
   length or sequences of a gap apart, so a superstep works on runs: so many pieces from
   a rank on against so many sequences of equal gap from a number on. Lengths and gaps
   are at most ``capacity``; so runs are bounded by it, at any number of documents.
4. Each piece looks its run up by length and rank, in its task.

The result is that of best fit decreasing over all pieces, in one shuffle of narrow rows.

NULL texts count as empty: the end token alone. NULL ids stay NULL. Repeated rows are
packed each for itself. Very long texts are encoded whole. An empty table gives none.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import bpe
from starloom.llm.common import materialize, text_or_empty, texts_of
from starloom.operators.keys import with_dense_id

CAPACITY = 1024
END_ID = 2
# Beyond so many bytes between white space, or of white space, the merge loop of the
# fast encoder is quadratic; such texts go to the other one, with equal results.
LONG_RUN = re.compile(r"\S{4000}|\s{4000}")
RANK_BITS = 45


# --- tokens ----------------------------------------------------------------------


class Encoder:
    """Token ids of whole texts, as the vocabulary file says."""

    def __init__(self, path: str):
        self.codec = bpe.codec(path)
        merged = self.codec.merged
        self.fast = None
        # The fast encoder merges by token id; that must be the order of the merges.
        if all(a < b for a, b in zip(merged, merged[1:])) and max(self.codec.byte_ids) < merged[0]:
            added = set(self.codec.added.values())
            self.fast = tiktoken.Encoding(
                "packing",
                pat_str=bpe.WORDS.pattern,
                mergeable_ranks={t: i for i, t in self.codec.table.items() if i not in added},
                special_tokens=self.codec.added,
            )

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or LONG_RUN.search(text):
            return np.frombuffer(self.codec.encode_bytes(text), "<u4")
        return self.fast.encode_to_numpy(text, allowed_special="all")


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cuts(length: int, capacity: int) -> list[int]:
    """Starts of a document's pieces, and its end."""
    return sorted({0, *range(length, 0, -capacity)})


PIECES = T.ArrayType(
    T.StructType(
        [
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
        ]
    )
)


def pieces(text: Column, vocabulary: str, capacity: int, end_id: int, keep_ids: bool) -> Column:
    """The pieces of each text; ``ids`` is NULL unless kept."""

    @F.arrow_udf(PIECES)
    def cut(texts: pa.Array) -> pa.Array:
        ends, starts, lengths, crcs, kept, places = [0], [], [], [], [], []
        for text in texts_of(texts):
            ids = np.append(encoder(vocabulary).ids(text), np.uint32(end_id))
            edges = cuts(len(ids), capacity)
            for place, (start, end) in enumerate(zip(edges, edges[1:])):
                part = ids[start:end]
                places.append(place)
                starts.append(start)
                lengths.append(end - start)
                crcs.append(zlib.crc32(part.tobytes()))
                kept.append(part.astype("<i4") if keep_ids else None)
            ends.append(len(starts))
        fields = [
            pa.array(places, pa.int32()),
            pa.array(starts, pa.int64()),
            pa.array(lengths, pa.int64()),
            pa.array(crcs, pa.int64()),
            pa.array(kept, pa.list_(pa.int32())),
        ]
        rows = pa.StructArray.from_arrays(fields, PIECES.elementType.names)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)

    return cut(text)


# --- supersteps ------------------------------------------------------------------


def supersteps(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Runs of matches, rows of (length, first rank, pieces, pieces to a sequence, first
    sequence, offset), by length and rank. ``counts``: pieces of each length.

    The state is the gaps, as runs of sequences (gap, first sequence, sequences).
    """
    gaps: list[tuple[int, int, int]] = []
    runs: list[tuple[int, int, int, int, int, int]] = []
    opened = 0

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        updated: list[tuple[int, int, int]] = []

        def match(gap: int, first: int, n: int, fit: int) -> None:
            nonlocal rank, left
            runs.append((length, rank, n * fit, fit, first, capacity - gap))
            rank, left = rank + n * fit, left - n * fit
            if gap > fit * length:
                updated.append((gap - fit * length, first, n))

        def fill(gap: int, first: int, n: int) -> int:
            """Sequences of the run that take pieces."""
            fit = gap // length
            whole = min(n, left // fit)
            if whole:
                match(gap, first, whole, fit)
            # The last pieces share one more sequence.
            if whole < n and left:
                match(gap, first + whole, 1, left)
                whole += 1
            return whole

        at = bisect_left(gaps, (length,))
        swept = at
        while swept < len(gaps) and left:
            gap, first, n = gaps[swept]
            taken = fill(gap, first, n)
            if taken < n:
                updated.append((gap, first + taken, n - taken))
            swept += 1
        del gaps[at:swept]
        if left:
            opened += fill(capacity, opened, left)
        for gap in updated:
            insort(gaps, gap)
    return np.array(sorted(runs), dtype=np.int64).reshape(-1, 6)


PLACE = T.StructType(
    [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
)


def placed(df: DataFrame, runs: np.ndarray) -> Column:
    """Sequence and offset of each (length, rank)."""
    shared = df.sparkSession.sparkContext.broadcast(runs)

    @F.arrow_udf(PLACE)
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        runs = shared.value
        size, own = length.to_numpy(), rank.to_numpy()
        keys = (runs[:, 0] << RANK_BITS) | runs[:, 1]
        run = runs[np.searchsorted(keys, (size << RANK_BITS) | own, side="right") - 1]
        ahead = own - run[:, 1]
        fit = run[:, 3]
        return pa.StructArray.from_arrays(
            [pa.array(run[:, 4] + ahead // fit), pa.array(run[:, 5] + ahead % fit * size)], PLACE.names
        )

    return place(F.col("length"), F.col("rank"))


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and the
    token ids if ``keep_ids``."""
    cut = pieces(text_or_empty(text_col), vocabulary or bpe.default_vocabulary(), capacity, end_id, keep_ids)
    # Every text has a piece. ``inline`` would filter for that, and encode twice.
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), cut.alias("p"))
    rows = rows.select("doc_id", F.inline_outer("p"))
    if not keep_ids:
        rows = rows.drop("ids")
    cut_rows = materialize(rows, "pieces")
    sorted_rows = with_dense_id(cut_rows, ["length"], "position", start=0)
    # One row per length: ``capacity`` at most.
    counts = {r["length"]: r["count"] for r in cut_rows.groupBy("length").count().collect()}
    runs = supersteps(counts, capacity)
    before, first = 0, [0] * (capacity + 1)
    for length in sorted(counts):
        first[length], before = before, before + counts[length]
    firsts = F.array(*map(F.lit, first))
    ranked = sorted_rows.withColumn(
        "rank", F.col("position") - F.element_at(firsts, F.col("length").cast("int") + 1)
    )
    return ranked.withColumn("place", placed(ranked, runs)).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "place.*", *(["ids"] if keep_ids else [])
    )


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids: the sequences of ``pack(..., keep_ids=True)``. A sequence holds
    ``capacity`` tokens at most, so the groups are bounded."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids")
    )
