"""Near duplicates: a Jaccard join over word n-grams by chosen paths.

1. A text's set is its windows of ``WORDS`` words (all its words, if fewer), hashed.
   Texts of equal sets form a class; one representative of each goes on.
2. Each representative has ``COORDINATES`` min-hashes. In every run it walks a tree
   whose nodes each choose one coordinate, a quarter of them two, by a hash of the
   node; the sets in a node split by their min-hash there, that is on a sampled
   shared token. Nodes of at most ``LEAF`` sets are not split further; deeper than
   ``DEPTH`` none is. Runs repeat until a pair at the threshold is met in one of them
   with probability ``RECALL``.
3. Each set goes to its leaves with the sorted list of them, and a pair is judged in the
   smallest leaf that both lists hold: once, whatever number of runs it met in. Leaves
   are compared by brute force, large ones in pairs of blocks, bounded in sets and in
   tokens. The min-hashes rule out pairs far below the threshold. Texts are sent only to
   leaves where a candidate is left, and there the rest are verified over the exact sets.
   Links are counted and joined to stars there: no pair and no list of partners leaves a
   task.
4. Groups are the connected components of the stars.

Words are runs of anything but ASCII white space. NULL counts as the empty text;
texts without words are one class without links to others. The result has a row for
every row of the input, in no order, repeated rows and ids included. Very long texts are
taken whole; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import (
    fresh,
    materialize,
    mix,
    replicate,
    text_or_empty,
    texts_of,
    word_hashes,
)

WORDS = 5
THRESHOLD = 0.8
COORDINATES = 128
SLACK = 0.13  # how far the min-hash estimate may lie below the threshold
LEAF = 64
BLOCK = 1024  # sets
BLOCK_TOKENS = 4_000_000
DEPTH = 4
RECALL = 0.9999

_RANDOM = np.random.default_rng(20_240_101)
_FACTOR = _RANDOM.integers(1, 1 << 32, COORDINATES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_OFFSET = _RANDOM.integers(0, 1 << 32, COORDINATES, dtype=np.uint64).astype(np.uint32)


# --- sets and paths --------------------------------------------------------------


def shingles(data: bytes, words: int = WORDS) -> np.ndarray:
    """Distinct hashes of the text's windows, sorted."""
    hashes = word_hashes(data)
    n = min(words, len(hashes))
    if not n:
        return hashes
    window = hashes[: len(hashes) - n + 1].copy()
    for k in range(1, n):
        window = mix(window) + hashes[k : len(hashes) - n + 1 + k]
    return np.unique(mix(window))


def signature(tokens: np.ndarray) -> np.ndarray:
    small = (tokens >> np.uint64(32)).astype(np.uint32)
    least = np.full(COORDINATES, 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(small), 2048):
        part = small[None, start : start + 2048] * _FACTOR[:, None] + _OFFSET[:, None]
        part ^= part >> np.uint32(15)
        part *= np.uint32(0x2C1B3C6D)
        np.minimum(least, part.min(axis=1), out=least)
    return least


def meeting(threshold: float, depth: int) -> float:
    """Least probability that a pair at the threshold shares a leaf of one run."""
    p = 1.0
    for _ in range(depth):
        x = threshold * p
        p = 0.75 * x + 0.25 * (1 - (1 - x) ** 2)
    return p


def runs_for(recall: float, threshold: float, depth: int = DEPTH) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - meeting(threshold, depth)))


def children(nodes: np.ndarray, sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Child nodes of each (node, sketch) pair, and the pair each comes from."""
    choice = mix(nodes ^ np.uint64(0xA5A5A5A5DEADBEEF))
    first = (choice & np.uint64(0xFFFF)) % np.uint64(COORDINATES)
    twice = (choice >> np.uint64(32)) & np.uint64(3) == 0
    step = np.uint64(1) + ((choice >> np.uint64(16)) & np.uint64(0xFFFF)) % np.uint64(COORDINATES - 1)
    at = np.concatenate([np.arange(len(nodes)), np.flatnonzero(twice)])
    coordinate = np.concatenate([first, ((first + step) % np.uint64(COORDINATES))[twice]])
    value = sketches[at, coordinate.astype(np.int64)].astype(np.uint64)
    return mix(mix(nodes[at] * np.uint64(COORDINATES) + coordinate) + value), at


SKETCH = T.StructType(
    [
        T.StructField("set", T.BinaryType()),
        T.StructField("n", T.LongType()),
        T.StructField("sketch", T.BinaryType()),
    ]
)


def sketch(text: Column, words: int) -> Column:
    """Digest of the set, its size, its min-hashes."""

    @F.arrow_udf(SKETCH)
    def sketches(texts: pa.Array) -> pa.Array:
        digests, sizes, out = [], [], []
        for text in texts_of(texts):
            tokens = shingles(text.encode("utf-8"), words)
            digests.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
            sizes.append(len(tokens))
            out.append(signature(tokens).tobytes())
        return pa.StructArray.from_arrays(
            [pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(out, pa.binary())],
            SKETCH.names,
        )

    return sketches(text)


def token_set(text: Column, words: int) -> Column:
    @F.arrow_udf(T.BinaryType())
    def sets(texts: pa.Array) -> pa.Array:
        return pa.array(
            [shingles(t.encode("utf-8"), words).tobytes() for t in texts_of(texts)], pa.binary()
        )

    return sets(text)


def _grouped(lists: list[np.ndarray], at: np.ndarray, rows: int) -> pa.Array:
    order = np.argsort(at, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=rows))]).astype("int32")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(lists[order].view(np.int64)))


def first_nodes(sketches: Column, runs: int) -> Column:
    roots = mix(np.arange(1, runs + 1, dtype=np.uint64))

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def nodes(column: pa.Array) -> pa.Array:
        rows = np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)
        child, at = children(np.tile(roots, len(rows)), np.repeat(rows, runs, axis=0))
        return _grouped(child, at // runs, len(rows))

    return nodes(sketches)


def next_nodes(nodes: Column, sketches: Column) -> Column:
    """The children of all of a set's nodes."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def below(column: pa.Array, sketch_column: pa.Array) -> pa.Array:
        rows = np.frombuffer(b"".join(sketch_column.to_pylist()), np.uint32).reshape(-1, COORDINATES)
        owner = np.repeat(np.arange(len(rows)), np.asarray(column.value_lengths()))
        parents = np.asarray(column.flatten()).astype(np.int64).view(np.uint64)
        child, at = children(parents, rows[owner])
        return _grouped(child, owner[at], len(rows))

    return below(nodes, sketches)


def brief(sketches: Column) -> Column:
    """The lowest byte of each min-hash: equal ones stay equal, and of different ones
    one in 256 seems equal. Enough to rule pairs out, in a quarter of the bytes."""

    @F.arrow_udf(T.BinaryType())
    def lowest(column: pa.Array) -> pa.Array:
        rows = np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)
        return pa.array([row.tobytes() for row in rows.astype(np.uint8)], pa.binary())

    return lowest(sketches)


# --- leaves ----------------------------------------------------------------------


def leaves(sets: DataFrame, runs: int, leaf: int, depth: int) -> tuple[DataFrame, DataFrame]:
    """(rep, leaves), the sorted leaves of each set that shares one; (node, size) of all
    leaves. ``sets``: rep, sketch."""
    level = sets.select("rep", F.explode(first_nodes(F.col("sketch"), runs)).alias("node"))
    parts, held = [], sets
    for at in range(1, depth + 1):
        level = materialize(level, "paths")
        sizes = materialize(
            level.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1"), "path-sizes"
        )
        shared = materialize(level.join(sizes, "node"), "shared-paths")
        small = shared if at == depth else shared.filter(F.col("size") <= leaf)
        parts.append(small.select("node", "rep", "size"))
        if at < depth:
            large = shared.filter(F.col("size") > leaf).select("node", "rep")
            if not large.take(1):
                break
            # A set outside all large nodes is in none further down.
            inside = replicate(large.select("rep").distinct())
            held = materialize(held.join(inside, "rep", "left_semi").select("rep", "sketch"), "held")
            # A set's sketch meets all of its nodes at once: a few per run at most.
            nodes = large.groupBy("rep").agg(F.collect_list("node").alias("nodes"))
            level = nodes.join(held, "rep").select(
                "rep", F.explode(next_nodes(F.col("nodes"), F.col("sketch"))).alias("node")
            )
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    # A set has a few leaves per run at most.
    lists = found.groupBy("rep").agg(F.sort_array(F.collect_set("node")).alias("leaves"))
    return materialize(lists, "leaves"), found.select("node", "size").distinct()


def block_counts(lists: DataFrame, sizes: DataFrame, lengths: DataFrame, block: int, block_tokens: int) -> DataFrame:
    """(node, blocks) of the leaves that one block does not hold.

    Tokens are summed only where so many of the longest set could exceed a block.
    """
    longest = lengths.agg(F.max("n")).first()[0] or 0
    large = materialize(sizes.filter((F.col("size") > block) | (F.col("size") * longest > block_tokens)), "large-leaves")
    if not large.take(1):
        return large.select("node", F.lit(1).alias("blocks"))
    inside = lists.select("rep", F.explode("leaves").alias("node")).join(replicate(large), "node")
    held = inside.join(lengths, "rep").groupBy("node").agg(F.first("size").alias("size"), F.sum("n").alias("tokens"))
    blocks = F.greatest(F.ceil(F.col("size") / F.lit(block)), F.ceil(F.col("tokens") / F.lit(block_tokens)))
    return materialize(held.select("node", blocks.cast("int").alias("blocks")).filter("blocks > 1"), "blocks")


def in_buckets(members: DataFrame, blocks: DataFrame) -> DataFrame:
    """``members`` (rep, brief, leaves) in the buckets they are compared in: a leaf, or a
    pair of blocks of a large one; of a pair of different blocks only rows of side 0 are
    compared with rows of side 1."""
    each = members.select("*", F.explode("leaves").alias("node")).join(replicate(blocks), "node", "left")
    each = each.withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("rep", "node"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(
            F.least(F.col("own"), other).alias("i"),
            F.greatest(F.col("own"), other).alias("j"),
            (F.col("own") > other).cast("int").alias("side"),
        ),
    )
    return each.withColumn("own", own).select("node", "rep", "brief", "leaves", F.inline(pairs)).select(
        F.xxhash64("node", "i", "j").alias("bucket"),
        "node",
        "rep",
        "side",
        (F.col("i") != F.col("j")).alias("two"),
        "brief",
        "leaves",
    )


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray | list]]]:
    """Runs of rows with equal first column, across batches: (bucket, columns)."""
    held: list[pa.RecordBatch] = []

    def emit(parts):
        table = pa.Table.from_batches(parts)
        return table.column(0)[0].as_py(), table

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        edges = [0, *cuts.tolist(), len(keys)]
        for k, (start, end) in enumerate(zip(edges, edges[1:])):
            part = batch.slice(start, end - start)
            if held and held[0].column(0)[0].as_py() != keys[start]:
                yield emit(held)
                held = []
            held.append(part)
            if k + 2 < len(edges):
                yield emit(held)
                held = []
    if held:
        yield emit(held)


def to_judge(table: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Of one bucket: its rows, each set once, and which pairs of them are to be judged
    here: estimated at ``least`` or more, and sharing no smaller leaf."""
    reps, at = np.unique(table.column("rep").to_numpy(), return_index=True)
    n, node = len(reps), table.column("node")[0].as_py()
    rows = np.frombuffer(b"".join(table.column("brief").to_pylist()), np.uint8).reshape(-1, COORDINATES)[at]
    near = np.zeros((n, n), dtype=bool)
    need = math.ceil(least * COORDINATES)
    for k in range(n):
        near[k] = np.count_nonzero(rows == rows[k], axis=1) >= need
    np.fill_diagonal(near, False)
    if table.column("two")[0].as_py():
        side = table.column("side").to_numpy()[at]
        near &= side[:, None] != side[None, :]
    if near.any():
        lists = table.column("leaves").combine_chunks()
        ends, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        owner, smaller = [], []
        for k, row in enumerate(at):
            own = values[ends[row] : ends[row + 1]]
            own = own[own < node]
            owner.append(np.full(len(own), k))
            smaller.append(own)
        if owner := np.concatenate(owner).tolist():
            _, column = np.unique(np.concatenate(smaller), return_inverse=True)
            met = np.zeros((n, column.max() + 1), dtype=np.float32)
            met[owner, column] = 1
            near &= met @ met.T == 0
    return at, near


def candidates(bucketed: DataFrame, least: float) -> DataFrame:
    """The rows of ``in_buckets`` that have a partner to be judged with in their bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in _buckets(batches):
            if table.num_rows > 1:
                at, near = to_judge(table, least)
                left = np.sort(at[near.any(axis=1)])
                if len(left):
                    yield from table.take(pa.array(left)).to_batches()

    return bucketed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, bucketed.schema)


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, as a product over the tokens that two sets share."""
    tokens, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    column = np.cumsum(shared) - 1
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    keep = shared[inverse]
    owner, column = owner[keep], column[inverse[keep]]
    total = np.zeros((len(sets), len(sets)), dtype=np.float64)
    width = max(1, (8 << 20) // (4 * len(sets)))
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for start in range(0, int(shared.sum()), width):
        low, high = np.searchsorted(column, [start, start + width])
        part = np.zeros((len(sets), width), dtype=np.float32)
        part[owner[low:high], column[low:high] - start] = 1
        total += part @ part.T
    return total


def common_tokens(sets: list[np.ndarray], pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of the given pairs: one by one if they are few, else
    from the product over all."""
    if 20 * len(pairs[0]) < len(sets) ** 2:
        sizes = [len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(*pairs)]
        return np.array(sizes, dtype=np.float64)
    return overlaps(sets)[pairs]


LINK_SCHEMA = "rep long, root long, links long"


def verified(active: DataFrame, threshold: float, least: float, words: int) -> DataFrame:
    """Per bucket and set: the smallest set it is joined with there, and its number of
    linked documents. ``active``: rows of ``candidates`` with text and copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int]] = []
        for _, table in _buckets(batches):
            at, near = to_judge(table, least)
            reps = table.column("rep").to_numpy()[at]
            copies = table.column("copies").to_numpy()[at]
            texts = table.column("text").to_pylist()
            sets = [shingles(texts[i].encode("utf-8"), words) for i in at]
            sizes = np.array([len(s) for s in sets], dtype=np.float64)
            i, j = np.nonzero(np.triu(near))
            if not len(i):
                continue
            common = common_tokens(sets, (i, j))
            linked = common >= threshold * (sizes[i] + sizes[j] - common) - 1e-9
            i, j = i[linked], j[linked]
            links = np.zeros(len(reps), dtype=np.int64)
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            root = list(range(len(reps)))

            def find(x, root=root):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            # Rows are in order of rep, so the smaller number is the smaller rep.
            for a, b in zip(i.tolist(), j.tolist()):
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
            out += [(int(reps[k]), int(reps[find(k)]), int(links[k])) for k in np.flatnonzero(links)]
            if len(out) >= 2000:
                yield _link_batch(out)
                out = []
        if out:
            yield _link_batch(out)

    return active.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, LINK_SCHEMA)


def _link_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(list(c), pa.int64()) for c in zip(*rows)]
    return pa.RecordBatch.from_arrays(columns, ["rep", "root", "links"])


# --- groups ----------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(rep, label): the smallest node connected with each node of ``edges``.

    Labels sink along the edges and then jump to their label's label, so rounds grow
    with the logarithm of a chain's length.
    """
    both = materialize(
        edges.select("rep", F.col("root").alias("other"))
        .unionByName(edges.select(F.col("root").alias("rep"), F.col("rep").alias("other")))
        .filter("rep != other")
        .distinct(),
        "component-edges",
    )
    labels = materialize(
        both.groupBy("rep").agg(F.least(F.min("other"), F.col("rep")).alias("label")), "labels"
    )
    while True:
        seen = both.join(labels.select(F.col("rep").alias("other"), "label"), "other")
        low = seen.groupBy("rep").agg(F.min("label").alias("low"))
        step = labels.join(low, "rep").select(
            "rep", F.least("label", "low").alias("label"), F.col("label").alias("was")
        )
        step = materialize(step, "labels")
        target = step.select(F.col("rep").alias("label"), F.col("label").alias("beyond"))
        jumped = materialize(
            step.join(target, "label").select("rep", F.col("beyond").alias("label"), "was"), "labels"
        )
        labels = jumped.select("rep", "label")
        if not jumped.filter(F.col("label") != F.col("was")).take(1):
            return labels


# --- the operator ----------------------------------------------------------------


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    leaf: int = LEAF,
    depth: int = DEPTH,
    block: int = BLOCK,
) -> DataFrame:
    """Per row: doc_id, text_md5, class_id (smallest id of its group), copy_id (smallest
    id of its class of equal sets), group (a number of the group, of this run), n_links (other documents at the threshold or above).
    """
    text = text_or_empty(text_col)
    least = threshold - SLACK
    slim = materialize(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"),
            F.unhex(F.md5(text)).alias("text_md5"),
            sketch(text, words).alias("s"),
        ).select("doc_id", "text_md5", "s.*", F.monotonically_increasing_id().alias("row")),
        "sketches",
    )
    # Sketches stay where they are: only digests are shuffled to find equal sets.
    classes = materialize(
        slim.groupBy("set")
        .agg(
            F.min("doc_id").alias("copy_id"),
            F.count("*").alias("copies"),
            F.min(F.struct("row", "text_md5", "n")).alias("first"),
        )
        .select("set", "copy_id", "copies", F.col("first.row").alias("rep"), "first.text_md5", "first.n"),
        "classes",
    )
    again = classes.filter("copies > 1").select("set", F.col("rep").alias("chosen"))
    sets = (
        slim.filter("n > 0")
        .join(replicate(again), "set", "left")
        .filter("chosen is null or chosen = row")
        .select(F.col("row").alias("rep"), "sketch")
    )
    lists, sizes = leaves(sets, runs_for(recall, threshold, depth), leaf, depth)
    blocks = block_counts(lists, sizes, classes.select("rep", "n"), block, BLOCK_TOKENS)
    members = sets.join(replicate(lists), "rep").select("rep", "leaves", brief(F.col("sketch")).alias("brief"))
    active = materialize(candidates(in_buckets(members, blocks), least), "candidates")
    wanted = classes.join(active.select("rep").distinct(), "rep", "left_semi")
    wanted = materialize(wanted.select("rep", "copies", "text_md5"), "wanted")
    texts = docs.select(F.unhex(F.md5(text)).alias("text_md5"), text.alias("text")).join(
        replicate(wanted), "text_md5"
    )
    # Copies combine map-side: one text per class and map task is shuffled.
    texts = texts.groupBy("rep").agg(F.min("copies").alias("copies"), F.min("text").alias("text"))
    judged = active.join(texts, "rep").select(*active.columns, "copies", "text")
    linked = materialize(verified(judged, threshold, least, words), "links")
    labels = components(linked.select("rep", "root"))
    near = linked.groupBy("rep").agg(F.sum("links").alias("links"))
    # Smallest ids are written before the join, so that the rows of a hot group can be
    # split: an aggregate joined on its own key keeps each group in one task.
    lowest = materialize(
        labels.join(classes.select("rep", "copy_id"), "rep")
        .groupBy("label")
        .agg(F.min("copy_id").alias("class_id")),
        "group-ids",
    )
    labels = labels.join(lowest, "label")
    groups = (
        classes.select("set", "rep", "copy_id", "copies")
        .join(near, "rep", "left")
        .join(labels, "rep", "left")
        .select(
            "set",
            "copy_id",
            F.coalesce("class_id", "copy_id").alias("class_id"),
            F.coalesce("label", "rep").alias("group"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    return slim.join(groups, "set").select(
        "doc_id", "text_md5", "group", "class_id", "copy_id", "n_links"
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id (NULL last), then
    text digest. Of rows equal in both any one stays."""
    digest, other_id, other_digest = fresh(docs, "digest", "other_id", "other_digest")
    found = materialize(
        near_duplicates(docs, id_col, text_col, **how).select("group", "doc_id", "text_md5"), "groups"
    )
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_md5")
    # Written before the join, as above; rows that are alone in their group stay.
    best = materialize(
        found.groupBy("group")
        .agg(F.min(row).alias("best"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n"),
        "groups-best",
    )
    leaving = materialize(
        found.join(best, "group")
        .filter(~row.eqNullSafe(F.col("best")))
        .select(F.col("doc_id").alias(other_id), F.col("text_md5").alias(other_digest))
        .distinct(),
        "leaving",
    )
    kept = docs.withColumn(digest, F.unhex(F.md5(text_or_empty(text_col)))).join(
        replicate(leaving),
        F.col(f"`{id_col}`").eqNullSafe(F.col(other_id)) & (F.col(digest) == F.col(other_digest)),
        "left_anti",
    )
    # Texts are shuffled once more only where ids do not tell the rows apart.
    if found.groupBy("doc_id", "text_md5").count().filter("count > 1").take(1):
        kept = kept.dropDuplicates([id_col, digest])
    return kept.drop(digest)
