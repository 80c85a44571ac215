"""Quality classifier: Naive Bayes support vectors over n-gram indicators.

Features are hashed indicators of a text's words and word pairs, of its word shapes
and shape pairs (letter case, digits and punctuation instead of the letters), of the
share each shape has in eighths, and of the share of repeated word triples. Each
indicator is scaled by the log-count ratio of its class counts (Naive Bayes), and a
linear hinge-loss model is fitted over them by dual coordinate descent. A logistic
curve over the margins of rows held back from that fit turns margins into scores.

The fit takes at most ``SAMPLE_ROWS`` labelled documents, one row of each id: the one
of the smallest text. They are chosen by a hash of the id among the ids that have both a
label and a document, and are the only rows one task sees together. All texts are scored
whole, in their tasks, with one broadcast vector of ``2**BITS`` weights.

NULL counts as the empty text; a text without words scores by the intercept. A
document with several labels counts by the smallest; rows of one id are scored each for
itself. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import materialize, mix, slices, stretch_hashes, text_or_empty, texts_of, word_bounds

BITS = 18
SAMPLE_ROWS = 12_000
HELD_BACK = 5  # every so many rows of the sample go to the logistic curve
COST = 1.0
EPOCHS = 12
SMOOTHING = 1.0
BATCH_BYTES = 1 << 20
CUT = 0.3

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 65, 97, 48, 97


def features(texts: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each text's indicators: (document, bucket), sorted, each pair once."""
    data = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    starts, ends = word_bounds(data)
    doc = np.searchsorted(np.cumsum(sizes), starts, side="right")
    if not len(starts):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    words = stretch_hashes(_LOWER[data], starts, ends)
    # Shapes: classes of the bytes, runs within a word collapsed.
    kind = _CLASS[data]
    keep = np.ones(len(kind), dtype=bool)
    keep[1:] = kind[1:] != kind[:-1]
    keep[starts] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    shapes = stretch_hashes(kind[keep], place[starts], place[ends])

    same1 = doc[1:] == doc[:-1]
    same2 = doc[2:] == doc[:-2]
    step = np.uint64(0xD6E8FEB86659FD93)
    pairs = mix(words[:-1] * step + words[1:])
    shape_pairs = mix(shapes[:-1] * step + shapes[1:])
    n_words = np.bincount(doc, minlength=len(texts))

    # Share of each shape in the text, in eighths.
    by_shape, count = _count(doc, shapes)
    shape_doc = by_shape[:, 0].astype(np.int64)
    eighths = (8 * count + n_words[shape_doc] - 1) // n_words[shape_doc]
    shares = mix(by_shape[:, 1] + eighths.astype(np.uint64) * step)

    triples = mix(pairs[:-1] * step + words[2:])[same2] if len(words) > 2 else words[:0]
    triple_doc = doc[2:][same2] if len(words) > 2 else doc[:0]
    kinds, times = _count(triple_doc, triples)
    twice = np.bincount(
        kinds[:, 0].astype(np.int64), weights=times * (times > 1), minlength=len(texts)
    )
    repeats = np.ceil(8 * twice / np.maximum(n_words, 1)).astype(np.uint64)
    texts_with = np.flatnonzero(n_words)

    parts = [
        (doc, words, 1),
        (doc[1:][same1], pairs[same1], 2),
        (doc, shapes, 3),
        (doc[1:][same1], shape_pairs[same1], 4),
        (shape_doc, shares, 5),
        (texts_with, mix(repeats[texts_with]), 6),
    ]
    keys = np.concatenate(
        [
            (d.astype(np.int64) << bits)
            | (mix(h + np.uint64(salt)) >> np.uint64(64 - bits)).astype(np.int64)
            for d, h, salt in parts
        ]
    )
    keys = np.unique(keys)
    return keys >> bits, keys & ((1 << bits) - 1)


def _count(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, hash) rows, and how often each occurs."""
    order = np.lexsort((hashes, doc))
    rows = np.stack([doc[order].astype(np.uint64), hashes[order]], 1)
    first = np.ones(len(rows), dtype=bool)
    first[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    at = np.flatnonzero(first)
    return rows[at], np.diff(np.append(at, len(rows)))


def log_count_ratio(rows: list[np.ndarray], labels: np.ndarray, size: int, smoothing: float):
    counts = np.full((2, size), smoothing)
    for buckets, label in zip(rows, labels):
        counts[int(label), buckets] += 1
    counts /= counts.sum(axis=1, keepdims=True)
    return np.log(counts[1] / counts[0])


def dual_coordinate_descent(
    rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, cost: float, epochs: int
) -> np.ndarray:
    """Weights of the hinge-loss model; the last one is the intercept's.

    Row ``i`` holds ``scale`` at its buckets, and 1 for the intercept. One dual
    variable per row, between 0 and ``cost`` (weighted up for the rarer class),
    is moved at a time to its optimum given the others.
    """
    signs = np.where(labels == 1, 1.0, -1.0)
    share = max(min(labels.mean(), 1 - labels.mean()), 1e-3)
    rare = 1 if labels.mean() < 0.5 else 0
    limit = np.where(labels == rare, cost * min((1 - share) / share, 4.0), cost)
    weights, bias = np.zeros(len(scale)), 0.0
    alpha = np.zeros(len(rows))
    values = [scale[r] for r in rows]
    norms = [float(v @ v) + 1.0 for v in values]
    random = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in random.permutation(len(rows)):
            row, value, sign = rows[i], values[i], signs[i]
            gradient = sign * (weights[row] @ value + bias) - 1.0
            new = min(max(alpha[i] - gradient / norms[i], 0.0), limit[i])
            change = new - alpha[i]
            if change:
                alpha[i] = new
                weights[row] += change * sign * value
                bias += change * sign
                moved = max(moved, abs(change))
        if moved < 1e-3:
            break
    return np.append(weights, bias)


def logistic_fit(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve, by Newton steps with a weak prior."""
    slope, offset = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([(labels - p) @ margins - 0.01 * (slope - 1), (labels - p).sum() - 0.01 * offset])
        hessian = np.array(
            [[w @ margins**2 + 0.01, w @ margins], [w @ margins, w.sum() + 0.01]]
        )
        step = np.linalg.solve(hessian, gradient)
        slope, offset = slope + step[0], offset + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(slope, 1e-3), offset


def train(rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Weights per bucket, then the intercept; margins are log-odds of label 1."""
    size = 1 << bits
    if len(set(labels.tolist())) < 2:
        prior = (labels.sum() + 0.5) / (len(labels) + 1)
        return np.append(np.zeros(size), np.log(prior / (1 - prior)))
    back = np.arange(len(rows)) % HELD_BACK == 0
    if len(set(labels[~back].tolist())) < 2 or len(set(labels[back].tolist())) < 2:
        back[:] = False
    fit = np.flatnonzero(~back)
    fit_rows = [rows[i] for i in fit]
    scale = log_count_ratio(fit_rows, labels[fit], size, SMOOTHING)
    weights = dual_coordinate_descent(fit_rows, labels[fit], scale, COST, EPOCHS)
    model = weights[:-1] * scale
    test = np.flatnonzero(back) if back.any() else fit
    margins = np.array([model[rows[i]].sum() + weights[-1] for i in test])
    slope, offset = logistic_fit(margins, labels[test].astype(float))
    return np.append(model * slope, weights[-1] * slope + offset)


MODEL_SCHEMA = "model binary"


def fit(docs: DataFrame, labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, bits: int = BITS) -> bytes:
    """The model (little-endian doubles) of texts and 0/1 labels.

    ``docs``: doc_id, text; ``labelled``: doc_id, label, one row per document.
    """
    order = F.xxhash64(F.col("doc_id").cast("string"))
    # Labels without a document use up no room; no text is read for that.
    known = labelled.join(docs.select("doc_id"), "doc_id", "left_semi").select("doc_id", "label", order.alias("place"))
    sample = materialize(known.orderBy("place", "doc_id").limit(sample_rows), "quality-sample")

    @F.arrow_udf(T.BinaryType())
    def buckets(texts: pa.Array) -> pa.Array:
        return pa.array(
            [features([t.encode("utf-8")], bits)[1].astype("<i4").tobytes() for t in texts_of(texts)],
            pa.binary(),
        )

    # ``sample_rows`` rows of three numbers each: bounded. Rows of one id combine
    # map-side to one.
    rows = (
        docs.join(F.broadcast(sample), "doc_id")
        .groupBy("place", "doc_id", "label")
        .agg(F.min("text").alias("text"))
        .select("place", F.crc32(F.col("text")).alias("crc"), "label", buckets(F.col("text")).alias("b"))
    )

    def one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken = []
        for batch in batches:
            taken += zip(*(batch.column(i).to_pylist() for i in range(4)))
        taken.sort(key=lambda r: r[:3])
        data = [np.frombuffer(r[3], "<i4") for r in taken]
        labels = np.array([r[2] for r in taken], dtype=np.int64)
        model = train(data, labels, bits) if taken else np.zeros((1 << bits) + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.astype("<f8").tobytes()], pa.binary())], ["model"]
        )

    found = rows.repartition(1).mapInArrow(one_task, MODEL_SCHEMA).first()
    # Without a labelled row there may be no task at all.
    return bytes(found["model"] if found else np.zeros((1 << bits) + 1).tobytes())


def score(docs: DataFrame, model: bytes, text: Column, bits: int = BITS) -> Column:
    """Probability of label 1 of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def scores(texts: pa.Array) -> pa.Array:
        weights = np.frombuffer(shared.value, "<f8")
        data = [t.encode("utf-8") for t in texts_of(texts)]
        out = np.zeros(len(data))
        for start, end in slices([len(t) for t in data], BATCH_BYTES):
            doc, bucket = features(data[start:end], bits)
            out[start:end] = np.bincount(doc, weights=weights[bucket], minlength=end - start)
        return pa.array(1 / (1 + np.exp(-np.clip(out + weights[-1], -30, 30))))

    return scores(text)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")), F.lit(0)) % 5 == 0


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    Labels of held-out documents are never learned from.
    """
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))
    known = (
        labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
    )
    model = fit(slim, known, sample_rows)
    return slim.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score(slim, model, F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= CUT).cast("int"))
