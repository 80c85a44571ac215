"""Token counts of the fields and sections of a text.

A text is encoded once, whole; each token's byte length follows from its id, so its
span of characters is known without searching. The spans are joined with the sections
(sorted, not overlapping) by binary search. A token that lies in one section counts
there. A token that crosses boundaries counts once, by ``rule``: "most" gives it to
the section that holds most of its characters, the earlier one if equal; "first" to
the section its first character lies in, or the next one it reaches. A token that
touches no section is counted as between sections.

A token that holds only part of a character spans that whole character. NULL counts
as the empty text; an empty section has no tokens. Repeated rows are counted each for
itself. Columns that are not named are not read, whatever they are called; the result
has its own columns only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.bpe import Codec, codec, default_vocabulary

BETWEEN = "between"
RULES = ("most", "first")
COUNTED = T.StructType(
    [
        T.StructField("tokens", T.ArrayType(T.LongType())),
        T.StructField("crossing", T.ArrayType(T.LongType())),
        T.StructField("between", T.LongType()),
    ]
)


def token_spans(codec_: Codec, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each token, in code points."""
    ids = np.frombuffer(codec_.encode_bytes(text), "<u4")
    ends = np.cumsum(codec_.lengths[ids])
    starts = ends - codec_.lengths[ids]
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    if not len(ids):
        return starts, ends
    return character[starts], character[ends - 1] + 1


def attribute(
    starts: np.ndarray, ends: np.ndarray, low: np.ndarray, high: np.ndarray, rule: str
) -> tuple[np.ndarray, np.ndarray, int]:
    """Tokens and crossing tokens of each section [low, high), and tokens in none."""
    counted, crossing = np.zeros((2, len(low)), dtype=np.int64)
    filled = np.flatnonzero(high > low)
    low, high = low[filled], high[filled]
    first = np.searchsorted(high, starts, side="right")
    behind = np.searchsorted(low, ends, side="left")
    touched = behind - first
    inside = touched > 0
    leaves = inside & (
        (touched > 1)
        | (starts < low[np.minimum(first, max(len(low) - 1, 0))])
        | (ends > high[np.minimum(first, max(len(low) - 1, 0))])
    ) if len(low) else inside
    owner = first.copy()
    if rule == "most":
        for k in np.flatnonzero(touched > 1).tolist():
            sections = np.arange(first[k], behind[k])
            share = np.minimum(ends[k], high[sections]) - np.maximum(starts[k], low[sections])
            owner[k] = sections[int(np.argmax(share))]
    counted[filled] = np.bincount(owner[inside], minlength=len(filled))
    crossing[filled] = np.bincount(owner[leaves], minlength=len(filled))
    return counted, crossing, int((~inside).sum())


def count_sections(
    text: Column, starts: Column, ends: Column, rule: str = "most", vocabulary: str | None = None
) -> Column:
    """``COUNTED`` of each text for its sections, given as two arrays of offsets."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    path = vocabulary or default_vocabulary()

    @F.arrow_udf(COUNTED)
    def run(texts: pa.Array, lows: pa.Array, highs: pa.Array) -> pa.Array:
        tokens, crossing, between = [], [], []
        for text, low, high in zip(texts.to_pylist(), lows, highs):
            spans = token_spans(codec(path), text or "")
            bounds = (
                np.array(b.values.to_numpy() if b.is_valid else [], dtype=np.int64) for b in (low, high)
            )
            counted, crossed, none = attribute(*spans, *bounds, rule)
            tokens.append(counted)
            crossing.append(crossed)
            between.append(none)
        lists = pa.list_(pa.int64())
        return pa.StructArray.from_arrays(
            [pa.array(tokens, lists), pa.array(crossing, lists), pa.array(between, pa.int64())],
            COUNTED.names,
        )

    return run(text, starts, ends)


def attribute_fields(
    docs: DataFrame,
    id_col: str,
    fields: list[str],
    text_col: str,
    separator: str = "\n",
    rule: str = "most",
    vocabulary: str | None = None,
) -> DataFrame:
    """Tokens of the record "fields..., text" per field and per line of the text.

    One row per document and section: section ("between" for tokens in none), ordinal
    (the line's number from 0; else 0), start, end, n_tokens, n_crossing.
    """
    value = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in fields]
    body = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    lengths = F.transform(F.split(body, "\n", -1), lambda line: F.length(line).cast("long"))
    slim = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.concat_ws(separator, *value, body).alias("record"),
        F.concat(
            F.array(*[F.length(v).cast("long") for v in value]).cast("array<bigint>"), lengths
        ).alias("lengths"),
    )
    # Sections lie one separator (newline in the text) apart.
    gap = len(separator)
    n = len(fields)

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def begin(column: pa.Array) -> pa.Array:
        out = []
        for sizes in column.to_pylist():
            steps = np.array(sizes[:-1], dtype=np.int64) + 1
            steps[:n] += gap - 1
            out.append(np.concatenate([[0], np.cumsum(steps)]))
        return pa.array(out, pa.list_(pa.int64()))

    slim = slim.withColumn("starts", begin("lengths"))
    slim = slim.withColumn("ends", F.zip_with("starts", "lengths", lambda s, k: s + k))
    counted = slim.select(
        "doc_id",
        "starts",
        "ends",
        count_sections(F.col("record"), F.col("starts"), F.col("ends"), rule, vocabulary).alias("c"),
    )
    names = F.array(*map(F.lit, fields)).cast("array<string>")
    sections = F.transform(
        F.arrays_zip(
            F.col("starts").alias("start"),
            F.col("ends").alias("end"),
            F.col("c.tokens").alias("n_tokens"),
            F.col("c.crossing").alias("n_crossing"),
        ),
        lambda s, k: F.struct(
            F.when(k < n, F.get(names, k)).otherwise(F.lit(text_col)).alias("section"),
            F.when(k < n, F.lit(0)).otherwise(k - n).alias("ordinal"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["n_tokens"].alias("n_tokens"),
            s["n_crossing"].alias("n_crossing"),
        ),
    )
    nowhere = F.struct(
        F.lit(BETWEEN).alias("section"),
        F.lit(0).alias("ordinal"),
        F.lit(None).cast("long").alias("start"),
        F.lit(None).cast("long").alias("end"),
        F.col("c.between").alias("n_tokens"),
        F.lit(0).cast("long").alias("n_crossing"),
    )
    return counted.select("doc_id", F.inline(F.concat(sections, F.array(nowhere))))
