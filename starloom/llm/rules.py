"""Quality rules: counts per text, and bands of zstandard compression ratios.

A text fails its bands if the ratio (bytes to compressed bytes) of the whole text lies
outside the limits for its length, or if more than ``CHUNK_SHARE`` of its bytes lie in
fixed chunks whose ratio is outside the limits for the chunk's length, the shorter last
chunk included. Repetitive text compresses too well, noise too badly. Limits depend on
the length because a compressor finds more to repeat in a longer text.

``fitted_bands`` finds limits from labelled rows: per octave of length the smallest and
largest ratio of the good ones, widened by a margin. ``BANDS`` are its results on 2,500
good rows that are not held out, beyond the base rule, with margins of about 0.1 below
and 0.05 above, made to rise with the length.

NULL counts as the empty text: no words, so the base rule fails it. Repeated rows get
the same verdict each. Very long texts are judged whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import text_or_empty, texts_of

LEVEL = 3
CHUNK_BYTES = 4096
CHUNK_SHARE = 0.25
# From so many bytes on: lowest and highest ratio.
BANDS = (
    (0, 0.0, 1.65),
    (256, 1.25, 1.90),
    (512, 1.35, 2.02),
    (1024, 1.60, 2.20),
    (2048, 1.80, 2.27),
    (4096, 1.95, 2.39),
    (8192, 2.05, 2.46),
    (16384, 2.10, 2.52),
    (65536, 2.10, 2.60),
)

WHITE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50

VERDICT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
        T.StructField("ratio", T.DoubleType()),
        T.StructField("odd_chunks", T.LongType()),
        T.StructField("n_chunks", T.LongType()),
        T.StructField("band_failed", T.BooleanType()),
        T.StructField("chunks_failed", T.BooleanType()),
    ]
)


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that the text holds twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    kinds = len(number) + 1
    _, pairs = np.unique(ids[:-1] * kinds + ids[1:], return_inverse=True)
    _, window, counts = np.unique(
        pairs[:-1] * kinds + ids[2:], return_inverse=True, return_counts=True
    )
    repeated = counts[window] > 1
    covered = np.zeros(len(ids), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(repeated)] |= repeated
    return int(covered.sum())


def counts(text: str, data: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - sum(data.count(c) for c in WHITE),
        sum(data.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def ratio(compressor: zstandard.ZstdCompressor, data: bytes) -> float:
    return len(data) / len(compressor.compress(data)) if data else 1.0


def chunks_of(data: bytes, size: int) -> list[bytes]:
    return [data[i : i + size] for i in range(0, len(data), size)]


def in_band(size: int, value: float, bands) -> bool:
    limits = [(low, high) for least, low, high in bands if size >= least]
    return not limits or limits[-1][0] <= value <= limits[-1][1]


def assess(text: Column, bands=BANDS, chunk_bytes: int = CHUNK_BYTES) -> Column:
    """A ``VERDICT`` for each text."""

    @F.arrow_udf(VERDICT)
    def verdicts(texts: pa.Array) -> pa.Array:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        rows = []
        for text in texts_of(texts):
            data = text.encode("utf-8")
            found = counts(text, data)
            failed = found[0] < MIN_WORDS or 100 * found[4] > 50 * found[0]
            whole = ratio(compressor, data)
            chunks = chunks_of(data, chunk_bytes)
            odd = [c for c in chunks if not in_band(len(c), ratio(compressor, c), bands)]
            band_failed = not in_band(len(data), whole, bands)
            chunks_failed = sum(map(len, odd)) > CHUNK_SHARE * len(data)
            kept = not (failed or band_failed or chunks_failed)
            rows.append((*found, failed, kept, whole, len(odd), len(chunks), band_failed, chunks_failed))
        columns = zip(*rows) if rows else [[] for _ in VERDICT]
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] + [pa.int64()] * 2 + [pa.bool_()] * 2
        arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds)]
        return pa.StructArray.from_arrays(arrays, VERDICT.names)

    return verdicts(text)


def fitted_bands(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    margins: tuple[float, float] = (0.1, 0.05),
) -> list[tuple[int, float, float]]:
    """Limits per octave of length that keep every good row which is not held out and
    passes the base rule. Held out are ids whose crc32 as text is a multiple of 5.

    Only labelled rows are read; one row per octave reaches the driver. Octaves without
    a good row have no limits of their own.
    """
    held_out = F.crc32(F.col(f"`{id_col}`").cast("string")) % 5 == 0
    good = labels.filter((F.col(f"`{label_col}`") == 1) & ~held_out).select(F.col(f"`{id_col}`").alias("_id"))
    text = text_or_empty(text_col)
    rows = (
        docs.select(F.col(f"`{id_col}`").alias("_id"), text.alias("_text"))
        .join(good.distinct(), "_id", "left_semi")
        .select(F.octet_length("_text").alias("bytes"), assess(F.col("_text")).alias("v"))
        .filter(~F.col("v.base_failed"))
    )
    octave = F.floor(F.log2(F.greatest("bytes", F.lit(1)))).cast("int")
    found = rows.groupBy(octave.alias("octave")).agg(F.min("v.ratio").alias("low"), F.max("v.ratio").alias("high"))
    return sorted(
        (1 << r["octave"], round(r["low"] - margins[0], 2), round(r["high"] + margins[1], 2)) for r in found.collect()
    )
