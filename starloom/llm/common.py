"""What the operators share: input columns, scratch tables, bounded batches."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import broadcasting
from starloom.session import materialize

__all__ = [
    "fresh",
    "importable",
    "materialize",
    "mix",
    "replicate",
    "slices",
    "stretch_hashes",
    "table",
    "text_or_empty",
    "texts_of",
    "word_bounds",
    "word_hashes",
]


PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> SparkSession:
    """Lets Python workers on this machine import the package from where it lies.

    Where executors have the package installed, or PYTHONPATH set, this adds nothing.
    """
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(
            p for p in [PACKAGE_ROOT, *paths] if p
        )
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Most bytes of a side that is broadcast: in memory several times as much, which has to
# fit beside the work of an executor with little memory.
BROADCAST_BYTES = 24 << 20


def replicate(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if its counted size is within ``BROADCAST_BYTES``."""
    return broadcasting.replicate(df, BROADCAST_BYTES)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names`` with underscores in front until none clashes with a column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True  # the ASCII white space
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers evenly."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def stretch_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each stretch of ``symbols``, from prefix sums."""
    total = np.zeros(len(symbols) + 1, dtype=np.uint64)
    terms = (symbols.astype(np.uint64) + np.uint64(1)) * _powers(_FACTOR, len(symbols))
    np.cumsum(terms, out=total[1:], dtype=np.uint64)
    back = _powers(_INVERSE, len(symbols) + 1)
    return mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words, runs of anything but ASCII white space."""
    edge = np.diff(np.concatenate([[True], _WHITE[data], [True]]).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_hashes(data: bytes) -> np.ndarray:
    symbols = np.frombuffer(data, dtype=np.uint8)
    return stretch_hashes(symbols, *word_bounds(symbols))


def slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose sizes add up to ``limit`` at most, or hold one item."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def texts_of(array: pa.Array) -> list[str]:
    return [t or "" for t in array.to_pylist()]
