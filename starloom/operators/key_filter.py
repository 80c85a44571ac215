"""A Bloom filter of one side's keys, applied to the other side before a shuffle.

A filtered dimension that is too large to be broadcast still rules out most rows of a
fact. Its keys set bits of a bit string of bounded length; the words of that string
are broadcast, and a fact row whose bit is not set has no partner and never reaches
the shuffle. Rows that pass by chance leave in the join that follows.

One hash function over sixteen bits a key lets about one row in sixteen pass by chance,
at a quarter of the rows a broadcast of the keys themselves would have. Built from
DataFrame functions: words combine map-side by OR, and the test is one broadcast join
on integers inside whole-stage code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS_PER_KEY = 16
# Most words a filter may have: 16 bytes each, some four times that as a hash table.
MAX_WORDS = 4 << 20


@dataclass(frozen=True)
class KeyFilter:
    """``words``: (word, bits), those with a bit set. ``size``: bits in all."""

    words: DataFrame
    size: int

    @classmethod
    def of(cls, df: DataFrame, key: str, bits_per_key: int = BITS_PER_KEY, max_words: int = MAX_WORDS) -> KeyFilter | None:
        """The filter of ``df``'s keys, None if it would exceed ``max_words``.

        Keys are counted approximately first, in one pass with a small state.
        """
        keys = df.agg(F.approx_count_distinct(key)).first()[0]
        size = 64 * max(16, -(-keys * bits_per_key // 64))
        if size // 64 > max_words:
            return None
        word, bit = cls._place(df, key, size)
        words = (
            df.where(F.col(key).isNotNull())
            .select(word.alias("_word"), bit.alias("_bit"))
            .groupBy("_word")
            .agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
        )
        return cls(words, size)

    @staticmethod
    def _place(df: DataFrame, key: str, size: int) -> tuple[Column, Column]:
        """Integers of any width hash alike; other keys must have one type on both sides."""
        whole = isinstance(df.schema[key].dataType, T.IntegralType)
        hashed = F.pmod(F.xxhash64(F.col(key).cast("long") if whole else F.col(key)), F.lit(size))
        return F.shiftright(hashed, 6), hashed.bitwiseAND(F.lit(63)).cast("int")

    def apply(self, df: DataFrame, key: str) -> DataFrame:
        """The rows of ``df`` whose key may be among the filter's."""
        word, bit = self._place(df, key, self.size)
        tested = df.withColumns({"_word": word, "_bit": bit})
        return (
            tested.join(F.broadcast(self.words), "_word")
            .where("shiftright(_bits, _bit) & 1 = 1")
            .select(*df.columns)
        )
