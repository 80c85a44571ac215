"""Spelling variants: words one edit apart, found through variable-length grams.

1. Words are runs of letters, counted over all documents (map-side combined).
2. The gram dictionary holds extensions of two-letter grams: a gram is extended where
   more than ``threshold`` places of the vocabulary hold it, and only to extensions with
   an eighth as many places at least. Its size is bounded by ``MAX_GRAMS``: the
   threshold rises with the vocabulary.
3. A word, between two marks, is decomposed at each place into the longest gram of the
   dictionary, two letters if there is none; grams inside an earlier one are left out.
4. Per word, ``affected`` bounds how many of its grams one edit can destroy, be it that
   the edit hits them, or that a longer gram could then grow over them. Words one edit
   apart share all other grams, at the same place or one further on. So it is enough to
   merge the lists of the word's ``affected + 1`` rarest grams, and no pair is lost.
5. Candidates are verified by their edit distance. Where the bound leaves nothing to
   share on either side, the pair is found by a deleted letter in common instead.

A word's form is its most frequent near word (ties: the smallest) if that occurs five
times as often at least; roots follow forms to their end by pointer jumping, and since
counts grow fivefold per step, a handful of rounds is enough at any size.

NULL texts have no words; a NULL id counts as the empty text in the damage rule. Rows
that are repeated count again. Extra columns are not read. Long texts are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import materialize, replicate, text_or_empty

SHORTEST, LONGEST = 2, 5  # letters of a gram
THRESHOLD = 400
PRUNE = 8  # extensions with fewer than threshold / PRUNE places are left out
MAX_GRAMS = 200_000
MIN_LENGTH = 6
MIN_COUNT = 5
FORM_FACTOR = 5
DAMAGE = 199
# Marks around a word; no letters.
FIRST, LAST = "<", ">"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# --- vocabulary ------------------------------------------------------------------


def damaged(run: Column, hashed: Column, length: Column) -> Column:
    """The run without its code point ``hashed % length`` if DAMAGE divides the hash."""
    at = (hashed % length).cast("int")
    without = F.concat(run.substr(F.lit(1), at), run.substr(at + 2, length))
    return F.when(hashed % DAMAGE == 0, without).otherwise(run)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of ``MIN_LENGTH`` letters that occur ``MIN_COUNT`` times."""
    lowered = F.translate(text_or_empty(text_col), UPPER, LOWER)
    runs = F.regexp_extract_all(lowered, F.lit("[a-z\\u00C0-\\u00FF]+"), F.lit(0))
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    each = (
        docs.select(key.alias("id"), F.explode(runs).alias("run"))
        .withColumn("length", F.length("run"))
        .filter(F.col("length") >= MIN_LENGTH)
        .withColumn("hashed", F.crc32(F.concat("id", F.lit(":"), "run")))
    )
    words = each.select(damaged(F.col("run"), F.col("hashed"), F.col("length")).alias("word"))
    return (
        words.filter(F.length("word") >= MIN_LENGTH)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= MIN_COUNT)
    )


# --- grams -----------------------------------------------------------------------


def dictionary(words: DataFrame, threshold: int = THRESHOLD, max_grams: int = MAX_GRAMS) -> list[str]:
    """The grams of more than ``SHORTEST`` letters, at most ``max_grams`` of them."""
    marked = F.concat(F.lit(FIRST), "word", F.lit(LAST))
    places = F.flatten(
        F.array(
            *(
                F.transform(
                    F.sequence(F.lit(1), F.length(marked) - (size - 1)),
                    lambda p, size=size: marked.substr(p, F.lit(size)),
                )
                for size in range(SHORTEST, LONGEST + 1)
            )
        )
    )
    counts = materialize(
        words.select(F.explode(places).alias("gram")).groupBy("gram").agg(F.count("*").alias("n")),
        "gram-counts",
    )
    total = counts.filter(F.length("gram") > SHORTEST).agg(F.sum("n")).first()[0] or 0
    # Grams with threshold / PRUNE places or more: at most PRUNE * total / threshold.
    threshold = max(threshold, -(-PRUNE * total // max_grams))
    often = counts.filter(F.col("n") > threshold).select(F.col("gram").alias("head"))
    grown = counts.filter((F.length("gram") > SHORTEST) & (F.col("n") * PRUNE >= threshold))
    head = F.expr("substr(gram, 1, length(gram) - 1)")
    kept = grown.withColumn("head", head).join(often, "head", "left_semi").select("gram")
    return [r["gram"] for r in kept.collect()]


class Decomposer:
    """Decomposes words into variable-length grams, with the bound of one edit."""

    def __init__(self, grams: Iterable[str]):
        self.grams = frozenset(grams)
        self.heads = frozenset(g[:k] for g in self.grams for k in range(SHORTEST, len(g)))
        self.tails = frozenset(g[-k:] for g in self.grams for k in range(SHORTEST, len(g)))

    def decompose(self, word: str) -> list[tuple[int, str]]:
        """(place, gram) of a word, marks included."""
        text, out, reach = FIRST + word + LAST, [], 0
        for place in range(len(text) - SHORTEST + 1):
            end = min(place + LONGEST, len(text))
            while end > place + SHORTEST and text[place:end] not in self.grams:
                end -= 1
            if end > reach:
                out.append((place, text[place:end]))
                reach = end
        return out

    def affected(self, word: str, grams: list[tuple[int, str]]) -> int:
        """Most grams of the word that one edit can destroy.

        An edit at letter ``i`` (replaced or deleted) or before it (inserted) leaves
        text[:i] and what follows as they are. A gram that it does not touch still
        stands unless a gram from its own place or an earlier one could reach over the
        edit (text[j:i] begins a longer gram), or one from before the edit could end
        behind it (what follows the edit begins with the tail of a gram).
        """
        text, most = FIRST + word + LAST, 0
        spans = [(p, p + len(g)) for p, g in grams]
        for i in range(1, len(text)):
            # The smallest place from which a gram may reach over the edit.
            over = [j for j in range(max(0, i - LONGEST + 1), i - SHORTEST + 1) if text[j:i] in self.heads]
            left = min(over, default=i)
            before = sum(e <= i and p >= left for p, e in spans)
            # Inserted before letter i, and letter i replaced or deleted.
            for start, touched in ((i, lambda p, e, i=i: p < i < e), (i + 1, lambda p, e, i=i: p <= i < e)):
                if start > i and i == len(text) - 1:
                    continue  # the end mark is not edited
                tails = [
                    e
                    for e in range(start + SHORTEST, min(start + LONGEST, len(text) + 1))
                    if text[start:e] in self.tails
                ]
                right = max(tails, default=0)
                behind = sum(p >= start and e <= right for p, e in spans)
                most = max(most, before + behind + sum(touched(p, e) for p, e in spans))
        return most


DECOMPOSED = T.StructType(
    [
        T.StructField("places", T.ArrayType(T.IntegerType())),
        T.StructField("grams", T.ArrayType(T.StringType())),
        T.StructField("affected", T.IntegerType()),
    ]
)


def decomposed(words: DataFrame, grams: list[str], word: Column) -> Column:
    shared = words.sparkSession.sparkContext.broadcast(sorted(grams))
    known: list[Decomposer] = []

    @F.arrow_udf(DECOMPOSED)
    def run(column: pa.Array) -> pa.Array:
        if not known:
            known.append(Decomposer(shared.value))
        rows = []
        for text in column.to_pylist():
            found = known[0].decompose(text)
            rows.append(
                {
                    "places": [p for p, _ in found],
                    "grams": [g for _, g in found],
                    "affected": known[0].affected(text, found),
                }
            )
        kind = pa.struct(
            [("places", pa.list_(pa.int32())), ("grams", pa.list_(pa.string())), ("affected", pa.int32())]
        )
        return pa.array(rows, kind)

    return run(word)


# --- pairs -----------------------------------------------------------------------


def near_pairs(words: DataFrame, threshold: int = THRESHOLD, max_grams: int = MAX_GRAMS) -> DataFrame:
    """(a, b): the words of ``words`` exactly one edit apart, each pair once, a the
    shorter or smaller one. ``words``: word, distinct."""
    grams = dictionary(words, threshold, max_grams)
    split = materialize(
        words.select("word", decomposed(words, grams, F.col("word")).alias("d")).select("word", "d.*"),
        "grams",
    )
    each = split.select(
        "word", "affected", F.inline(F.arrays_zip(F.col("places").alias("place"), F.col("grams").alias("gram")))
    ).toDF("word", "affected", "place", "gram")
    lists = materialize(each.groupBy("gram").agg(F.count("*").alias("n")), "gram-lists")
    # The rarest grams of each word, one more than an edit can destroy.
    rare = (
        each.join(lists, "gram")
        .groupBy("word")
        .agg(F.sort_array(F.collect_list(F.struct("n", "gram", "place"))).alias("g"), F.first("affected").alias("k"))
        .select("word", F.length("word").alias("len"), F.inline(F.slice("g", 1, F.col("k") + 1)))
    )
    rare = materialize(rare.select("word", "len", "gram", "place"), "rare-grams")
    shorter = rare.select(F.col("word").alias("a"), "gram", F.col("len").alias("at_len"), F.col("place").alias("at"))
    # A word of the same length has the gram at the same place; one letter longer, there
    # or one further on.
    longer = rare.select(
        F.col("word").alias("b"),
        "gram",
        F.inline(
            F.array(
                F.struct(F.col("len").alias("at_len"), F.col("place").alias("at")),
                F.struct((F.col("len") - 1).alias("at_len"), F.col("place").alias("at")),
                F.struct((F.col("len") - 1).alias("at_len"), (F.col("place") - 1).alias("at")),
            )
        ),
    )
    # One edit leaves the first or the second half of the shorter word as it is, which is
    # cheaper to see than the distance.
    half = F.floor(F.least(F.length("a"), F.length("b")) / 2).cast("int")
    halves = (F.left(F.col("a"), half) == F.left(F.col("b"), half)) | (F.right(F.col("a"), half) == F.right(F.col("b"), half))
    ordered = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
    near = ordered & halves & (F.levenshtein("a", "b", 1) == 1)
    merged = shorter.join(longer, ["gram", "at_len", "at"]).filter(near).select("a", "b")

    # Words that an edit may leave without a gram: they share a text with one letter less.
    weak = split.filter(F.col("affected") >= F.size("grams")).select("word")
    less = F.array_distinct(
        F.concat(
            F.array("word"),
            F.transform(
                F.sequence(F.lit(1), F.length("word")),
                lambda p: F.concat(F.col("word").substr(F.lit(1), p - 1), F.col("word").substr(p + 1, F.length("word"))),
            ),
        )
    )
    cut = materialize(weak.select("word", F.explode(less).alias("rest")), "weak-words")
    by_rest = cut.select(F.col("word").alias("a"), "rest").join(cut.select(F.col("word").alias("b"), "rest"), "rest")
    return materialize(merged.unionByName(by_rest.filter(near).select("a", "b")).distinct(), "near-words")


# --- forms and roots -------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last word, by doubling."""
    at = materialize(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = materialize(
            at.join(replicate(step), "root").select("word", F.col("next").alias("root"), F.col("root").alias("was")),
            "roots",
        )
        at = after.select("word", "root")
        if not after.filter("root <> was").take(1):
            return at


def group(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: int = THRESHOLD,
    max_grams: int = MAX_GRAMS,
) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word."""
    words = materialize(vocabulary(docs, id_col, text_col), "words")
    pairs = near_pairs(words.select("word"), threshold, max_grams)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"))
    )
    counted = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = counted.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other"))).alias("best"),
    )
    enough = -F.col("best.less") >= FORM_FACTOR * F.col("n")
    judged = materialize(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best.other")).alias("form"),
            F.when(enough, -F.col("best.less")).cast("long").alias("form_n"),
        ),
        "forms",
    )
    return judged.join(roots(judged), "word").select("word", "form", "root", "n", "n_near", "form_n")
