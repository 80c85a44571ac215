"""Personal data: fixed patterns, and contextual extraction bootstrapped from them.

1. Base spans: the four fixed patterns over whole texts, failing matches dropped. They
   are the seeds: instances of known kind.
2. Every other word that holds a digit or an "@" is a candidate instance, trimmed of
   punctuation. Instances have lexical patterns at several granularities: the shape of
   the instance itself (digit runs with their length, letter runs without); its first
   character and shape; the word before and the shape; two words before and the shape
   without lengths; the words on both sides.
3. Spark scores the pattern-instance graph round by round. A pattern's score for a kind
   is the share of its distinct instances that are known to be of the kind, shrunk by
   ``PRIOR`` unknown ones; it is trusted from ``MIN_SCORE`` on if ``MIN_KNOWN`` distinct
   known instances support it. An unknown instance's score is the noisy-or of its
   trusted patterns; from ``ACCEPT`` on it becomes known, of its best kind, and supports
   patterns in the next round as a seed does. Known instances stay known, so rounds end
   at a fixed point: when none is added.
4. Every occurrence of a discovered instance becomes a span of its kind. Base spans
   always stay.

Edges are combined per (pattern, instance) before anything else is grouped, so a hot
document, source or context sends one row per pair and map task. Instances and contexts
of any length count whole. NULL counts as the empty text. Repeated rows get the same
spans each, and count once as evidence. Extra columns are not read. Offsets count code
points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import materialize, replicate, text_or_empty, texts_of

KINDS = ("email", "ip", "card", "phone")
PRIOR = 1.0
MIN_SCORE = 0.7
MIN_KNOWN = 3
ACCEPT = 0.75

# What the four kinds look like. A digit run is tried from its start
# only, since a later start in the same run fails as well.
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SHAPE = re.compile(r"[0-9]+|[^\W\d_]+", re.UNICODE)
CLUE = re.compile(r"[0-9@]")
EDGE = re.compile(r"\s")
NEXT_WORD = re.compile(r"\s*(\S*)")
RUN = re.compile(r"[0-9]+")

SPAN = T.StructType(
    [
        T.StructField("kind", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)
CANDIDATES = T.StructType(
    [
        T.StructField("kind", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("instance", T.LongType()),
        T.StructField("patterns", T.ArrayType(T.LongType())),
    ]
)
FOUND = T.StructType(
    [
        T.StructField("base", T.ArrayType(SPAN)),
        T.StructField("candidates", T.ArrayType(CANDIDATES)),
    ]
)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str):
    """Leftmost matches, each looked for from its "@" outward."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL_CHARS:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            floor = domain.end()
            yield start, floor
        at = text.find("@", max(at + 1, floor))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end), by start, then kind."""
    spans = [(0, *span) for span in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        # Leading zeros go first: Python refuses to convert very long digit runs.
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (q.lstrip("0") for q in m[0].split("."))):
            spans.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                spans.append((3, m.start(), m.end()))
    return sorted(spans, key=lambda s: (s[1], s[0]))


def number(*parts: str) -> int:
    digest = hashlib.blake2b("\x1f".join(parts).encode("utf-8", "replace"), digest_size=8)
    return int.from_bytes(digest.digest(), "big", signed=True)


def shape(instance: str) -> str:
    return SHAPE.sub(lambda m: f"0{{{len(m[0])}}}" if m[0][0].isdigit() else "a", instance)


def words_before(text: str, start: int, n: int) -> list[str]:
    """The ``n`` words before a place, nearest last; fewer at the beginning."""
    out: list[str] = []
    at = start
    while len(out) < n:
        while at and text[at - 1].isspace():
            at -= 1
        if not at:
            break
        end = at
        while at and not text[at - 1].isspace():
            at -= 1
        out.insert(0, text[at:end].lower())
    return out


def patterns_of(text: str, start: int, end: int) -> list[int]:
    """The lexical patterns of a span, from the plainest to the most specific."""
    instance = text[start:end]
    own, rough = shape(instance), RUN.sub("0", SHAPE.sub(lambda m: "0" if m[0][0].isdigit() else "a", instance))
    left = words_before(text, start, 2)
    behind = NEXT_WORD.match(text, end)[1].lower()
    out = [number("shape", own), number("lead", instance[:1], own)]
    if left:
        out.append(number("before", left[-1], own))
        out.append(number("around", left[-1], behind))
    if len(left) == 2:
        out.append(number("two before", *left, rough))
    return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple]:
    """(kind number or -1, start, end, instance, patterns) of base and other spans."""
    out = [(kind, s, e, number(text[s:e]), patterns_of(text, s, e)) for kind, s, e in base]
    starts, ends, reach = [], [], 0
    for _, s, e in base:
        reach = max(reach, e)
        starts.append(s)
        ends.append(reach)
    for s, e in identifier_words(text):
        i = bisect_right(starts, e - 1)
        if i and ends[i - 1] > s:
            continue
        out.append((-1, s, e, number(text[s:e]), patterns_of(text, s, e)))
    return out


def identifier_words(text: str):
    """Words with a digit or an "@", without punctuation at their ends, found from the
    first such character outward."""
    m = CLUE.search(text)
    floor = 0
    while m:
        low = m.start()
        while low > floor and not text[low - 1].isspace():
            low -= 1
        edge = EDGE.search(text, m.start())
        high = floor = edge.start() if edge else len(text)
        s, e = low, high
        while s < e and not (text[s].isalnum() or text[s] in "+@"):
            s += 1
        while e > s and not text[e - 1].isalnum():
            e -= 1
        if s < e:
            yield s, e
        m = CLUE.search(text, high)


def extract(text: Column) -> Column:
    """``FOUND`` of each text: base spans, and candidates with their patterns."""

    @F.arrow_udf(FOUND)
    def found(texts: pa.Array) -> pa.Array:
        base, more = [], []
        for text in texts_of(texts):
            spans = base_spans(text)
            base.append([dict(zip(SPAN.names, s)) for s in spans])
            more.append([dict(zip(CANDIDATES.names, c)) for c in candidates(text, spans)])
        span = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
        candidate = pa.struct([*span, ("instance", pa.int64()), ("patterns", pa.list_(pa.int64()))])
        return pa.StructArray.from_arrays(
            [pa.array(base, pa.list_(span)), pa.array(more, pa.list_(candidate))], FOUND.names
        )

    return found(text)


def discover(
    edges: DataFrame,
    prior: float = PRIOR,
    min_score: float = MIN_SCORE,
    min_known: int = MIN_KNOWN,
    accept: float = ACCEPT,
) -> DataFrame:
    """(instance, kind, round) of the instances found to be of a kind.

    ``edges``: pattern, instance, kind (-1: unknown), any number of times. An instance
    that is a seed anywhere is one everywhere.
    """
    pairs = edges.groupBy("pattern", "instance").agg(F.max("kind").alias("kind"))
    pairs = materialize(pairs, "pii-edges")
    size = materialize(pairs.groupBy("pattern").agg(F.count("*").alias("n")), "pii-patterns")
    seeds = pairs.groupBy("instance").agg(F.max("kind").alias("kind")).filter("kind >= 0")
    known = newly = materialize(seeds.withColumn("round", F.lit(0)), "pii-known")
    unknown = materialize(
        pairs.select("pattern", "instance").join(seeds.select("instance"), "instance", "left_anti"), "pii-unknown"
    )
    support, rounds = None, 0
    while True:
        # Only what became known in the last round adds to the support.
        told = (
            pairs.select("pattern", "instance")
            .join(replicate(newly.select("instance", "kind")), "instance")
            .groupBy("pattern", "kind")
            .agg(F.count("*").alias("n_known"))
        )
        if support is not None:
            told = support.unionByName(told).groupBy("pattern", "kind").agg(F.sum("n_known").alias("n_known"))
        support = materialize(told, "pii-support")
        rounds += 1
        trusted = (
            support.filter(F.col("n_known") >= min_known)
            .join(size, "pattern")
            .withColumn("score", F.col("n_known") / (F.col("n") + F.lit(prior)))
            .filter(F.col("score") >= min_score)
            .select("pattern", "kind", "score")
        )
        trusted = materialize(trusted, "pii-trusted")
        scored = (
            unknown.join(replicate(trusted), "pattern")
            .groupBy("instance", "kind")
            .agg((1 - F.exp(F.sum(F.log1p(-F.least(F.col("score"), F.lit(0.999)))))).alias("score"))
            .filter(F.col("score") >= accept)
            .groupBy("instance")
            .agg(F.max(F.struct("score", (-F.col("kind")).alias("less"))).alias("best"))
        )
        found = scored.select("instance", (-F.col("best.less")).alias("kind"))
        newly = materialize(
            found.join(replicate(known.select("instance")), "instance", "left_anti").withColumn("round", F.lit(rounds)),
            "pii-found",
        )
        if not newly.take(1):
            return known.filter("round > 0")
        known = materialize(known.unionByName(newly), "pii-known")


def _digest(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    ordered = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")
            ),
        )
    )
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            ordered,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]),
        ),
        ",",
    )


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **scoring) -> DataFrame:
    """Per document: id, base spans, and spans of discovered instances.

    Texts are read once; all that follows runs on the written spans.
    """
    spans = materialize(
        docs.select(F.col(f"`{id_col}`").alias("doc_id"), extract(text_or_empty(text_col)).alias("f"))
        .select("doc_id", "f.base", "f.candidates")
        .withColumn("row", F.monotonically_increasing_id()),
        "pii-spans",
    )
    each = spans.filter(F.size("candidates") > 0).select("row", F.inline("candidates"))
    edges = each.select("instance", "kind", F.explode("patterns").alias("pattern"))
    found = discover(edges, **scoring)
    added = (
        each.filter("kind < 0")
        .drop("kind", "patterns")
        .join(replicate(found.select("instance", "kind")), "instance")
        .groupBy("row")
        .agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    )
    empty = F.array().cast(T.ArrayType(SPAN))
    return spans.join(added, "row", "left").select(
        "doc_id", "base", F.coalesce("added", empty).alias("added")
    )


def report(found: DataFrame) -> DataFrame:
    """The digest columns of ``find``'s result."""

    def count(kind: int) -> Column:
        # One parameter: Spark passes the place in the array to a second one.
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(_digest(F.col("base")), 256).alias("base_sha256"),
        _digest(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )
