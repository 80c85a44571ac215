"""Byte-level BPE encoding and decoding with a public vocabulary file.

A text is cut at the strings of added tokens, then by the GPT-2 pattern into
words. A word of at most ``SHORT_WORD`` bytes is merged in a contiguous rank
array: part boundaries (here the part ids) and the merge ranks of adjacent parts
lie in two lists; the smallest rank is found by a scan, its boundary deleted, and
the two neighbouring ranks looked up anew. That is quadratic in the word, so longer
words take a heap over linked parts: the same merges in the same order, whatever
their length. Merged words are remembered per Python worker, up to a bound.

NULL texts count as empty: no tokens, and the empty text decoded. Texts are
encoded whole; very long ones pass in pieces cut where no word can span.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import texts_of

# Fixed value: the pattern that byte-level vocabularies of this family split by.
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# A space between two visible characters always begins a word.
SAFE_CUT = regex.compile(r"(?<=\S) (?=\S)")
PIECE_CHARS = 1 << 20
SHORT_WORD = 96
REMEMBERED_WORDS = 300_000
REMEMBERED_BYTES = 48
NO_MERGE = 1 << 60


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> list[str]:
    """The visible character that stands for each byte in the vocabulary file."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class Codec:
    """Encodes and decodes as the vocabulary file says."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, splitter = spec["model"], spec["pre_tokenizer"] or {}
        supported = (
            model["type"] == "BPE"
            and spec["normalizer"] is None
            and splitter.get("type") == "ByteLevel"
            and not splitter["add_prefix_space"]
            and splitter["use_regex"]
        )
        if not supported:
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        letters = byte_letters()
        byte_of = {letter: b for b, letter in enumerate(letters)}
        vocab = model["vocab"]
        self.byte_ids = [vocab[letter] for letter in letters]
        self.table: dict[int, bytes] = {
            i: bytes(byte_of[c] for c in token) for token, i in vocab.items()
        }
        self.pair_rank: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.pair_rank.setdefault((vocab[left], vocab[right]), rank)
            self.merged.append(vocab[left + right])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.table.update({i: text.encode() for text, i in self.added.items()})
        self.lengths = np.zeros(max(self.table) + 1, dtype=np.int64)
        for i, token in self.table.items():
            self.lengths[i] = len(token)
        longest_first = sorted(self.added, key=len, reverse=True)
        self.added_pattern = (
            regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")")
            if self.added
            else None
        )
        self.memory = _Memory(self)

    def merge(self, word: bytes) -> list[int]:
        parts = [self.byte_ids[b] for b in word]
        return self._scan(parts) if len(parts) <= SHORT_WORD else self._heap(parts)

    def _scan(self, parts: list[int]) -> list[int]:
        rank_of = self.pair_rank.get
        ranks = [rank_of(pair, NO_MERGE) for pair in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == NO_MERGE:
                break
            i = ranks.index(least)
            parts[i] = self.merged[least]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of((parts[i - 1], parts[i]), NO_MERGE)
            if i < len(ranks):
                ranks[i] = rank_of((parts[i], parts[i + 1]), NO_MERGE)
        return parts

    def _heap(self, parts: list[int]) -> list[int]:
        n, rank_of = len(parts), self.pair_rank.get
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [
            (rank, i)
            for i, pair in enumerate(zip(parts, parts[1:]))
            if (rank := rank_of(pair)) is not None
        ]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j >= n or rank_of((parts[i], parts[j])) != rank:
                continue
            parts[i], parts[j] = self.merged[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (rank := rank_of((parts[i], parts[k]))) is not None:
                    heapq.heappush(heap, (rank, i))
            h = before[i]
            if h >= 0 and (rank := rank_of((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (rank, h))
        return [p for p in parts if p >= 0]

    def pieces(self, text: str):
        """(piece, id of the added token it is, or None), in order."""
        cut = self.added_pattern.split(text) if self.added_pattern else [text]
        for i, part in enumerate(cut):
            if i % 2:
                yield part, self.added[part]
                continue
            start = 0
            while len(part) - start > PIECE_CHARS:
                at = SAFE_CUT.search(part, start + PIECE_CHARS)
                if not at:
                    break
                yield part[start : at.start()], None
                start = at.start()
            if start < len(part):
                yield part[start:], None

    def encode_bytes(self, text: str) -> bytes:
        """Token ids of the whole text as little-endian unsigned 32-bit integers."""
        out, remembered = [], self.memory.__getitem__
        for piece, token in self.pieces(text):
            if token is None:
                out.append(b"".join(map(remembered, WORDS.findall(piece))))
            else:
                out.append(token.to_bytes(4, "little"))
        return b"".join(out)

    def decode_bytes(self, ids: list[int]) -> bytes:
        table = self.table
        return b"".join([table[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


class _Memory(dict):
    """Word to packed ids; starts anew when full, so its size is bounded."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec

    def __missing__(self, word: str) -> bytes:
        data = word.encode("utf-8")
        packed = np.array(self.codec.merge(data), dtype="<u4").tobytes()
        if len(data) <= REMEMBERED_BYTES:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            self[word] = packed
        return packed


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def unpack(packed: bytes) -> list[int]:
    return np.frombuffer(packed, "<u4").tolist()


def encode(text: Column, vocabulary: str | None = None) -> Column:
    """Token ids of each text, array<int>."""
    path = vocabulary or default_vocabulary()

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids(texts: pa.Array) -> pa.Array:
        packed = [codec(path).encode_bytes(t) for t in texts_of(texts)]
        return _ids(packed)

    return ids(text)


def decode(ids: Column, vocabulary: str | None = None) -> Column:
    """Text of each array of token ids; NULL counts as no ids."""
    path = vocabulary or default_vocabulary()

    @F.arrow_udf(T.StringType())
    def texts(arrays: pa.Array) -> pa.Array:
        return pa.array([codec(path).decode(a or []) for a in arrays.to_pylist()], pa.string())

    return texts(ids)


DIGEST = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)
ENCODED = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), *DIGEST.fields])


def _ids(packed: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(p) // 4 for p in packed)]).astype("int32")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), "<i4")))


def _digests(path: str, packed: list[bytes]) -> list[pa.Array]:
    """Columns of ``DIGEST``; the ids are decoded for the last one."""
    back = (codec(path).decode(unpack(p)).encode("utf-8") for p in packed)
    return [
        pa.array([len(p) // 4 for p in packed], pa.int64()),
        pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
        pa.array([hashlib.sha256(b).hexdigest() for b in back], pa.string()),
    ]


def round_trip(text: Column, vocabulary: str | None = None) -> Column:
    """Encodes and decodes each text; count of tokens, digest of the ids, digest of
    the decoded text. Ids stay in the task: only the digests leave it."""
    path = vocabulary or default_vocabulary()

    @F.arrow_udf(DIGEST)
    def digests(texts: pa.Array) -> pa.Array:
        packed = [codec(path).encode_bytes(t) for t in texts_of(texts)]
        return pa.StructArray.from_arrays(_digests(path, packed), DIGEST.names)

    return digests(text)


def encode_and_check(text: Column, vocabulary: str | None = None) -> Column:
    """Token ids of each text and the digests of ``round_trip``, from one encoding."""
    path = vocabulary or default_vocabulary()

    @F.arrow_udf(ENCODED)
    def encoded(texts: pa.Array) -> pa.Array:
        packed = [codec(path).encode_bytes(t) for t in texts_of(texts)]
        return pa.StructArray.from_arrays([_ids(packed), *_digests(path, packed)], ENCODED.names)

    return encoded(text)
