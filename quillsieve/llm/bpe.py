"""Byte-level BPE encoding and decoding.

Two tiers: a minimal perfect hash finds pre-tokens that are in the vocabulary as a whole; the
others are merged with a heap of adjacent pairs over a linked list of bytes, O(n log n) for a
pre-token of n bytes. Work is done once per distinct pre-token of a slice of texts; the ids of
all texts are then gathered with numpy. Nothing is shuffled.

Defined results: a null text is an empty one, an empty text has no ids; other columns, repeated
rows and ties are left as they are; a column with the name of an output is replaced.
"""

from __future__ import annotations

import base64
import struct
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsieve.llm.arrays import add_columns, binary, bounds, mix, quoted, ragged, remember

#: Code points with the Unicode property White_Space (fixed values).
WHITE_SPACE = r"\t-\r\x20\x85\xa0  -     　"
#: Remembered pre-tokens of a Python worker.
MEMORY = 200_000


class PerfectHash:
    """Minimal perfect hash of byte strings: n keys, n slots, by hash and displace.

    Buckets of about four keys get, largest first, the smallest displacement that sends all of
    their keys to free slots; a bucket of one key names its slot directly.
    """

    def __init__(self, keys: list[bytes]):
        n = self.n = len(keys)
        self.buckets = max(1, n // 4)
        hashes = self.hashes(keys)
        home = (hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        cuts = np.searchsorted(home[order], np.arange(self.buckets + 1))
        self.shift = np.zeros(self.buckets, np.int64)
        self.slot = np.full(n, -1, np.int64)
        free = np.ones(n, bool)
        sizes = np.diff(cuts)
        for b in np.argsort(-sizes, kind="stable"):
            if sizes[b] <= 1:
                break
            own = order[cuts[b] : cuts[b + 1]]
            d = 0
            while True:  # 64 displacements at a time
                tried = np.sort(self.place(hashes[own], np.arange(d, d + 64)[:, None]), axis=1)
                good = free[tried].all(axis=1) & (tried[:, 1:] != tried[:, :-1]).all(axis=1)
                if good.any():
                    break
                d += 64
            d += int(good.argmax())
            at = self.place(hashes[own], np.full(len(own), d, np.int64))
            self.shift[b] = d
            free[at] = False
            self.slot[at] = own
        left = iter(np.flatnonzero(free).tolist())
        for b in np.flatnonzero(sizes == 1):
            at = next(left)
            self.shift[b] = -1 - at
            self.slot[at] = order[cuts[b]]

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        digest = xxhash.xxh3_64_intdigest
        return np.fromiter((digest(k) for k in keys), np.uint64, len(keys))

    def place(self, hashes: np.ndarray, shift: np.ndarray) -> np.ndarray:
        moved = (mix(hashes + shift.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(max(1, self.n))).astype(np.int64)
        return np.where(shift < 0, -1 - shift, moved)

    def find(self, keys: list[bytes]) -> np.ndarray:
        """For each key the number of the only key that it can be; the caller compares."""
        h = self.hashes(keys)
        return self.slot[self.place(h, self.shift[(h % np.uint64(self.buckets)).astype(np.int64)])]


class Vocabulary:
    """Ranks of a tiktoken file, their perfect hash and the pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.tokens = [base64.b64decode(a) for a, _ in pairs]
        self.ids = np.array([int(b) for _, b in pairs], np.int64)
        self.ranks = dict(zip(self.tokens, self.ids.tolist()))
        self.longest = max(map(len, self.tokens))
        self.hash = PerfectHash(self.tokens)
        # The pattern's white space is the Unicode property, as in Rust.
        self.pattern = pattern.replace(r"[^\s", f"[^{WHITE_SPACE}").replace(r"\s", f"[{WHITE_SPACE}]").replace(r"(?!\S)", f"(?![^{WHITE_SPACE}])")
        by_id: list[bytes] = [b""] * (int(self.ids.max()) + 1)
        for token, i in self.ranks.items():
            by_id[i] = token
        self.text_off = np.concatenate([[0], np.cumsum([len(t) for t in by_id])]).astype(np.int64)
        self.text = np.frombuffer(b"".join(by_id), np.uint8)
        self.known: dict[bytes, bytes] = {}  # packed ids; a Python worker's, over its tasks

    def merge(self, word: bytes) -> list[int]:
        """Merge the pair of lowest rank, leftmost first, until none is left."""
        ranks, longest, n = self.ranks, self.longest, len(word)
        if n < 2:
            return [ranks[word]] if n else []
        end = list(range(1, n + 1))  # of the piece that starts at i; 0: merged away
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, stop = heappop(heap)
            j = end[i]
            if not j or j >= n or end[j] != stop:
                continue
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
                last = end[stop]
                if last - i <= longest and (r := ranks.get(word[i:last])) is not None:
                    heappush(heap, (r, i, last))
            k = before[i]
            if k >= 0 and stop - k <= longest and (r := ranks.get(word[k:stop])) is not None:
                heappush(heap, (r, k, stop))
        ids, i = [], 0
        while i < n:
            ids.append(ranks[word[i : end[i]]])
            i = end[i]
        return ids

    def resolve(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of distinct pre-tokens; those of earlier slices are remembered."""
        remember(self.known, words, MEMORY, self.pack)
        return [self.known[w] for w in words]

    def pack(self, words: list[bytes]) -> list[bytes]:
        found = self.hash.find(words).tolist()
        ids = [[int(self.ids[slot])] if self.tokens[slot] == word else self.merge(word) for word, slot in zip(words, found)]
        return [struct.pack(f"<{len(x)}I", *x) for x in ids]


def _encoder(shared):
    def make(arr: pa.Array) -> list[pa.Array]:
        voc = shared.value
        split = regex.compile(voc.pattern).findall
        pieces: list[str] = []
        ends = [0]
        for text in arr.to_pylist():
            if text:
                pieces += split(text)
            ends.append(len(pieces))
        coded = pa.array(pieces, pa.large_string()).dictionary_encode() if pieces else None
        del pieces
        if coded is None:
            return [binary(np.zeros(len(arr) + 1, np.int64), np.zeros(0, np.uint8))]
        index = coded.indices.to_numpy(zero_copy_only=False)
        found = voc.resolve(coded.dictionary.cast(pa.large_binary()).to_pylist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<u4")
        starts = np.cumsum(sizes) - sizes
        ids = flat[ragged(starts[index], sizes[index])]
        upto = np.concatenate([[0], np.cumsum(sizes[index])])[ends]
        return [binary(upto * 4, ids.astype("<u4").view(np.uint8))]

    return make


def _decoder(shared):
    def make(arr: pa.Array) -> list[pa.Array]:
        voc = shared.value
        off, data = bounds(arr)
        ids = np.ascontiguousarray(data).view("<u4").astype(np.int64)
        lens = np.diff(voc.text_off)[ids]
        raw = voc.text[ragged(voc.text_off[ids], lens)]
        return [binary(np.concatenate([[0], np.cumsum(lens)])[off // 4], raw)]

    return make


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", out: str = "ids") -> DataFrame:
    """df with ``out``: the ids of ``text`` as little-endian unsigned 32-bit integers."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)  # bound: the vocabulary file
    return add_columns(df, quoted(text).cast("string"), _encoder(shared), [T.StructField(out, T.BinaryType())])


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """df with ``out``: the bytes that the packed ``ids`` stand for."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    return add_columns(df, quoted(ids), _decoder(shared), [T.StructField(out, T.BinaryType())])


def round_trip(df: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encode``, then ``decode`` of its ids, by one Python worker a task and not by two."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    encoder, decoder = _encoder(shared), _decoder(shared)

    def make(arr: pa.Array) -> list[pa.Array]:
        (packed,) = encoder(arr)
        return [packed, *decoder(packed)]

    return add_columns(df, quoted(text).cast("string"), make, [T.StructField(ids, T.BinaryType()), T.StructField(decoded, T.BinaryType())])


def digests(df: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of ``documents``."""
    back = round_trip(df.select("doc_id", "text"), vocabulary)
    return back.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
