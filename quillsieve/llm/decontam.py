"""Benchmark decontamination by templates.

Words lose the punctuation around them and their case; numbers, units and names become typed
placeholders, so a question whose numbers or names were exchanged has the template of the
original. Each occurrence decides for itself: a capitalised word is a name, and one that begins a
sentence is read both as a name and as a plain word, so the text around a passage changes nothing.
Windows without placeholders are matched too.

1. The windows of WINDOW template words of all items are a table (kind, hash, item, place).
2. Documents are scanned once, whatever the number of items. A Bloom filter of the items' hashes
   (bounded by FILTER_BITS) lets few other windows through; these rows hold the window's words.
3. Both are hash-joined by Spark. Rows of one document, item and alignment meet; an alignment has
   at most the item's windows. Windows are verified word by word, and the slots must be consistent:
   one value of the item stands for one value of the text.
4. An item counts as found where consistent windows, ENOUGH or half of all its windows, agree on
   an alignment.

Texts are not shuffled, and what reaches the driver or a broadcast is the filter. The join is a
plain equi-join, which adaptive execution splits where a passage stands in very many documents.

Defined results: a null text has no words; an item of fewer than WINDOW words is one window, and
one of fewer than LEAST is found only where all its words stand as they are; items without a word
or without an id are never found; a template window with fewer than LITERALS words besides its
placeholders proves nothing (a window of plain words always counts); one row for each document id,
text and item, so equal rows give one; a null doc_id is a document like any other; extra columns
are kept by ``clean`` and ignored by ``found``.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.llm.arrays import Words, mix, quoted, remember, steps
from quillsieve.llm.tables import Scratch

WINDOW, LEAST, LITERALS, ENOUGH = 8, 4, 4, 6
#: Bits of the filter: as many for each hash, and at most (128 MB).
BITS_EACH, FILTER_BITS = 32, 1 << 30
#: Windows that are hashed at once, so that they stay in a core's cache.
BLOCK = 1 << 15
#: Remembered words of a Python worker.
MEMORY = 200_000

UNITS = set(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds ton tons "
    "ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years "
    "cent cents dollar dollars euro euros percent degree degrees meter meters metre metres kilometer kilometers kilometre kilometres".split()
)
NUMBERS = set("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split())
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:%|st|nd|rd|th)?\Z")
_MEASURE = re.compile(r"[+-]?\d[\d.,]*([a-z]+)\Z")
_TRIM = re.compile(r"^[\W_]+|[\W_]+$")
#: Some of the characters that _TRIM removes.
_MARKS = "".join(c for c in map(chr, range(128)) if not c.isalnum()) + "«»“”„‘’–—…"
_CLOSERS, _ENDS = "\"')]»”’", (".", "!", "?", ":")
LITERAL, NUMBER, UNIT, MEASURE, NAME = range(5)
_WORD_KINDS = dict.fromkeys(UNITS, UNIT) | dict.fromkeys(NUMBERS, NUMBER)
_SLOT = mix(np.arange(1, 6, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def describe(word: bytes) -> tuple[int, int, bool, bool, bool, bytes]:
    """(hash, kind, capitalised, ends a sentence, has content, core) of a word."""
    raw = word.decode("utf-8", "replace")
    core = raw.strip(_MARKS)
    if core.isalpha():  # nothing more to trim, and no digit; most words are like this
        low = core.lower()
        data = low.encode()
        ends = len(core) < len(raw) and raw.rstrip(_CLOSERS)[-1:] in _ENDS
        return xxhash.xxh3_64_intdigest(data), _WORD_KINDS.get(low, LITERAL), core[0].isupper(), ends, True, data
    core = _TRIM.sub("", raw)
    low = core.lower()
    kind = LITERAL
    if _NUMBER.match(low) or low in NUMBERS:
        kind = NUMBER
    elif low in UNITS:
        kind = UNIT
    elif (m := _MEASURE.match(low)) and m[1] in UNITS:
        kind = MEASURE
    data = low.encode()
    return xxhash.xxh3_64_intdigest(data), kind, core[:1].isupper(), raw.rstrip(_CLOSERS)[-1:] in _ENDS, bool(core), data


_RECORD = np.dtype([("hash", "<u8"), ("kind", "i1"), ("capital", "?"), ("ends", "?"), ("some", "?")])
_PACK = struct.Struct("<Qb???").pack
_KNOWN: dict[bytes, bytes] = {}


def _described(words: list[bytes]) -> np.ndarray:
    """A record for each word; those of earlier slices are remembered."""
    remember(_KNOWN, words, MEMORY, lambda fresh: [_PACK(*describe(w)[:5]) for w in fresh])
    return np.frombuffer(b"".join([_KNOWN[w] for w in words]), _RECORD)


class Templates:
    """Template words of some texts: off (first of each text), name, kind and core.

    Readings: 0 takes every capitalised word for a name, 2 those inside a sentence; 1 is plain words.
    """

    def __init__(self, arr: pa.Array):
        w = Words(arr)
        codes, distinct = w.codes()
        found = _described(distinct)
        hashes, kinds, capital, ends, some = (found[k][codes] for k in _RECORD.names)
        doc = np.repeat(np.arange(len(arr)), w.counts)
        first = np.ones(len(codes), bool)
        first[1:] = ends[:-1] | (doc[1:] != doc[:-1])
        able = capital & (kinds == LITERAL)
        inside = np.where(able & ~first, NAME, kinds)
        kinds = np.where(able, NAME, kinds)
        keep = np.flatnonzero(some)
        self.off = np.searchsorted(keep, w.off)
        self.kind = kinds[keep]
        self.kinds = {0: self.kind, 2: inside[keep]}
        plain = hashes[keep]
        self.names = {1: plain} | {k: np.where(v == LITERAL, plain, _SLOT[v]) for k, v in self.kinds.items()}
        self.codes, self.distinct = codes[keep], distinct

    def core(self, i: int) -> bytes:
        return describe(self.distinct[self.codes[i]])[5]

    def hashes(self, width: int, reading: int) -> Iterator[tuple[int, np.ndarray]]:
        """(first place, hashes) of the windows at all places, BLOCK by BLOCK; those across the end
        of a text among them.

        Two halves make a hash of twice the words; two that overlap make the last one.
        """
        name = self.names[reading]
        for lo in range(0, len(name) - width + 1, BLOCK):
            sums, size = mix(name[lo : lo + BLOCK + width - 1]), 1
            while size < width:
                shift = min(size, width - size)
                sums = mix(sums[:-shift] * np.uint64(0x9FB21C651E98DF25) + sums[shift:])
                size += shift
            yield lo, sums

    def inside(self, at: np.ndarray, width: int) -> np.ndarray:
        """(text of each window at these places, whether it lies within the text)."""
        doc = np.searchsorted(self.off, at, side="right")
        return doc - 1, at + width <= self.off[np.minimum(doc, len(self.off) - 1)]

    def windows(self, width: int, reading: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of the windows that lie within one text."""
        sums = np.concatenate([np.zeros(0, np.uint64), *(h for _, h in self.hashes(width, reading))])
        at = np.flatnonzero(self.inside(np.arange(len(sums)), width)[1])
        return at, sums[at]


class Filter:
    """A Bloom filter of 64-bit hashes with four probes; more hashes than the bound is made for
    only let more other windows through."""

    def __init__(self, n: int):
        self.bits = 1 << 16
        while self.bits < min(BITS_EACH * n, FILTER_BITS):
            self.bits *= 2
        self.data = np.zeros(self.bits // 8, np.uint8)

    def places(self, hashes: np.ndarray, k: int) -> np.ndarray:
        if k < 2:  # the halves of a hash, whose bits are mixed already
            return (hashes >> np.uint64(32 * k) & np.uint64(self.bits - 1)).astype(np.int64)
        return (mix(hashes + np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) & np.uint64(self.bits - 1)).astype(np.int64)

    def add(self, hashes: np.ndarray) -> None:
        for k in range(4):
            at = self.places(hashes, k)
            np.bitwise_or.at(self.data, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def passing(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the hashes that may have been added."""
        left = np.arange(len(hashes))
        for k in range(4):
            at = self.places(hashes[left], k)
            left = left[self.data[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1]
        return left


WORDS = pa.list_(pa.struct([("kind", pa.int8()), ("core", pa.binary())]))
ITEMS = "item_id long, iid long, width int, total int, words array<struct<kind:tinyint,core:binary>>, windows array<struct<kind:int,hash:long,q:int>>"
HITS = "doc_id long, tid long, kind int, hash long, p int, words array<struct<kind:tinyint,core:binary>>"
FOUND = "doc_id long, tid long, item_id long, iid long, n_windows long, share double, same boolean"


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns item_id, iid, text to ITEMS: an item's words and its windows of all readings."""
    for batch in batches:
        for part in steps(batch, 2):
            t = Templates(part.column(2))
            at: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
            rows = []
            for i in range(len(part)):
                lo, hi = int(t.off[i]), int(t.off[i + 1])
                width = min(WINDOW, hi - lo)
                found = []
                for reading in (0, 1, 2) if width >= LEAST else (1,) if width else ():
                    if (width, reading) not in at:
                        at[width, reading] = t.windows(width, reading)
                    places, hashes = at[width, reading]
                    a, b = np.searchsorted(places, (lo, hi - width + 1))
                    for p, h in zip(places[a:b].tolist(), hashes[a:b].view(np.int64).tolist()):
                        if reading == 1 or (t.kinds[reading][p : p + width] == LITERAL).sum() >= min(LITERALS, width):
                            found.append({"kind": 4 * width + reading, "hash": h, "q": p - lo})
                rows.append((width, hi - lo - width + 1, [{"kind": int(t.kind[j]), "core": t.core(j)} for j in range(lo, hi)], found))
            width, total, words, windows = zip(*rows)
            kind = pa.list_(pa.struct([("kind", pa.int32()), ("hash", pa.int64()), ("q", pa.int32())]))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(width, pa.int32()), pa.array(total, pa.int32()), pa.array(words, WORDS), pa.array(windows, kind)], ["item_id", "iid", "width", "total", "words", "windows"])


def _passing(sent: Filter, t: Templates, width: int, reading: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the windows that the filter lets through."""
    at, own = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for lo, hashes in t.hashes(width, reading):
        hit = sent.passing(hashes)
        at.append(lo + hit)
        own.append(hashes[hit])
    return np.concatenate(at), np.concatenate(own)


def _hit_rows(shared, kinds: list[int]):
    """Columns doc_id, tid, text to HITS: windows that the filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, 2):
                t = Templates(part.column(2))
                for kind in kinds:
                    at, own = _passing(shared.value, t, kind // 4, kind % 4)
                    doc, within = t.inside(at, kind // 4)
                    at, own, doc = at[within], own[within], doc[within]
                    if not len(at):
                        continue
                    words = [[{"kind": int(t.kind[j]), "core": t.core(j)} for j in range(p, p + kind // 4)] for p in at.tolist()]
                    ids = [part.column(k).take(pa.array(doc)) for k in (0, 1)]
                    yield pa.RecordBatch.from_arrays([*ids, pa.array(np.full(len(at), kind, np.int32)), pa.array(own.view(np.int64)), pa.array((at - t.off[doc]).astype(np.int32)), pa.array(words, WORDS)], ["doc_id", "tid", "kind", "hash", "p", "words"])

    return run


def consistent(words: list[dict], windows: list[dict]) -> tuple[int, bool]:
    """Of the windows on one alignment, those whose words are equal and whose slots contradict none
    before; and whether all slots have the item's values."""
    value: dict[tuple[int, bytes], bytes] = {}
    good, same, seen = 0, True, set()
    for w in sorted(windows, key=lambda w: w["q"]):
        if w["q"] in seen:  # by another reading
            continue
        seen.add(w["q"])
        new: dict[tuple[int, bytes], bytes] = {}
        for item, there in zip(words[w["q"] :], w["words"]):
            kind, core = item["kind"], item["core"]
            if core != there["core"] and (kind == LITERAL or kind != there["kind"]):
                break
            if kind != LITERAL and value.get((kind, core), new.setdefault((kind, core), there["core"])) != there["core"]:
                break
        else:
            value |= new
            good += 1
            same &= all(k[1] == v for k, v in new.items())
    return good, same


def _judged_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns doc_id, tid, item_id, iid, total, words, windows to FOUND."""
    names = [f.split()[0] for f in FOUND.split(", ")]
    for batch in batches:
        total = batch.column(4).to_pylist()
        judged = [consistent(words, windows) for words, windows in zip(batch.column(5).to_pylist(), batch.column(6).to_pylist())]
        enough = [i for i, (good, _) in enumerate(judged) if good >= min(ENOUGH, -(-total[i] // 2))]
        if enough:
            at = pa.array(enough)
            made = [pa.array([judged[i][0] for i in enough], pa.int64()), pa.array([judged[i][0] / total[i] for i in enough]), pa.array([judged[i][1] for i in enough])]
            yield pa.RecordBatch.from_arrays([*[batch.column(k).take(at) for k in range(4)], *made], names)


def _filter(windows: DataFrame) -> Filter:
    """A filter of all hashes; they come to the driver batch by batch."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([np.asarray(batch.column(0)).tobytes()], pa.binary())], ["h"])

    out = Filter(windows.count())
    for row in windows.select("hash").mapInArrow(pack, "h binary").toLocalIterator():
        out.add(np.frombuffer(row["h"], np.uint64))
    return out


def _found(df: DataFrame, benchmark: DataFrame, text: str, doc_id: str, scratch: Scratch) -> DataFrame:
    """FOUND, one row for each document id, text and item."""
    spark = df.sparkSession
    body = quoted(text).cast("string")
    asked = benchmark.select(quoted("item_id").cast("long").alias("item_id"), F.xxhash64(quoted("text")).alias("iid"), quoted("text").cast("string").alias("text")).where("item_id is not null").dropDuplicates(["item_id", "iid"])
    items = scratch.cut(asked.mapInArrow(_item_rows, ITEMS), "items")
    windows = scratch.cut(items.select("item_id", "iid", F.explode("windows").alias("w")).select("w.kind", "w.hash", "item_id", "iid", "w.q"), "windows")
    kinds = sorted(r["kind"] for r in windows.select("kind").distinct().collect())  # a few widths and readings
    sent = spark.sparkContext.broadcast(_filter(windows))  # bound: FILTER_BITS
    plain = df.select(quoted(doc_id).cast("long").alias("doc_id"), F.xxhash64(body).alias("tid"), body.alias("text"))
    hits = plain.mapInArrow(_hit_rows(sent, kinds), HITS)
    met = hits.join(windows, ["kind", "hash"]).withColumn("shift", F.col("p") - F.col("q"))
    lines = met.groupBy("doc_id", "tid", "item_id", "iid", "shift").agg(F.collect_list(F.struct("q", "words")).alias("windows"))
    both = lines.join(items.select("item_id", "iid", "total", F.col("words").alias("own")), ["item_id", "iid"])
    judged = both.select("doc_id", "tid", "item_id", "iid", "total", "own", "windows").mapInArrow(_judged_rows, FOUND)
    best = judged.groupBy("doc_id", "tid", "item_id", "iid").agg(F.max(F.struct("n_windows", "share", "same")).alias("b"))
    return best.select("doc_id", "tid", "item_id", "iid", "b.*")


def found(df: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, item_id, n_windows, share, same): the items (item_id, text) found in each document.

    same: whether the numbers, names and units are those of the item.
    """
    return _found(df, benchmark, text, doc_id, Scratch(df.sparkSession, "decontam")).select("doc_id", "item_id", "n_windows", "share", "same")


def clean(df: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of df in whose document no item was found. Rows without an id are judged by text."""
    scratch = Scratch(df.sparkSession, "decontam")
    key = lambda i, t: F.coalesce(i.cast("string"), F.concat(F.lit("text "), t.cast("string")))
    bad = _found(df, benchmark, text, doc_id, scratch).select(key(F.col("doc_id"), F.col("tid")).alias("bad_key")).distinct()
    bad = scratch.cut(bad, "bad")  # ids only; as a written table its size is known to the planner
    return df.join(bad, key(quoted(doc_id).cast("long"), F.xxhash64(quoted(text).cast("string"))) == bad.bad_key, "left_anti")
